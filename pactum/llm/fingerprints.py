"""Homomorphic document fingerprints: sums of wide vectors hashed from paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum.llm.common import repeat_copies, table, with_ordinal
from pactum.plans.session import materialize

#: 8 lanes modulo 2^32 identify the multiset of paragraphs; a count and 96 lanes modulo 2^24 measure likeness.
ID_LANES, ID_BITS = 8, 32
LANES, LANE_BITS = 96, 24
LOW = (1 << 32) - 1
PAIR = (1 << 32) | 1


def _units(words: Column) -> Column:
    """Hashes of the neighbouring word pairs of a paragraph; one hash if it has a word or none."""
    last = F.greatest(F.size(words) - 2, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1)))


def vectors(texts: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """(keys, vec) of texts with unique keys.

    A paragraph (a line, empty ones too) adds its own vector: eight 32-bit hashes, its number of word
    pairs, and for each of 96 hash bits the pairs that have it. The vector of a text is the sum over
    its paragraphs, each lane modulo its power of two, so paragraphs count in any order and one can be
    added or taken away later. Null text is the empty text.
    """
    names = [f"id{k}" for k in range(ID_LANES // 2)]
    pars = texts.select(*keys, F.explode_outer(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)).alias("par"))
    # Outer generators: an inner one adds a filter that computes its array a second time.
    units = (pars.select(*keys, *[F.xxhash64(F.lit(k), F.col("par")).alias(n) for k, n in enumerate(names)], F.split("par", " ").alias("words"))
             .select(*keys, *names, _units(F.col("words")).alias("units"))
             .select(*keys, *names, F.posexplode_outer("units").alias("at", "u0")).withColumn("u1", F.xxhash64("u0")))
    sums = [F.sum(F.when(F.col("at") == 0, part).otherwise(F.lit(0))).alias(f"i{n}{j}") for n in names
            for j, part in enumerate((F.col(n).bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(n, 32)))]
    # Two lanes share one sum: a text has fewer than 2^31 pairs.
    packed = [(u, b) for u, bits in (("u0", 32), ("u1", (LANES - 64) // 2)) for b in range(bits)]
    sums += [F.sum(F.shiftrightunsigned(u, b).bitwiseAND(F.lit(PAIR))).alias(f"s{u}_{b}") for u, b in packed]
    made = units.groupBy(*keys).agg(F.count("*").alias("n"), *sums)
    small, large = F.lit((1 << LANE_BITS) - 1), F.lit((1 << ID_BITS) - 1)
    lanes = [F.col(f"i{n}{j}").bitwiseAND(large) for n in names for j in range(2)] + [F.col("n").bitwiseAND(small)]
    lanes += [part.bitwiseAND(small) for u, b in packed
              for part in (F.col(f"s{u}_{b}"), F.shiftrightunsigned(f"s{u}_{b}", 32))]
    return made.select(*keys, F.array(*lanes).alias("vec"))


def combine(vec: Column, other: Column, sign: int = 1) -> Column:
    """Vector of two texts' paragraphs together (sign 1), or of the first without the second (-1)."""
    return F.transform(F.zip_with(vec, other, lambda a, b: a + sign * b), lambda x, i: F.pmod(x, F.when(
        i < ID_LANES, F.lit(1 << ID_BITS)).otherwise(F.lit(1 << LANE_BITS))))


def fingerprint(vec: Column) -> Column:
    """Hex digits of all lanes."""
    parts = F.transform(vec, lambda x, i: F.lpad(F.lower(F.hex(x)), F.when(i < ID_LANES, ID_BITS // 4).otherwise(LANE_BITS // 4), F.lit("0")))
    return F.array_join(parts, "")


def likeness(vec: Column, other: Column) -> Column:
    """0 to 1: 1 - |A - B|^2 / (|A|^2 + |B|^2) over signed lanes, an estimate of twice the shared pairs over all pairs.

    Both must be plain columns: inside the folds an expression would be computed once per lane.
    """
    half, whole = 1 << (LANE_BITS - 1), 1 << LANE_BITS

    def squares(lanes: Column, n: Column) -> Column:
        signed = lambda x: (F.pmod(2 * x - n + half, F.lit(whole)) - half).cast("double")
        return F.aggregate(lanes, F.lit(0.0), lambda acc, x: acc + signed(x) * signed(x))

    a, b = (F.slice(v, ID_LANES + 2, LANES) for v in (vec, other))
    both = squares(a, vec[ID_LANES]) + squares(b, other[ID_LANES])
    apart = squares(F.zip_with(a, b, lambda x, y: x - y), vec[ID_LANES] - other[ID_LANES])
    return F.when(vec == other, F.lit(1.0)).when(both == 0, F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - apart / both)))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, one row per document.

    Edited: the last floor(n / 2) code points give way to the first as many of the next document, by
    descending id (null last; rows of one id by text hash), the first after the last. Rows equal in id and
    text are one document in that order and get equal rows. Null text is empty; a single document is
    its own next; an empty table gives no rows; other columns are ignored. Order comes from a range
    partitioning of ids alone. Texts are shuffled once, and once the parts that move to a neighbour.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # A key without nulls, and the same columns for both joins: they and the sums below share one exchange of the texts.
    key = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("-"))
    full = docs.select(key.alias("key"), F.xxhash64(text).alias("th"), text.alias("text"))
    ids = docs.select(key.alias("key"), F.xxhash64(text).alias("th"), F.col(id_col).alias("id"), text.alias("text")).groupBy("key", "th", "id").agg(F.first(F.length("text")).alias("n_chars"), F.count("*").alias("copies"))
    placed = materialize(with_ordinal(ids, [F.col("id").desc_nulls_last(), F.col("th")], "print-order"), "print-places")
    count = placed.count()
    source = placed.select(F.col("key").alias("s_key"), F.col("th").alias("s_th"),
                           F.pmod(F.col("ordinal") - 1 + count, F.lit(max(count, 1))).alias("ordinal"))
    # For each document as a source: the one that takes its beginning, and how much of it.
    links = materialize(placed.join(source, "ordinal").select(
        F.col("s_key").alias("key"), F.col("s_th").alias("th"), F.col("key").alias("t_key"), F.col("th").alias("t_th"),
        F.floor(F.col("n_chars") / 2).cast("int").alias("moved"),
        F.col("id").alias("t_id"), F.col("copies")), "print-links")
    given = (full.join(links, ["key", "th"])
             .select(F.col("t_key").alias("key"), F.col("t_th").alias("th"), F.substring("text", F.lit(1), F.col("moved")).alias("tail"))
             .dropDuplicates(["key", "th"]))
    half = F.floor(F.length("text") / 2).cast("int")
    both = full.join(given, ["key", "th"]).dropDuplicates(["key", "th"]).select(
        "key", "th", "text", F.concat(F.substring("text", F.lit(1), F.length("text") - half), "tail").alias("edited"))
    n_chars = F.length("text").cast("bigint")
    variants = F.inline_outer(F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("body"), F.lit(None).cast("string").alias("sha"), n_chars.alias("n_chars")),
        F.struct(F.lit(1).alias("which"), F.col("edited").alias("body"), F.sha2(F.col("edited").cast("binary"), 256).alias("sha"), n_chars.alias("n_chars"))))
    made = vectors(both.select("key", "th", variants), ["key", "th", "which", "sha", "n_chars"], "body")
    own = F.col("which") == 0
    rows = materialize(made.groupBy("key", "th", "n_chars").agg(
        F.max("sha").alias("sha"), F.first(F.when(own, F.col("vec")), True).alias("vec"),
        F.first(F.when(~own, F.col("vec")), True).alias("edited_vec")), "print-vectors")
    nexts = (rows.select("key", "th", "vec").join(links, ["key", "th"])
             .select(F.col("t_key").alias("key"), F.col("t_th").alias("th"), F.col("t_id").alias("id"), F.col("vec").alias("next_vec"), "copies"))
    return repeat_copies(rows.join(nexts, ["key", "th"]), "copies").select(
        F.col("id").alias(id_col), "n_chars", F.col("sha").alias("edited_sha256"),
        fingerprint(F.col("vec")).alias("fingerprint"), fingerprint(F.col("edited_vec")).alias("edited_fingerprint"),
        likeness(F.col("vec"), F.col("edited_vec")).alias("near_edited"),
        likeness(F.col("vec"), F.col("next_vec")).alias("near_next"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))
