"""Find and remove passages of a benchmark in training documents."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum.llm.common import ascii_lower, repeat_copies, table
from pactum.plans.session import materialize

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 13
#: Bits of the broadcast hash set. Its size is fixed; a larger benchmark only fills it more.
SET_BITS = 20


def _words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _mark(words: Column, first: Column | int, length: Column | int) -> Column:
    """Bit number of a window: a hash of its length and of four of its words."""
    at = [words[first + off] for off in (F.lit(0), F.floor(length / 3).cast("int"), F.floor(2 * length / 3).cast("int"), length - 1)]
    return F.xxhash64(length, *at).bitwiseAND(F.lit((1 << SET_BITS) - 1))


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, len, mark, win): each item's runs of `window` words, or its whole text if it has fewer."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), _words(F.col(text_col)).alias("words"))
    items = items.filter(F.size("words") > 0).withColumn("len", F.least(F.size("words"), F.lit(window)))
    at = items.select("item", "words", "len", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("len"))).alias("at"))
    return at.select("item", "len", _mark(F.col("words"), F.col("at"), F.col("len")).alias("mark"),
                     F.array_join(F.slice("words", F.col("at") + 1, F.col("len")), " ").alias("win")).distinct()


def _hash_set(windows: DataFrame) -> tuple[Column, list[int]]:
    """The bit set as one literal of fixed size, and the window lengths (at most `window` many)."""
    longs = (windows.groupBy(F.shiftright("mark", 6).cast("int").alias("at"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("mark").bitwiseAND(F.lit(63)).cast("int"))).alias("bits")).collect())
    values = [0] * (1 << (SET_BITS - 6))
    for r in longs:
        values[r["at"]] = r["bits"]
    lengths = sorted(r["len"] for r in windows.select("len").distinct().collect())
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>"), lengths


def _candidates(words: Column, bits: Column, n: int) -> Column:
    """The windows of `n` words whose mark is in the bit set, as (pos, len, win) from position 1."""
    def passes(i: Column) -> Column:
        mark = _mark(words, i, F.lit(n))
        return F.getbit(F.element_at(bits, (F.shiftright(mark, 6) + 1).cast("int")), mark.bitwiseAND(F.lit(63)).cast("int")) == 1

    def window(i: Column) -> Column:
        return F.struct((i + 1).alias("pos"), F.lit(n).alias("len"), F.array_join(F.slice(words, i + 1, n), " ").alias("win"))

    starts = F.when(F.size(words) >= n, F.filter(F.sequence(F.lit(0), F.size(words) - n), passes))
    return F.transform(F.coalesce(starts, F.array().cast("array<int>")), window)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, share: int = 20,
                  spans: bool = False) -> DataFrame:
    """One row per document: (id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated[, spans]).

    A fixed-size bit set of all benchmark windows travels with the plan; each document's word
    windows are tested against it where they are read, and only those that pass are joined with the
    windows themselves, word for word. No text is shuffled. The join broadcasts the windows if they are
    small and shuffles otherwise. A document word inside any occurrence of a window is hit; a document
    is contaminated if it has a hit and `share` * hits >= words. `spans` adds the (pos, len) word
    windows found. Null or empty texts have no words; an empty benchmark contaminates nothing; items
    without words and repeated items add nothing; a null item id counts as ''; rows equal in id and
    text give equal rows; other columns are ignored.
    """
    windows = materialize(benchmark_windows(benchmark, item_col, item_text_col, window), "bench-windows")
    bits, lengths = _hash_set(windows)
    by_text = windows.groupBy("win").agg(F.sort_array(F.collect_set("item")).alias("items"))

    docs = docs.select(F.col(id_col).alias(id_col), F.xxhash64(F.col(text_col)).alias("text_hash"),
                       _words(F.col(text_col)).alias("words"))
    words = F.col("words")
    # Each document also has one entry that no window equals ('#' is in no word), so none is lost in the join.
    mark = F.concat(F.lit("#"), F.coalesce(F.col("text_hash").cast("string"), F.lit("-")), F.lit("#"), F.coalesce(F.col(id_col).cast("string"), F.lit("-")))
    found = F.array(F.struct(F.lit(0).alias("pos"), F.lit(0).alias("len"), mark.alias("win")))
    for n in lengths:
        found = F.concat(found, _candidates(words, bits, n))
    marked = docs.select(id_col, "text_hash", F.size(words).cast("bigint").alias("n_words"), F.inline_outer(found))
    hits = marked.join(by_text, "win", "left")
    real = F.col("items").isNotNull()
    per_doc = hits.groupBy(id_col, "text_hash", "n_words").agg(
        F.count(F.when(F.col("pos") == 0, 1)).alias("copies"),
        F.sort_array(F.collect_set(F.when(real, F.struct("pos", "len")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    zero = F.struct(F.lit(1).alias("next"), F.lit(0).cast("bigint").alias("n"))

    def cover(acc: Column, s: Column) -> Column:
        end = s["pos"] + s["len"]
        return F.struct(F.greatest(acc["next"], end).alias("next"),
                        (acc["n"] + F.greatest(F.lit(0), end - F.greatest(acc["next"], s["pos"]))).alias("n"))

    result = repeat_copies(per_doc, "copies").select(
        id_col, "text_hash", "n_words",
        F.aggregate("spans", zero, cover, lambda acc: acc["n"]).alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "spans")
    result = result.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
    return result if spans else result.drop("spans")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  remove: str = "documents", **options: object) -> DataFrame:
    """The documents without benchmark passages, all columns kept.

    remove="documents" drops contaminated documents; remove="spans" keeps every document and
    cuts the hit words (and nothing between other words) out of its text. Null ids and texts stay.
    """
    found = contamination(docs, benchmark, id_col, text_col, spans=remove == "spans", **options)
    names = {id_col: "hit_id", "text_hash": "hit_hash", "spans": "hit_spans"}
    found = found.filter("contaminated" if remove == "documents" else "n_hit > 0")
    found = found.select(*[F.col(c).alias(n) for c, n in names.items() if c in found.columns]).dropDuplicates(["hit_id", "hit_hash"])
    same = docs[id_col].eqNullSafe(found["hit_id"]) & (F.xxhash64(docs[text_col]) == found["hit_hash"])
    if remove == "documents":
        return docs.join(found, same, "left_anti")
    joined = docs.join(found, same, "left")
    raw = F.regexp_extract_all(docs[text_col], F.lit(RAW_WORD), F.lit(0))
    gaps = F.split(docs[text_col], RAW_WORD, -1)
    inside = lambda i: F.exists(found["hit_spans"], lambda s: (i + 1 >= s["pos"]) & (i + 1 < s["pos"] + s["len"]))
    kept = F.transform(raw, lambda w, i: F.when(inside(i), F.lit("")).otherwise(w))
    cut = F.array_join(F.concat(F.slice(gaps, 1, 1), F.zip_with(kept, F.slice(gaps, F.lit(2), F.greatest(F.size(gaps) - 1, F.lit(0))), lambda w, g: F.concat(w, g))), "")
    return joined.select(*[F.when(found["hit_id"].isNotNull() | found["hit_hash"].isNotNull(), cut).otherwise(docs[text_col]).alias(c)
                           if c == text_col else docs[c] for c in docs.columns])


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


OP1_SQL = rf"""
WITH lowered AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT doc_id, regexp_extract_all(t, '{WORD}') AS ws FROM lowered),
b AS (SELECT CAST(item_id AS VARCHAR) AS item,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM benchmark),
lens AS (SELECT item, ws, least(len(ws), 13) AS n FROM b WHERE len(ws) > 0),
wins AS (SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS win
         FROM (SELECT item, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM lens)),
starts AS (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
           FROM d, (SELECT DISTINCT n FROM wins) WHERE len(ws) >= n),
hits AS (SELECT doc_id, i, s.n, item FROM starts s JOIN wins w ON s.n = w.n AND array_to_string(ws[i:i + s.n - 1], ' ') = win),
words_hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items_hit AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
              FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
"""
