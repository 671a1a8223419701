"""Phrase collocations from count streams kept in prefix and in suffix order."""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pactum.llm.common import table
from pactum.llm.shingles import mix
from pactum.llm.terms import word_blocks
from pactum.plans.session import materialize

WORDS = 4
LEAST = 30
EXTENDED_PERCENT = 80
TOP = 2000
SCORE_SCALE = 2_000_000
#: Words a worker counts at a time, and phrases it may hold before it hands them on. Different words weigh more (`_weight`).
CHUNK = 2_000_000
#: Places of a chunk whose phrases are looked at together, and parts that held phrases are summed in, one after the other:
#: what this takes besides the words and counts themselves stays small.
PLACES = 1 << 18
PARTS = 16
#: Buckets that all pairs and triples of words are counted in first, 65,536 to a shard. Their number is fixed, so they only
#: spare rows; what they let through is counted exactly.
SHARDS = 1024
#: Parts a group is cut into before its first rows are chosen.
SALTS = 64
#: Ends of pieces become line feeds; inside a piece only space and tab are left between words.
_ENDS = bytes(10 if c in b".,;:!?\x0a\x0b\x0c\x0d" else c for c in range(256))


def _weight(rows: int, words: int, size: int) -> int:
    """What `rows` numbers or phrases with `words` different words of `size` bytes weigh in memory, as rows."""
    return max(rows, 4 * words, size // 32)


class _Chunk:
    """Words of many texts as numbers, one for each word of a group; -1 ends a piece."""

    def __init__(self) -> None:
        self.codes, self.fresh = array("i"), count()
        self.groups: dict[str, defaultdict[bytes, int]] = {}
        self.words = self.size = 0

    def add(self, group: str, text: str) -> None:
        own = self.groups.get(group)
        if own is None:
            own = self.groups[group] = defaultdict(self.fresh.__next__)
        number, before, raw = own.__getitem__, len(own), text.encode()
        for piece in raw.lower().translate(_ENDS).split(b"\n"):
            for words in word_blocks(piece):
                self.codes.extend(map(number, words))
            self.codes.append(-1)
        self.words += len(own) - before
        self.size += len(raw)

    def held(self) -> int:
        return _weight(len(self.codes), self.words, self.size)

    def named(self) -> tuple[list[str], list[bytes]]:
        """Group and text of each number."""
        of = [g for g, own in self.groups.items() for _ in own]
        order = np.argsort(np.array([n for own in self.groups.values() for n in own.values()], np.int64), kind="stable")
        words = [w for own in self.groups.values() for w in own]
        return [of[k] for k in order], [words[k] for k in order]

    def parts(self, of: list[str], words: list[bytes], reach: int, longest: int) -> Iterator[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
        """PLACES codes at a time, then those that phrases of `reach` words take from the next part, and -1.

        With them, for phrases of 2 to `longest` words, (places where they begin, hashes).
        """
        codes = np.frombuffer(self.codes, np.int32)
        seed = {g: xxhash.xxh64_intdigest(g) for g in self.groups}
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed[g]) for g, w in zip(of, words, strict=True)), np.uint64, len(words))
        for low in range(0, len(codes), PLACES):
            some = np.append(codes[low:low + PLACES + reach - 1], np.int32(-1))
            at = np.flatnonzero(some >= 0)
            mixed, found = hashes[some[at]], []
            for k in range(1, longest):
                more = some[at + k] >= 0  # a word is never the last code
                at, mixed = at[more], mixed[more]
                with np.errstate(over="ignore"):
                    mixed = mix(mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[some[at + k]])
                found.append((at, mixed))
            yield some, found

    def windows(self, of: list[str], words: list[bytes], size: int, often: list[np.ndarray]) -> Iterator[np.ndarray]:
        """For each place the longest phrase of 2 to `size` words there that may be frequent: its words' numbers, then -1.

        `often` has the frequent buckets of pairs, triples and so on.
        """
        for codes, hashed in self.parts(of, words, size, 1 + len(often)):
            length = np.append(codes >= 0, False).astype(np.int32)
            for k in range(2, size + 1):  # a phrase of k words: one of k-1 words here and one at the next place
                able = (length[:-1] >= k - 1) & (length[1:] >= k - 1)
                if k < 2 + len(often):
                    bits, (at, mixed) = often[k - 2], hashed[k - 2]
                    bucket = mixed & np.uint64(len(bits) * 8 - 1)
                    held = np.zeros(len(able), bool)
                    held[at] = (bits[(bucket >> np.uint64(3)).astype(np.int64)] >> (bucket & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                    able &= held
                length[:-1][able] = k
            start = np.flatnonzero(length[:PLACES] > 1)
            found = np.full((len(start), size), -1, np.int32)
            for k in range(size):
                inside = length[start] > k
                found[inside, k] = codes[start[inside] + k]
            yield found


def _tally(rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, and their sums of `n`."""
    if not len(rows):
        return rows, n
    order = np.lexsort(rows.T[::-1])
    rows, n = rows[order], n[order]
    first = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1)))
    return rows[first], np.add.reduceat(n, first)


class _Counts:
    """Counts of the phrases that may be frequent, summed over the chunks a worker reads."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.own = np.zeros(0, np.int32)
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[tuple[str, bytes], int] = {}
        self.bytes = self.later = 0
        self.own[:] = -1
        # A phrase lies in a part by its first word, so one part is merged and told at a time.
        self.parts = [(np.zeros((0, self.size), np.int32), np.zeros(0, np.int64))] * PARTS
        self.added: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(PARTS)]

    def begin(self, of: list[str], words: list[bytes]) -> None:
        """From now on numbers of words are those of another chunk."""
        self.of, self.words = of, words
        self.own = np.full(len(words) + 1, -1, np.int32)  # own numbers of its words, the last one for -1

    def add(self, windows: np.ndarray) -> None:
        windows, n = _tally(windows, np.ones(len(windows), np.int64))
        used = np.unique(windows[windows >= 0])
        for c in used[self.own[used] < 0].tolist():
            fresh = len(self.numbers)
            self.own[c] = self.numbers.setdefault((self.of[c], self.words[c]), fresh)
            if self.own[c] == fresh:
                self.bytes += len(self.words[c])
        windows = self.own[windows]
        part = windows[:, 0] % PARTS
        for k, added in enumerate(self.added):
            added.append((windows[part == k], n[part == k]))
        self.later += len(n)
        if self.later >= self.rows():
            self.merge()

    def merge(self) -> None:
        for k, added in enumerate(self.added):
            windows, n = zip(self.parts[k], *added, strict=True)
            added.clear()
            self.parts[k] = _tally(np.concatenate(windows), np.concatenate(n))
        self.later = 0

    def rows(self) -> int:
        return sum(len(n) for _, n in self.parts)

    def held(self) -> int:
        return _weight(self.rows(), len(self.numbers), self.bytes)

    def grams(self) -> Iterator[tuple[list[str], list[bytes], np.ndarray]]:
        """(groups, phrases, counts), each phrase once."""
        self.merge()
        names = list(self.numbers)
        for windows, counted in self.parts:
            for k in range(2, self.size + 1):
                long = windows[:, k - 1] >= 0
                phrases, n = _tally(windows[long, :k], counted[long])
                for low in range(0, len(n), 100_000):
                    some = phrases[low:low + 100_000].tolist()
                    yield [names[p[0]][0] for p in some], [b" ".join([names[c][1] for c in p]) for p in some], n[low:low + 100_000]


def _rows(groups: list[str | None], phrases: list[bytes | None], n: np.ndarray) -> list[pa.Array]:
    return [pa.array(groups, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())]


def _chunks(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[_Chunk]:
    chunk = _Chunk()
    for batch in batches:
        for group, text in zip(*batch.columns, strict=True):
            chunk.add(group.as_py(), text.as_py())
            if chunk.held() > most:
                yield chunk
                chunk = _Chunk()
    yield chunk


def _words_and_buckets(texts: DataFrame, longest: int) -> DataFrame:
    """Counts of words (group, phrase, n) and, in other rows, (size, shard, places): the buckets that longer phrases fall into."""
    most, shards = CHUNK, SHARDS

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["group", "phrase", "n", "size", "shard", "places"]
        for chunk in _chunks(batches, most):
            of, words = chunk.named()
            n, dealt = np.zeros(len(words), np.int64), [[] for _ in range(2, longest + 1)]
            for codes, hashed in chunk.parts(of, words, longest, longest):
                n += np.bincount(codes[:PLACES][codes[:PLACES] >= 0], minlength=len(words))
                for to, (at, mixed) in zip(dealt, hashed, strict=True):
                    to.append((mixed[at < PLACES] & np.uint64((shards << 16) - 1)).astype(np.uint32))
            del chunk  # or two of them lie in memory while the next one is read
            yield pa.RecordBatch.from_arrays([*_rows(of, words, n), *[pa.nulls(len(of), t) for t in (pa.int32(), pa.int32(), pa.binary())]], names)
            del of, words
            for size in range(2, longest + 1):
                bucket = np.concatenate(dealt.pop(0) or [np.zeros(0, np.uint32)])
                bucket.sort()
                cuts = np.searchsorted(bucket, np.arange(shards + 1, dtype=np.uint64) << np.uint64(16))
                held = [k for k in range(shards) if cuts[k] < cuts[k + 1]]
                places = [bucket[cuts[k]:cuts[k + 1]].astype(np.uint16).tobytes() for k in held]
                yield pa.RecordBatch.from_arrays([pa.nulls(len(held), t) for t in (pa.string(), pa.string(), pa.int64())]
                                                 + [pa.array([size] * len(held), pa.int32()), pa.array(held, pa.int32()), pa.array(places, pa.binary())], names)

    return materialize(texts.mapInArrow(make, "group string, phrase string, n bigint, size int, shard int, places binary"), "phrases-words")


def _often(buckets: DataFrame, least: int, longest: int) -> list[np.ndarray]:
    """For each size a bit set of the buckets that hold `least` phrases or more; SHARDS times 8 KB each."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n = None, np.zeros(1 << 16, np.int64)

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()),
                                               pa.array([np.packbits(n >= least, bitorder="little").tobytes()])], ["size", "shard", "bits"])

        for batch in batches:
            for size, shard, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != (size, shard):
                    if now is not None:
                        yield full()
                    now, n = (size, shard), np.zeros(1 << 16, np.int64)
                n += np.bincount(np.frombuffer(places, np.uint16), minlength=1 << 16)
        if now is not None:
            yield full()

    bits = [np.zeros(SHARDS << 13, np.uint8) for _ in range(2, longest + 1)]
    dealt = buckets.select("size", "shard", "places").repartition("size", "shard").sortWithinPartitions("size", "shard")
    for r in dealt.mapInArrow(add, "size int, shard int, bits binary").collect():
        bits[r["size"] - 2][r["shard"] << 13:(r["shard"] + 1) << 13] = np.frombuffer(r["bits"], np.uint8)
    return bits


def _longer_counts(texts: DataFrame, size: int, often: list[np.ndarray]) -> DataFrame:
    """(group, phrase, n) of all phrases of 2 to `size` words that may be frequent.

    Read by one task a core: a task hands on a phrase once, however many texts it reads, and sooner only when it holds
    more than `CHUNK` phrases, or words that weigh as much. So the rows grow with the phrases, not with phrases times parts of the input.
    """
    context, most = texts.sparkSession.sparkContext, CHUNK
    shared = context.broadcast(often)

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told() -> Iterator[pa.RecordBatch]:
            for found in counts.grams():
                yield pa.RecordBatch.from_arrays(_rows(*found), ["group", "phrase", "n"])

        counts = _Counts(size)
        for chunk in _chunks(batches, most):
            counts.begin(*chunk.named())
            for windows in chunk.windows(counts.of, counts.words, size, shared.value):
                counts.add(windows)
                if counts.held() > most:
                    yield from told()
                    counts.clear()
            counts.begin([], [])
            del chunk  # or two of them lie in memory while the next one is read
        yield from told()

    return texts.coalesce(context.defaultParallelism).mapInArrow(make, "group string, phrase string, n bigint").groupBy("group", "phrase").agg(F.sum("n").alias("n"))


def frequent_phrases(docs: DataFrame, text_col: str = "text", group_col: str = "lang", size: int = WORDS, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(group, words, f) of all phrases of 1 to `size` words that occur `least` times or more, and (group, n).

    Two scans of the texts. The first counts words, and pairs and triples of words in a fixed number of buckets. A phrase can be
    frequent only if the buckets of all its pairs and triples are; the second scan counts what passes, by its words. A large corpus fills the
    buckets: then more rows are counted, and the result is the same.
    """
    texts = docs.select(F.coalesce(F.col(group_col).cast("string"), F.lit("und")).alias("group"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    longest = min(size, 3)
    first = _words_and_buckets(texts, longest)
    words = materialize(first.filter("shard is null").groupBy("group", "phrase").agg(F.sum("n").alias("n")), "phrases-counts")
    often = _often(first.filter("shard is not null"), least, longest)
    longer = materialize(_longer_counts(texts, size, often).filter(F.col("n") >= least), "phrases-frequent")
    phrases = words.filter(F.col("n") >= least).union(longer)
    return (phrases.select("group", F.split("phrase", " ", -1).alias("words"), F.col("n").alias("f")),
            materialize(words.groupBy("group").agg(F.sum("n").alias("n")), "phrases-totals"))


def _lockstep(phrases: DataFrame, backwards: bool, size: int) -> DataFrame:
    """Count stream in prefix (or suffix) order, each row with the counts of its own first (or last) words.

    Dealt by range of the words, so a phrase comes after those it begins with, and one pass over a part meets
    all of them: the last phrase of each length seen before. What a part needs from the parts before it are
    their last phrases of each length. A first word shared by many phrases lies in as many parts as it needs.
    """
    n = int(phrases.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.reverse("words") if backwards else F.col("words")
    dealt = phrases.select("group", key.alias("key"), "f").repartitionByRange(n, "group", "key").withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "phrases-suffixes" if backwards else "phrases-prefixes")
    of_size = [F.when(F.size("key") == j, F.struct("group", "key", "f")) for j in range(1, size)]
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = dealt.groupBy("part").agg(*[F.max(x).alias(f"e{j}") for j, x in enumerate(of_size, 1)])
    ends = ends.select(F.col("part").alias("of_part"), *[F.max(f"e{j}").over(earlier).alias(f"e{j}") for j in range(1, size)])
    upto = Window.partitionBy("part").orderBy("group", "key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = dealt.join(ends, F.col("part") == F.col("of_part")).select(
        "group", "key", "f", *[F.coalesce(F.last(x, ignorenulls=True).over(upto), F.col(f"e{j}")).alias(f"h{j}") for j, x in enumerate(of_size, 1)])

    def count_of(j: int) -> Column:
        held = F.col(f"h{j}")
        same = (held["group"] == F.col("group")) & (held["key"] == F.slice("key", 1, j))
        return F.when((F.size("key") > j) & same, held["f"]).alias(f"c{j}")

    return seen.select("group", "key", "f", *[count_of(j) for j in range(1, size)])


def collocations(docs: DataFrame, text_col: str = "text", group_col: str = "lang", size: int = WORDS, least: int = LEAST,
                 extended_percent: int = EXTENDED_PERCENT, top: int = TOP) -> DataFrame:
    """The first `top` phrases of each group: (group, rank, phrase, a, l, r, n, score, cut).

    A-Z in lower case; pieces end at `.,;:!?` and line ends, words are runs free of space and tab. Candidates are
    phrases of 2 to `size` words with a >= `least` occurrences in pieces, overlaps included. Cut after k words, l and r are the counts of
    the two parts and the score is floor(2000000 * a / (l + r)); the lowest cut counts, ties to the smallest k.
    Candidates inside a longer one with 100 * f >= `extended_percent` * a go; one word longer is enough to look
    at, since what a longer phrase holds is held by a phrase between them that is as frequent. First come higher scores, then
    larger a, then the phrase by bytes. Counts are whole numbers, products decimals of 38 digits.

    A null group is `und`, and the same as a group of that name. Null, empty and blank texts have no words. Repeated rows count
    each time. Long texts are read whole. No candidate or an empty table gives no rows; other columns are ignored.
    """
    phrases, totals = frequent_phrases(docs, text_col, group_col, size, least)
    none = F.lit(None).cast("bigint")
    streams = []
    for backwards, side in ((False, "l"), (True, "r")):
        rows = _lockstep(phrases, backwards, size).withColumn("words", F.reverse("key") if backwards else F.col("key"))
        own = {f"{side}{j}": F.col(f"c{j}") for j in range(1, size)}
        sides = [f"{s}{j}" for s in "lr" for j in range(1, size)]
        streams.append(rows.select("group", "words", "f", *[own.get(c, none).alias(c) for c in sides], none.alias("longer")))
        # Each phrase is the extension by one word of what is left without its last (or first) word.
        short = F.slice("key", F.lit(1), F.size("key") - 1)
        streams.append(rows.filter(F.size("key") > 2).select(
            "group", (F.reverse(short) if backwards else short).alias("words"), none.alias("f"), *[none.alias(c) for c in sides], F.col("f").alias("longer")))
    merged = streams[0]
    for more in streams[1:]:
        merged = merged.union(more)
    candidates = merged.filter(F.size("words") > 1).groupBy("group", "words").agg(*[F.max(c).alias(c) for c in ("f", *sides, "longer")])

    wide = "decimal(38,0)"
    cuts = F.array(*[
        F.when(F.size("words") == length, F.struct(
            F.expr(f"(cast({SCORE_SCALE} as decimal(7,0)) * cast(f as decimal(19,0))) div (cast(l{k} as {wide}) + r{length - k})").alias("score"),
            F.lit(k).alias("cut"), F.col(f"l{k}").alias("l"), F.col(f"r{length - k}").alias("r")))
        for length in range(2, size + 1) for k in range(1, length)])
    scored = candidates.withColumn("best", F.array_min(F.filter(cuts, lambda c: c.isNotNull())))
    kept = scored.filter(F.col("longer").isNull() | (F.col("longer").cast(wide) * 100 < F.col("f").cast(wide) * extended_percent))
    flat = kept.select("group", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "best.l", "best.r", "best.score", "best.cut")
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    # First within salted parts of a group, so no task holds more of one group than SALTS times `top`.
    part = F.row_number().over(Window.partitionBy("group", "salt").orderBy(*order))
    flat = flat.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn("in_part", part).filter(F.col("in_part") <= top).drop("salt", "in_part")
    rank = F.row_number().over(Window.partitionBy("group").orderBy(*order))
    firsts = flat.withColumn("rank", rank).filter(F.col("rank") <= top)
    return (firsts.join(totals, "group")
            .select(F.col("group").alias(group_col), F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score", "cut"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents")).drop("cut")


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, w, unnest([1, 2, 3, 4]) AS k FROM words WHERE len(w) > 0),
grams AS (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM sizes),
f AS (
  SELECT lang, k, p, count(*) AS f
  FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS p FROM grams) GROUP BY ALL HAVING count(*) >= 30),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
cand AS (SELECT *, string_split(p, ' ') AS w FROM f WHERE k > 1),
inner_parts AS (
  SELECT lang, f AS longer, array_to_string(w[i:i + j - 1], ' ') AS p
  FROM (SELECT *, unnest(range(1, k - j + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS j FROM cand))),
longest AS (SELECT lang, p, max(longer) AS longer FROM inner_parts GROUP BY ALL),
cuts AS (SELECT *, array_to_string(w[1:c], ' ') AS lp, array_to_string(w[c + 1:], ' ') AS rp FROM (SELECT *, unnest(range(1, k)) AS c FROM cand)),
scored AS (
  SELECT x.lang, x.p, x.f AS a, lf.f AS l, rf.f AS r, x.c, CAST(CAST(2000000 AS HUGEINT) * x.f // (lf.f + rf.f) AS BIGINT) AS score
  FROM cuts x JOIN f lf ON lf.lang = x.lang AND lf.p = x.lp JOIN f rf ON rf.lang = x.lang AND rf.p = x.rp),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1)
SELECT b.lang, row_number() OVER w AS rank, b.p AS phrase, a, l, r, n, score
FROM best b JOIN totals USING (lang) LEFT JOIN longest g ON g.lang = b.lang AND g.p = b.p
WHERE longer IS NULL OR 100 * longer < 80 * a
WINDOW w AS (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.p)
QUALIFY row_number() OVER w <= 2000
"""
