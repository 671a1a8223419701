"""Near duplicates by the Jaccard similarity of word n-grams."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum.llm.common import table
from pactum.llm.components import components
from pactum.llm.shingles import shingle_sets
from pactum.llm.terms import frequent
from pactum.plans.session import materialize

SHINGLE = 4
PERCENT = 85
#: Fixed sizes of what travels to every worker; any content of it gives the same result.
COMMON_WORDS, COMMON_SHINGLES = 65_536, 1_000_000
SET_BITS = 1 << 23
#: Sets of a tile that all others of it are tried against first.
HEADS = 2
#: Shingles a worker looks through at a time for common ones, and how often one must occur there.
CHUNK, OFTEN = 4_000_000, 3
MEMO = 1_000_000


def node_of(shingles: np.ndarray) -> int:
    """Number of a shingle set; equal sets have equal numbers."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def bitmap(shingles: np.ndarray) -> bytes:
    """Bit set of the shingles' low bits, as many bits as the next power of two from the set's size."""
    bits = max(64, 1 << (len(shingles) - 1).bit_length())
    flags = np.zeros(bits, np.uint8)
    flags[(shingles & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def overlap_bound(n_a: int, a: bytes, n_b: int, b: bytes) -> int:
    """No more shingles than this are in both: each bit that only one has stands for one that the other lacks."""
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    bits = 8 * min(len(a), len(b))

    def fold(v: int, width: int) -> int:
        while width > bits:
            width //= 2
            v = (v & ((1 << width) - 1)) | (v >> width)
        return v

    x, y = fold(x, 8 * len(a)), fold(y, 8 * len(b))
    return min(n_a - (x & ~y).bit_count(), n_b - (y & ~x).bit_count())


def linked(n_a: int, n_b: int, both: int, percent: int = PERCENT) -> bool:
    return 100 * both >= percent * (n_a + n_b - both)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def common_terms(texts: DataFrame, size: int) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """The most common words, sorted, with their levels, and common shingles, sorted; all of bounded size."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[np.ndarray] = []
        sets: list[np.ndarray] = []
        seen: set[int] = set()

        def flush() -> pa.RecordBatch:
            found = []
            for kind, arrays in ((0, words), (1, sets)):
                values, n = np.unique(np.concatenate(arrays), return_counts=True) if arrays else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                often = n >= OFTEN
                found.append((np.full(often.sum(), kind), values[often], n[often]))
            words.clear(), sets.clear(), seen.clear()
            kinds, values, n = (np.concatenate(x) for x in zip(*found, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), _signed(values), pa.array(n, pa.int64())], ["kind", "term", "n"])

        for batch in batches:
            for shingles, _, h in shingle_sets(batch.column(0).to_pylist(), size, words=True):
                node = node_of(shingles)
                if node not in seen:  # copies say nothing about how common a passage is among texts
                    seen.add(node)
                    words.append(h)
                    sets.append(shingles)
            if sum(map(len, sets)) > CHUNK:
                yield flush()
        yield flush()

    counts = materialize(texts.mapInArrow(count, "kind int, term bigint, n bigint").groupBy("kind", "term").agg(F.sum("n").alias("n")), "shingle-common")
    words, shared = (frequent(counts.filter(F.col("kind") == kind), most) for kind, most in ((0, COMMON_WORDS), (1, COMMON_SHINGLES)))
    terms = words["term"].to_numpy().view(np.uint64)
    levels = 1 + np.floor(np.log2(np.maximum(words["n"].to_numpy(), 1))).astype(np.int64)
    order = np.argsort(terms)
    shingles = np.sort(shared["term"].to_numpy().view(np.uint64))
    return (terms[order], levels[order]), shingles


def _prefixes(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(id, hash, n, node, sig, keys): each set's first shingles in one order for all, rarest words first."""
    shared = docs.sparkSession.sparkContext.broadcast(common_terms(docs.select("text"), size))

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, common = shared.value
        seen: set[int] = set()
        for batch in batches:
            ns, nodes, sigs, keys = [], [], [], []
            for shingles, rank, _ in shingle_sets(batch.column(1).to_pylist(), size, levels):
                n = len(shingles)
                node = node_of(shingles) if n else None
                ns.append(n)
                nodes.append(node)
                if not n or node in seen:  # copies met by this worker need no keys of their own
                    sigs.append(None), keys.append(None)
                    continue
                if len(seen) > MEMO:
                    seen.clear()
                seen.add(node)
                if len(common):
                    at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
                    rank = rank + 1000 * (common[at] == shingles)
                # Shingles are sorted by hash already, so a stable sort by rank settles ties by hash.
                ordered = shingles[np.argsort(rank, kind="stable")[:n - -(-percent * n // 100) + 1]]
                sigs.append(bitmap(shingles))
                keys.append(ordered.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(ns, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sigs, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], ["id", "hash", "n", "node", "sig", "keys"])

    id_type = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(make, f"id {id_type}, hash bigint, n bigint, node bigint, sig binary, keys array<bigint>")


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of sorted input, cut between keys (the first column), never inside one."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
        if not len(held[0]):
            continue
        last = np.searchsorted(held[0], held[0][-1])
        if last:
            yield [c[:last] for c in held]
            held = [c[last:] for c in held]
    if held is not None and len(held[0]):
        yield held


def _tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of keys that several sets share, with the number of these sets."""
    for columns in _runs(batches):
        order = np.lexsort((columns[1], columns[0]))
        key, node, n, at = (c[order] for c in columns)
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        key, node, n, at = key[fresh], node[fresh], n[fresh], at[fresh]
        _, run, sizes = np.unique(key, return_inverse=True, return_counts=True)
        shared = sizes[run] > 1
        yield pa.RecordBatch.from_arrays([pa.array(c[shared]) for c in (key, node, n, at, sizes[run])], ["key", "node", "n", "at", "sets"])


def _first_tries(percent: int):
    def tries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each set of a tile with the next smaller one, and with those whose shingles are shared most.

        The text that many others were made from shares all of its shingles, so it is among the latter.
        """
        for columns in _runs(batches):
            found = []
            for by, heads in ((columns[2], 0), (-columns[4], HEADS)):
                order = np.lexsort((columns[1], by, columns[0]))
                key, node, n, place = (c[order] for c in columns[:4])
                lead = place <= n - -(-2 * percent * n // (100 + percent))
                begins = np.ones(len(key), bool)
                begins[1:] = key[1:] != key[:-1]
                here, first = np.arange(len(key)), np.maximum.accumulate(np.where(begins, np.arange(len(key)), 0))
                for other in [first + k for k in range(heads)] or [here - 1]:
                    rows = here[(other >= first) & (other < here)]
                    at = other[rows]
                    low = np.where(n[rows] <= n[at], rows, at)
                    fits = lead[low] | ((n[rows] == n[at]) & (lead[rows] | lead[at]))
                    fits &= 100 * np.minimum(n[rows], n[at]) >= percent * np.maximum(n[rows], n[at])
                    found.append(np.sort(np.stack([node[rows[fits]], node[at[fits]]]), axis=0))
            yield _pairs(found)
    return tries


def _across(percent: int):
    def across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of a tile that are not connected yet and whose sizes and places allow a link.

        All sets have their shingles in one order. If this is the first shingle that two share, each has as many that the
        other lacks as stand before it, which bounds what they share from above. If it is not, an earlier tile has tried them.
        """
        for key, node, n, at, part in _runs(batches):
            order = np.lexsort((node, n, key))
            key, node, n, at, part = key[order], node[order], n[order], at[order], part[order]
            edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            low, high = np.minimum.reduceat(part, edges[:-1]), np.maximum.reduceat(part, edges[:-1])
            found, held = [], 0
            for i, j in zip(edges[:-1][low != high], edges[1:][low != high], strict=True):
                for x in range(i, j - 1):
                    # What stands before the shingle must leave room for a link with a set of its own size at least.
                    if n[x] - at[x] < -(-2 * percent * n[x] // (100 + percent)):
                        continue
                    top = np.searchsorted(n[x + 1:j], 100 * n[x] // percent, side="right") + x + 1
                    other = np.flatnonzero(part[x + 1:top] != part[x]) + x + 1
                    least = -(-percent * (n[x] + n[other]) // (100 + percent))
                    other = other[(n[x] - at[x] >= least) & (n[other] - at[other] >= least)]
                    if len(other):
                        found.append(np.sort(np.stack([np.full(len(other), node[x]), node[other]]), axis=0))
                        held += len(other)
                    if held > CHUNK // 4:
                        yield _pairs(found)
                        found, held = [], 0
            if found:
                yield _pairs(found)
    return across


def _pairs(found: list[np.ndarray]) -> pa.RecordBatch:
    a, b = np.concatenate(found, axis=1)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    a, b = a[fresh], b[fresh]
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _set_members(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of the wanted nodes, from the texts again; a bit set of fixed size skips most others."""
    place = F.pmod(F.col("node"), F.lit(SET_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))
    words = np.zeros(SET_BITS // 64, np.int64)
    for r in wanted.groupBy(F.shiftright(place, 6).cast("int").alias("at")).agg(F.bit_or(bit).alias("bits")).collect():
        words[r["at"]] = r["bits"]
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        seen: set[int] = set()
        for batch in batches:
            nodes, members = [], []
            for shingles, _, _ in shingle_sets(batch.column(0).to_pylist(), size):
                node = node_of(shingles)
                at = node % SET_BITS
                if len(shingles) and node not in seen and int(bits[at >> 6]) >> (at & 63) & 1:
                    if len(seen) > MEMO:
                        seen.clear()
                    seen.add(node)
                    nodes.append(node)
                    members.append(shingles.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(members, pa.binary())], ["node", "members"])

    return docs.select("text").mapInArrow(make, "node bigint, members binary").join(wanted, "node", "left_semi").dropDuplicates(["node"])


def _check(percent: int):
    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Exact intersection of the sorted arrays."""
        for batch in batches:
            a, b, x, y = (c.to_pylist() for c in batch.columns)
            keep = []
            for left, right in zip(x, y, strict=True):
                p, q = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                keep.append(linked(len(p), len(q), int((q[at] == p).sum()), percent))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return check


def _bounded(percent: int):
    def bounded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, s, m, t = (c.to_pylist() for c in batch.columns)
            keep = [linked(n[i], m[i], overlap_bound(n[i], s[i], m[i], t[i]), percent) for i in range(len(a))]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return bounded


def _near(pairs: DataFrame, signatures: DataFrame, percent: int, purpose: str) -> DataFrame:
    """Of the pairs those that the bit counts allow to link."""
    first = signatures.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sig").alias("sig_a"))
    second = signatures.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b"))
    return materialize(pairs.join(first, "a").join(second, "b").select("a", "b", "n_a", "sig_a", "n_b", "sig_b")
                       .mapInArrow(_bounded(percent), "a bigint, b bigint"), purpose)


def _linking(near: DataFrame, members: DataFrame, percent: int, purpose: str) -> DataFrame:
    """Of the pairs those that do link."""
    whole = (near.join(members.select(F.col("node").alias("a"), F.col("members").alias("of_a")), "a")
             .join(members.select(F.col("node").alias("b"), F.col("members").alias("of_b")), "b")
             .select("a", "b", "of_a", "of_b"))
    return materialize(whole.mapInArrow(_check(percent), "a bigint, b bigint"), purpose)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: (id, n_shingles, component_id).

    Documents link when their sets of word n-grams have 100 * both >= percent * either; component_id
    is the least id reachable. Texts with equal sets are one class. In one order of shingles, rarest words
    first and common passages last, two linked sets share a shingle among their first few: the tiles.
    In a tile each class is first tried against the next smaller and those that share most; what these links connect is
    one part, and then every pair of a tile in different parts whose sizes and places in the order allow a link is tried. Bit sets
    bound the overlap from above before sorted arrays are intersected exactly, so no link between parts is lost and
    a large group of copies needs few tries; links inside a part that is connected already are not listed. Words fewer than `size` are one shingle; without words a
    document is its own component. Null ids stay (a component of null ids alone has a null id); rows
    equal in id and text give equal rows; an empty table gives none; other columns are ignored.
    """
    sets, parts, more = _links(docs, id_col, text_col, size, percent)
    sets = sets.select("id", "n", "node")
    named = _representatives(sets, parts, more, F.min("id"))
    full = sets.filter("node is not null").join(named, "node").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("kept").alias("component_id"))
    empty = sets.filter("node is null").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return full.union(empty)


def _links(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sets of the documents, the parts that the first tries connect, and the links found between parts."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("hash"))
    sets = materialize(_prefixes(texts, size, percent), "shingle-prefixes")
    keyed = sets.filter("keys is not null").select("node", "n", F.posexplode("keys").alias("at", "key"))
    dealt = keyed.select("key", "node", "n", F.col("at").cast("bigint").alias("at")).repartition("key").sortWithinPartitions("key")
    tiles = materialize(dealt.mapInArrow(_tiles, "key bigint, node bigint, n bigint, at bigint, sets bigint"), "shingle-tiles")
    shares = materialize(tiles.groupBy("node").agg((F.sum("sets") / F.max("n")).alias("share")), "shingle-shares")
    signatures = materialize(sets.filter("sig is not null").join(shares, "node", "left_semi").select("node", "n", "sig").dropDuplicates(["node"]), "shingle-bits")
    weighed = tiles.join(shares, "node").select("key", "node", "n", "at", "share").repartition("key").sortWithinPartitions("key")
    tried = materialize(weighed.mapInArrow(_first_tries(percent), "a bigint, b bigint").distinct(), "shingle-tried")
    near = _near(tried, signatures, percent, "shingle-near")
    members = materialize(_set_members(texts, _ends(near), size), "shingle-members")
    parts = materialize(components(_linking(near, members, percent, "shingle-links"), "shingle-parts"), "shingle-parts")

    placed = tiles.select("key", "node", "n", "at").join(parts, "node", "left").select(
        "key", "node", "n", "at", F.coalesce("component", "node").alias("part"))
    rest = (placed.repartition("key").sortWithinPartitions("key").mapInArrow(_across(percent), "a bigint, b bigint")
            .distinct().join(tried, ["a", "b"], "left_anti"))
    near = _near(rest, signatures, percent, "shingle-near")
    unseen = materialize(_ends(near).join(members.select("node"), "node", "left_anti"), "shingle-unseen")
    if not unseen.isEmpty():
        members = members.union(materialize(_set_members(texts, unseen, size), "shingle-members"))
    return sets, parts, _linking(near, members, percent, "shingle-links")


def _representatives(docs: DataFrame, parts: DataFrame, more: DataFrame, least: Column) -> DataFrame:
    """(node, kept): the parts joined by the further links, `kept` being the least of each component by the aggregate `least`."""
    def place(links: DataFrame, side: str) -> DataFrame:
        named = parts.select(F.col("node").alias(side), "component")
        return links.join(named, side, "left").withColumn(side, F.coalesce("component", side)).drop("component")

    merged = components(place(place(more, "a"), "b"), "shingle-merged")
    nodes = docs.filter("node is not null").groupBy("node").agg(least.alias("first"))
    nodes = nodes.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component")
    nodes = nodes.join(merged.select(F.col("node").alias("part"), "component"), "part", "left").withColumn("part", F.coalesce("component", "part"))
    nodes = materialize(nodes.select("node", "part", "first"), "shingle-classes")
    kept = nodes.groupBy("part").agg(F.min("first").alias("kept"))
    return materialize(nodes.join(kept, "part").select("node", "kept"), "shingle-named")


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each group, that of the least (id, text hash), all columns as they are.

    Null ids come last, so the least id stays. What goes is decided by id and text: rows that share an id
    with a copy stay if their own text is no copy. Of rows equal in id and text one stays. Documents
    without words all stay.
    """
    sets, parts, more = _links(docs, id_col, text_col, size, percent)
    rows = sets.filter("node is not null").select("id", "hash", "node")
    row = F.struct(F.col("id").isNull().alias("last"), F.col("id").alias("id"), F.col("hash").alias("hash"))
    named = _representatives(rows, parts, more, F.min(row))
    seen = rows.join(named, "node").withColumn("goes", ~(F.col("id").eqNullSafe(F.col("kept.id")) & (F.col("hash") == F.col("kept.hash"))))
    seen = materialize(seen.groupBy(F.col("id").alias("seen_id"), F.col("hash").alias("seen_hash")).agg(F.max("goes").alias("goes"), F.count("*").alias("n"))
                       .filter("goes or n > 1"), "shingle-gone")

    def among(marked: DataFrame, df: DataFrame, how: str) -> DataFrame:
        return df.join(marked, df[id_col].eqNullSafe(marked["seen_id"]) & (F.xxhash64(df[text_col]) == marked["seen_hash"]), how)

    kept = among(seen.filter("goes"), docs, "left_anti")
    again = seen.filter("not goes")
    if again.isEmpty():
        return kept
    return among(again, kept, "left_anti").union(among(again, kept, "left_semi").dropDuplicates([id_col, text_col]))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))
