import math
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from pactum.llm.common import table
from pactum.llm.sharding import AXES, AXIS_BITS, TIE_BITS, kd_shards, sharded_documents, text_metadata

from .conftest import odd_texts


def check(rows, n):
    slots, by_text = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        by_text[r["text_crc32"]].add(r["shard"])
        assert 0 <= r["shard"] < n
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in by_text.values())


def test_near_equal_bytes(spark, sf):
    docs = table(spark, sf, "documents")
    rows = kd_shards(docs, shards=16).collect()
    check(rows, 16)
    assert len(rows) == docs.count()
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    mean, most = sum(sizes.values()) / 16, max(r["size"] for r in rows)
    assert max(abs(s - mean) for s in sizes.values()) <= 2 * most
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    assert all(r["size"] == len(texts[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]]) for r in rows)


def test_odd_rows(odd, nothing):
    rows = kd_shards(odd, shards=4).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in odd_texts())
    check(rows, 4)
    assert kd_shards(nothing, shards=4).count() == 0
    by_target = kd_shards(odd, target_bytes=5000).agg(F.max("shard")).first()[0]
    assert by_target == -(-sum(r["size"] for r in rows) // 5000) - 1


def test_large_group_of_copies_stays_whole(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 140, F.lit("same text")).otherwise(F.concat(F.lit("text "), "id")).alias("text"))
    rows = kd_shards(docs, shards=4).collect()
    check(rows, 4)
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert len(sizes) == 4 and sorted(sizes.values())[-1] <= 140 * 10 + 40


def test_documents_keep_their_columns(odd):
    placed = sharded_documents(odd, shards=3)
    assert placed.columns == [*odd.columns, "shard", "slot"]
    assert Counter((r["doc_id"], r["text"]) for r in placed.collect()) == Counter(odd_texts())
    assert placed.groupBy("shard", "slot").count().filter("count > 1").isEmpty()


def plain_tree(points, shards):
    """Shard of every (id, tie) by a k-d tree built with sorts: points are (id, size, axes, tie)."""
    ranges = [max(max(p[2][a] for p in points) - min(p[2][a] for p in points), 1e-12) for a in range(len(AXES))]
    found, todo = {}, [(0, shards, points)]
    while todo:
        node, leaves, rows = todo.pop()
        if leaves == 1 or not rows:
            found.update({(p[0], p[3]): node for p in rows})
            continue
        spans = [(min(p[2][a] for p in rows), max(p[2][a] for p in rows)) for a in range(len(AXES))]
        axis = max(range(len(AXES)), key=lambda a: ((spans[a][1] - spans[a][0]) / ranges[a], a))
        low, high = spans[axis]
        place = lambda p: (math.floor((p[2][axis] - low) / max(high - low, 1e-12) * ((1 << AXIS_BITS) - 1)) << TIE_BITS) + p[3]
        weights = Counter()
        for p in rows:
            weights[place(p)] += p[1]
        total, under, cut = sum(weights.values()), 0, None
        goal = total * (leaves // 2) / leaves
        for at in sorted(weights):
            if under + weights[at] > goal:  # the place in which the goal is passed goes to the side that brings it nearest
                cut = at + ((goal - under) * 2 >= weights[at])
                break
            under += weights[at]
        left = [p for p in rows if place(p) < cut]
        to_left = min(max(math.floor(leaves * sum(p[1] for p in left) / total + 0.5), 1), leaves - 1)
        todo += [(node, to_left, left), (node + to_left, leaves - to_left, [p for p in rows if place(p) >= cut])]
    return found


def test_equals_a_plain_tree(spark, sf, odd):
    for docs, shards in ((table(spark, sf, "documents"), 16), (odd, 5)):
        points = [(r["doc_id"], r["size"], [r[a] for a in AXES], r["tie"]) for r in text_metadata(docs).collect()]
        want = plain_tree(points, shards)
        got = {(r["doc_id"], r["tie"]): r["shard"] for r in kd_shards(docs, shards=shards, keep_tie=True).collect()}
        assert got == want


def test_metadata_of_texts(spark):
    row = text_metadata(spark.createDataFrame([(1, "aé b\n\nc")], "doc_id long, text string")).first()
    assert (row["size"], row["text_crc32"]) == (9, zlib.crc32("aé b\n\nc".encode()))
    assert all(abs(row[a] - want) < 1e-12 for a, want in zip(AXES, (math.log2(9), 1 / 7, 2 / 7, 2 / 7), strict=True))
