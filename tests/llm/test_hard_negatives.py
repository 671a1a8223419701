import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pactum.llm import hard_negatives as h
from pactum.llm.hard_negatives import hard_negatives, scaled, vertical_scan

SCHEMA = "vec_id long, embedding array<double>, label int, anchor string, first long, n long, score long, top long, down int, pack long"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, c, "a", 1, 2, 3, 4, 5, 6) for i, v, c in rows], SCHEMA).repartition(parts)


def brute(rows):
    sound = [(i, v, c) for i, v, c in rows if c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [[math.floor(256 * x) if abs(x) < 1e300 else int(x) * 256 for x in v] for _, v, _ in sound]
    last = lambda i: (i is None, i or 0)
    out = []
    for a, (i, _, c) in enumerate(sound):
        if i is None or i % 100:
            continue
        score = [sum(x * y for x, y in zip(whole[a], w)) for w in whole]
        order = sorted((b for b in range(len(sound)) if b != a), key=lambda b: (-score[b], last(sound[b][0])))
        for p in [b for b in order if sound[b][2] == c][:5]:
            fits = [b for b in order if sound[b][2] != c and 80 * score[p] <= 100 * score[b] <= 100 * score[p]][:5]
            out += [(i, sound[p][0], k + 1, sound[b][0], score[p], score[b]) for k, b in enumerate(fits)]
    return sorted(map(str, out))


def got(df):
    return sorted(str(tuple(r)) for r in df.collect())


def vectors(rng, n, dims=24):
    centres = [[rng.gauss(0, 0.3) for _ in range(dims)] for _ in range(4)]
    rows = []
    for i in range(n):
        c = rng.randrange(4)
        rows.append((i, [float(np.float32(x + rng.gauss(0, 0.15))) for x in centres[c]], rng.choice([c, c, (c + 1) % 4])))
    return rows


def test_odd_rows_match_brute_force(spark):
    rng = random.Random(1)
    rows = vectors(rng, 330)
    v = rows[5][1]
    rows += [(None, v, 1), (None, rows[0][1], 2), (100, rows[0][1], 2), (100, rows[0][1], 2), (7, rows[0][1], 2), (900, [], 1), (901, [1.0], 1),
             (1000, None, 1), (1001, v, None), (1002, [float("nan"), *v[1:]], 1), (1100, [float("inf"), *v[1:]], 1), (1003, [None, *v[1:]], 1),
             (1004, v + [9.0], 3), (1200, [0.0] * 24, 1), (1005, [0.0] * 24, 2)]
    for k in range(20):  # ties
        rows.append((2000 + k, rows[0][1], k % 3))
    df = frame(spark, rows)
    result = hard_negatives(df, F.col("vec_id") % 100 == 0)
    assert result.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows)
    assert got(result) == want and len(want) > 20
    assert hard_negatives(df.filter(F.lit(False)), F.col("vec_id") % 100 == 0).count() == 0
    assert hard_negatives(df, F.lit(None).cast("boolean")).count() == 0


def test_many_blocks_and_packs_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(h, "BLOCK_ROWS", 32)
    monkeypatch.setattr(h, "PACK", 3)
    monkeypatch.setattr(h, "CELL", 2)
    rng = random.Random(2)
    rows = [(25 * i, v, c) for i, v, c in vectors(rng, 400)]
    want = brute(rows)
    assert got(hard_negatives(frame(spark, rows, 5), F.col("vec_id") % 100 == 0)) == want and len(want) > 200


def test_numbers_beyond_doubles_stay_exact(spark):
    rng = random.Random(3)
    rows = [(i, [float((1 << 21) + rng.randrange(1 << 16)) for _ in range(3)], i // 4 % 2) for i in range(0, 400, 4)]
    want = brute(rows)
    assert max(int(x.strip("()").split(",")[4]) for x in want) > 1 << 53
    assert got(hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0)) == want


def test_scores_that_pass_64_bits_are_an_error(spark):
    rows = [(i, [1e300, 1.0], 0) for i in range(3)]
    with pytest.raises(Exception, match="(?i)int|overflow|long"):
        hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0).collect()


def test_scan_reads_large_dimensions_first_and_drops_by_bounds():
    rng = np.random.default_rng(5)
    columns, anchor = scaled(rng.normal(size=(64, 500))), scaled(rng.normal(size=(64, 1)))[:, 0]
    seen = []

    def keep(least, most):
        seen.append((least, most))
        return most >= np.sort(least)[-3]

    rows, scores = vertical_scan(columns, columns.min(axis=1), columns.max(axis=1), anchor, np.arange(500), keep)
    exact = anchor @ columns
    assert (scores == exact[rows]).all() and set(np.argsort(-exact)[:3]) <= set(rows)
    assert [len(a) for a, _ in seen] == sorted((len(a) for a, _ in seen), reverse=True) and len(seen[-1][0]) < 500
    assert (seen[0][0] <= exact).all() and (exact <= seen[0][1]).all()
    widths = [float((b - a).max()) for a, b in seen]
    assert widths == sorted(widths, reverse=True)


def test_copies_of_blocks_and_packs_are_not_broadcast(spark, monkeypatch):
    """The planner sizes the packs (under 0.1 MB here) without their copies, so it would take any number of copies through the driver."""
    monkeypatch.setattr(h, "BLOCK_ROWS", 32)
    monkeypatch.setattr(h, "PACK", 3)
    monkeypatch.setattr(h, "CELL", 2)
    plans, meet = [], h._meet

    def watched(blocks, anchors, purpose):
        met = meet(blocks, anchors, purpose)
        plans.append(met._jdf.queryExecution().executedPlan().toString())
        plans.append(anchors._jdf.queryExecution().executedPlan().toString())
        return met

    monkeypatch.setattr(h, "_meet", watched)
    rows = [(25 * i, v, c) for i, v, c in vectors(random.Random(6), 200)]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        result = got(hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(plans) == 4 and not any("Broadcast" in p for p in plans)
    assert result == brute(rows) and len(result) > 50


def test_vectors_are_written_in_two_bytes_a_number_where_they_fit():
    fits = np.array([[0.5, -1.0, 127.998], [-128.0 + 1 / 256, 0.0039, -0.0039]])
    wide = np.array([[128.0, 0.3], [1e300, -1e300]])
    for x, size in ((fits, 2), (wide, 8), (np.zeros((0, 3)), 2)):
        data = h._written(x, 256)
        assert len(data) == x.size * size + 1
        read = h._read(data, x.shape[1], 256)
        assert read.shape == x.shape and read.dtype == scaled(x).dtype and (read == scaled(x)).all()
