import math

import pytest
from pyspark.sql import functions as F

from pactum.functions.metrics import lcg
from pactum.operators import pools as P
from pactum.operators.trials import sample_n_trials, sample_trials
from pactum.plans.ranking import flag_lowest


@pytest.mark.parametrize("sizes", [(7, 3), (1, 1), (97, 3), (250, 249), (5, 0)])
@pytest.mark.parametrize("held_out", [0.3, 0.25])
def test_split_sizes_are_exact(spark, sizes, held_out):
    rows = [(i, int(i >= sizes[0])) for i in range(sum(sizes))]
    out = P.stratified_split(spark.createDataFrame(rows, "id bigint, label int"), "id", held_out=held_out)
    held = {r["label"]: r["n"] for r in out.filter("NOT is_train").groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes)
    assert out.count() == total
    assert sum(held.values()) == math.ceil(round(held_out * total, 9))
    for label, size in enumerate(sizes):
        assert abs(held.get(label, 0) - held_out * size) <= 1


def test_split_is_stable(spark):
    df = spark.range(500).select("id", (F.col("id") % 5 == 0).cast("int").alias("label"))
    a = {r["id"]: r["is_train"] for r in P.stratified_split(df, "id").collect()}
    b = {r["id"]: r["is_train"] for r in P.stratified_split(df.repartition(13), "id").collect()}
    other = {r["id"]: r["is_train"] for r in P.stratified_split(df, "id", seed=1).collect()}
    assert a == b and a != other


@pytest.mark.parametrize("buckets", [1, 4, 65536])
def test_lowest_by_hash_matches_a_sort(spark, buckets):
    df = spark.range(1000).select("id", (F.col("id") % 3 == 0).cast("int").alias("g"), lcg("id", seed=9).alias("h"))
    quota = spark.createDataFrame([(0, 100), (1, 40)], "g int, quota bigint")
    got = {r["id"] for r in flag_lowest(df, F.col("h"), ["id"], quota, ["g"], buckets=buckets).filter("picked").collect()}
    rows = df.collect()
    want = set()
    for g, n in ((0, 100), (1, 40)):
        want |= {r["id"] for r in sorted((r for r in rows if r["g"] == g), key=lambda r: (r["h"], r["id"]))[:n]}
    assert got == want


def test_split_by_text_keys(spark):
    rows = [(f"dir/{i % 7}.py", i, int(i % 5 == 0)) for i in range(300)] + [(None, 300, 1)]
    df = spark.createDataFrame(rows, "path string, line int, label int")
    out = P.stratified_split(df, ["path", "line"])
    assert out.columns == [*df.columns, "is_train"] and out.filter("NOT is_train").count() == math.ceil(0.3 * 301)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") <= 5 and "broadcast" not in plan.lower()
    assert sample_n_trials(df, ["path", "line"], 11).count() == 11


def test_samples(spark):
    df = spark.range(4000)
    assert sample_n_trials(df, "id", 37).count() == 37
    assert sample_n_trials(df.limit(5), "id", 37).count() == 5
    assert sample_n_trials(df, "id", 0).count() == 0
    assert 300 < sample_trials(df, "id", 0.1).count() < 500
    big = spark.range(5_000_000_000, 5_000_000_100)
    assert sample_n_trials(big, "id", 10).count() == 10


def test_merging(spark):
    train = spark.createDataFrame([("a", "t"), ("b", "t")], "file string, v string")
    feedback = spark.createDataFrame([("b", "f"), ("c", "f"), ("c", "g")], "file string, v string")
    assert sorted(map(tuple, P.merge_pools(train, feedback).collect())) == [("a", "t"), ("b", "t"), ("c", "f"), ("c", "g")]
    assert sorted(map(tuple, P.merge_pools(train, feedback, last_wins=True).collect())) == [
        ("a", "t"), ("b", "f"), ("c", "f"), ("c", "g")]
    assert P.merge_pools(train, feedback.limit(0)).count() == 2
    assert P.pool_overlap(train, feedback).collect()[0]["file"] == "b"
    assert [r["file"] for r in P.unseen_only(feedback, train).select("file").distinct().collect()] == ["c"]


def test_overlap_by_content(spark):
    a = spark.createDataFrame([("x", "same"), ("y", "own")], "file string, content string")
    b = spark.createDataFrame([("z", "same"), ("w", "same")], "file string, content string")
    assert P.content_overlap(a, b).count() == 1 and P.pool_overlap(a, b).count() == 0


def test_labelled_dataset_keeps_only_judged_units(spark):
    feats = spark.createDataFrame([("p", 1, "f", 3), ("p", 9, "f", 4)], "path string, line int, file string, n_loc int")
    verdicts = spark.createDataFrame([("p", 1, 1)], "path string, line int, label int")
    assert [tuple(r) for r in P.labelled_dataset(feats, verdicts, columns=["n_loc"]).collect()] == [(3, 1, "f")]
