import random

import pytest
from pyspark.sql import functions as F

from pactum.operators.state import running_state, stateful_check
from pactum.plans.scan import running_sum


def _rows(seed, n=900):
    """Rows of which one key holds about half; order values repeat, ids do not."""
    rng = random.Random(seed)
    return [("hot" if rng.random() < 0.5 else f"k{rng.randint(0, 40)}", rng.randint(0, 200), i, rng.randint(-9, 9))
            for i in range(n)]


def _by_hand(rows, start, clamped):
    out, state = {}, {}
    for key, t, i, x in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        level = state.get(key, start) + x
        state[key] = max(0, level) if clamped else level
        out[i] = state[key]
    return out


@pytest.mark.parametrize("seed", [1, 60, 7])
@pytest.mark.parametrize("clamped", [False, True])
def test_hot_keys_are_split_exactly(spark, seed, clamped):
    rows = _rows(seed)
    df = spark.createDataFrame(rows, "k string, t bigint, id bigint, x bigint")
    out = running_state(df, ["k"], ["t", "id"], "x", start=10, clamped=clamped)
    assert {r["id"]: r["balance"] for r in out.collect()} == _by_hand(rows, 10, clamped)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_any_number_of_parts(spark, parts):
    rows = _rows(1)
    df = spark.createDataFrame(rows, "k string, t bigint, id bigint, x bigint")
    out = running_sum(df, ["k"], ["t", "id"], "x", 0, partitions=parts)
    assert out.columns == ["k", "t", "id", "x", "total", "lowest"]
    assert {r["id"]: r["total"] for r in out.collect()} == _by_hand(rows, 0, False)


def test_one_order_value_for_all(spark):
    df = spark.createDataFrame([("k", 1, i, 1) for i in range(50)], "k string, t bigint, id bigint, x bigint")
    out = running_sum(df, ["k"], ["t", "id"], "x", 0, partitions=7)
    assert sorted(r["total"] for r in out.collect()) == list(range(1, 51))
    tied = running_sum(df, ["k"], ["t"], "x", 0, partitions=7)
    assert sorted(r["total"] for r in tied.collect()) == list(range(1, 51))


def test_time_order(spark):
    df = spark.createDataFrame(_rows(2), "k string, t bigint, id bigint, x bigint")
    timed = df.withColumn("t", F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, t)"))
    out = running_sum(timed, ["k"], ["t", "id"], "x", 0, partitions=20)
    assert {r["id"]: r["total"] for r in out.collect()} == _by_hand(_rows(2), 0, False)


def _fold(rows, start):
    """Totals and minima of (key, order, id, x) rows, NULL first, NULL amounts adding nothing."""
    out, state = {}, {}
    first = lambda v: (v is not None, "" if v is None else v)
    for k, t, i, x in sorted(rows, key=lambda r: (first(r[0]), first(r[1]), r[2])):
        total, low = state.get(k, (None, None))
        if x is not None:
            total = (total or 0) + x
        low = total if low is None else min(low, total)
        state[k] = (total, low)
        out[i] = (None if total is None else total + start, None if low is None else low + start)
    return out


@pytest.mark.parametrize("parts", [1, 4, 25])
@pytest.mark.parametrize("order", ["text", "iso date", "constant"])
def test_null_and_text_orders(spark, parts, order):
    rng = random.Random(parts)
    value = {"text": lambda: rng.choice("abcdefg"), "iso date": lambda: f"2024-01-{rng.randint(10, 28)}", "constant": lambda: "same"}[order]
    rows = [(rng.choice([None, None, "a", "b"]), rng.choice([None, value(), value()]), i, rng.choice([None, *range(-5, 6)])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t string, id bigint, x bigint").withColumn("m", F.create_map(F.lit("a"), "id"))
    out = running_sum(df.repartition(5), ["k"], ["t", "id"], "x", 3, partitions=parts)
    assert {r["id"]: (r["total"], r["lowest"]) for r in out.collect()} == _fold(rows, 3)


def test_rejected_rows_leave_the_state_alone(spark):
    df = spark.createDataFrame([("k", 1, 5), ("k", 2, -100), ("k", 3, 1)], "k string, t int, x int")
    v = stateful_check(df, ["k"], ["t"], "x", ["balance >= 0"], requires="x > 0").first()
    assert (v["n_rows"], v["n_checked"], v["n_failed"], v["label"], v["lowest_balance"]) == (3, 2, 0, 0, 15)
    bad = stateful_check(df, ["k"], ["t"], "x", ["balance >= 0"]).first()
    assert (bad["label"], bad["n_failed"]) == (1, 2)
