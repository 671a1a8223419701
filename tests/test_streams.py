import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactum.operators.contracts import Contract, check_contracts
from pactum.operators.learn import predict
from pactum.operators.pools import merge_pools
from pactum.operators.state import running_state
from pactum.plans.cycle import run_cycle
from pactum.policy import Family, Policy
from pactum.sources.corpus import stream_corpus, stream_table
from pactum.sources.models import load_model
from pactum.streaming import checks, loop, sinks, windows


@pytest.fixture
def events(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet")


def _paths(tmp_path):
    return str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")


CONTRACTS = [Contract("even", "value", ["event_type <> 'view'"], ["result < 100"]),
             Contract("ratio", "try_divide(value, event_id % 3)", [], ["result < 400"])]


def test_contract_check_equals_batch_after_every_run(spark, tmp_path, events):
    src, out, ckpt = _paths(tmp_path)
    schema = check_contracts(events, CONTRACTS).schema
    for part in range(3):
        events.filter(F.col("event_id") % 3 == part).coalesce(2).write.mode("append").parquet(src)
        checks.stream_contract_check(stream_table(spark, src, files_per_trigger=1), CONTRACTS, out, ckpt)
        batch = check_contracts(events.filter(F.col("event_id") % 3 <= part), CONTRACTS)
        assert sorted(map(tuple, sinks.last_batch(spark, out, schema).collect())) == sorted(map(tuple, batch.collect()))


@pytest.mark.parametrize(("clamped", "kind"), [(False, "BIGINT"), (True, "BIGINT"), (True, "DECIMAL(12,2)")])
def test_state_is_carried_by_the_engine_over_restarts(spark, tmp_path, events, clamped, kind):
    src, out, ckpt = _paths(tmp_path)
    moves = events.select("user_id", "ts", "event_id", F.expr(
        f"CAST(value AS {kind}) * CASE WHEN event_type = 'error' THEN -3 ELSE 1 END").alias("move"), "event_type")
    days = [("2024-01-01", "2024-01-08"), ("2024-01-08", "2024-01-20"), ("2024-01-20", "2024-01-21"), ("2024-01-21", "2024-03-01")]

    def check():
        checks.stream_state_check(stream_table(spark, src, files_per_trigger=1), ["user_id"], ["ts", "event_id"], "move", "balance >= 50",
                                  out, ckpt, "event_type <> 'view'", 10, clamped)

    for lo, hi in days:
        moves.filter((F.col("ts") >= lo) & (F.col("ts") < hi)).coalesce(1).write.mode("append").parquet(src)
        check()
    told = spark.read.parquet(out)
    assert told.select("batch_id").distinct().count() == 4 and told.schema["balance"].dataType.simpleString().startswith(kind[:6].lower())
    got = told.groupBy("user_id").agg(F.sum("n_rows"), F.sum("n_checked"), F.sum("n_failed"), F.sum("n_late"), F.max_by("balance", "batch_id"))
    levels = running_state(moves, ["user_id"], ["ts", "event_id"], "move", "event_type <> 'view'", 10, clamped)
    want = levels.groupBy("user_id").agg(
        F.count("*"), F.count_if("admitted"), F.count_if(F.col("admitted") & (F.col("balance") < 50)), F.lit(0),
        F.max_by(F.col("balance"), F.struct("ts", "event_id")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    check()  # nothing new has come
    assert spark.read.parquet(out).count() == told.count()


def test_late_rows_null_keys_and_exact_balances(spark, tmp_path):
    src, out, ckpt = _paths(tmp_path)
    big = 2**62
    parts = [[("a", 2, big), ("a", 1, 1), (None, 1, 5), (None, None, 7)], [("a", 1, -1), ("b", 9, None), (None, 3, 1)], [("a", 3, -big), ("b", 9, 4)]]
    for part in parts:
        spark.createDataFrame(part, "k string, t int, move long").coalesce(1).write.mode("append").parquet(src)
        checks.stream_state_check(stream_table(spark, src), ["k"], ["t"], "move", "balance >= 0", out, ckpt, start=0)
    rows = {(r["batch_id"], r["k"]): (r["n_rows"], r["n_late"], r["balance"]) for r in spark.read.parquet(out).collect()}
    assert rows == {(0, "a"): (2, 0, big + 1), (0, None): (2, 0, 12), (1, "a"): (1, 1, big), (1, "b"): (1, 0, 0), (1, None): (1, 0, 13),
                    (2, "a"): (1, 0, 0), (2, "b"): (1, 0, 4)}


def test_null_whole_number_keys_and_session_times(spark, tmp_path):
    """A NULL key among whole numbers is one key; places in time keep their order and lateness over a restart."""
    src, out, ckpt = _paths(tmp_path)
    parts = [[(None, "2024-01-01 00:00:03", -9), (7, "2024-01-01 00:00:02", 1), (None, "2024-01-01 00:00:01", 4), (None, "2024-01-01 00:00:02", 6)],
             [(None, "2024-01-01 00:00:02", -2), (7, "2024-01-01 00:00:03", None)]]
    for part in parts:
        rows = spark.createDataFrame(part, "k long, at string, move int").withColumn("at", F.col("at").cast("timestamp"))
        rows.coalesce(1).write.mode("append").parquet(src)
        checks.stream_state_check(stream_table(spark, src), ["k"], ["at"], "move", "balance >= 0", out, ckpt, start=0)
    got = {(r["batch_id"], r["k"]): (r["n_rows"], r["n_failed"], r["n_late"], r["balance"]) for r in spark.read.parquet(out).collect()}
    assert got == {(0, None): (3, 0, 0, 1), (0, 7): (1, 0, 0, 1), (1, None): (1, 1, 1, -1), (1, 7): (1, 0, 0, 1)}


def test_balances_of_many_keys_need_no_table_each():
    """One call a key, on plain rows: 20,000 keys of four rows take seconds, not a minute of small tables."""
    held = {}

    class State:
        def get(self):
            return held.get(self.key)

        def update(self, value):
            held[self.key] = value

    shape = T.StructType().add("k", "long").add("at", "long").add("state_change", "long").add("state_late", "boolean").add("state_balance", "long")
    balances = checks._Balance(T.StructType(), ["at"], shape, 10, False, object)
    balances.state, start = State(), time.perf_counter()
    for batch in range(2):
        for key in range(10_000):
            balances.state.key = key
            told = list(balances.handleInputRows((key,), iter([Row(k=key, at=4 * batch - t, state_change=t) for t in range(4)]), None))
            assert [r.at for r in told] == [4 * batch - t for t in (3, 2, 1, 0)]
    assert held[5] == (22, 4) and [(r.state_late, r.state_balance) for r in told] == [(False, 19), (False, 21), (False, 22), (False, 22)]
    assert time.perf_counter() - start < 15


def test_no_batch_reads_what_earlier_ones_wrote(spark, tmp_path, monkeypatch):
    src, out, ckpt = _paths(tmp_path)
    monkeypatch.setattr(sinks, "read_batches", None)
    rows = spark.range(30).selectExpr("concat('f', id % 7) AS file", "'HIGH' AS level", "id")
    for k in range(30):
        rows.filter(F.col("id") == k).coalesce(1).write.mode("append").parquet(src)
    loop.stream_feedback(stream_table(spark, src, files_per_trigger=1), out, ckpt)
    loop.feedback_trigger(stream_table(spark, src, files_per_trigger=1), f"{out}2", f"{ckpt}2")
    assert sorted(r["file"] for r in spark.read.parquet(out).collect()) == [f"f{k}" for k in range(7)]
    decisions = spark.read.parquet(f"{out}2")
    assert decisions.count() >= 30 and decisions.agg(F.max("n_feedback")).first()[0] == 30


def test_feedback_is_taken_once(spark, tmp_path):
    src, out, ckpt = _paths(tmp_path)
    rows = [[("a", "HIGH"), ("b", "LOW")], [("a", "HIGH"), ("c", "HIGH")], [("b", "MEDIUM"), ("c", "HIGH")]]
    for batch in rows:
        spark.createDataFrame(batch, "file string, level string").coalesce(1).write.mode("append").parquet(src)
        loop.stream_feedback(stream_table(spark, src), out, ckpt)
    assert sorted(r["file"] for r in spark.read.parquet(out).collect()) == ["a", "c"]


def test_trigger_counts_over_batches(spark, tmp_path):
    src, out, ckpt = _paths(tmp_path)
    seen = []
    for name in ("a", "b", "c"):
        spark.createDataFrame([(name,)], "file string").coalesce(1).write.mode("append").parquet(src)
        loop.feedback_trigger(stream_table(spark, src), out, ckpt)
        last = spark.read.parquet(out).orderBy(F.desc("batch_id")).first()
        seen.append((last["n_feedback"], last["retrain"]))
    assert seen == [(1, False), (2, True), (3, True)]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    out = str(tmp_path / "out")
    for _ in range(2):
        spark.range(3).write.mode("overwrite").parquet(f"{out}/batch_id=0")
    assert sinks.read_batches(spark, out, spark.range(1).schema).count() == 3
    assert sinks.read_batches(spark, out, spark.range(1).schema, before=0).count() == 0


def test_closed_windows_equal_batch(spark, tmp_path, events):
    src, out, ckpt = _paths(tmp_path)
    late = events.orderBy(F.desc("ts")).limit(1).withColumn("ts", F.expr("ts + INTERVAL 10 DAYS"))
    events.unionByName(late).coalesce(1).write.parquet(src)
    flag = F.col("event_type") == "error"
    sinks.append_to(windows.stream_surge(stream_table(spark, src), "ts", flag, "6 hours", "1 hour"), out, ckpt)
    batch = events.groupBy(F.window(F.col("ts").cast("timestamp"), "6 hours").alias("w")).agg(
        F.count("*"), F.count_if(flag)).select("w.start", "w.end", "count(1)", f"count_if({'(event_type = error)'})")
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, batch.collect()))


def test_copies_are_dropped_across_batches(spark, tmp_path, events):
    src, out, ckpt = _paths(tmp_path)
    for _ in range(2):
        events.coalesce(1).write.mode("append").parquet(src)
        sinks.append_to(windows.stream_dedup(stream_table(spark, src), "ts", "60 days", ["event_id"]).select("event_id"),
                        out, ckpt)
    got = spark.read.parquet(out)
    assert got.count() == got.distinct().count() == events.count()


def test_files_arrive_whole(spark, tmp_path):
    src, out, ckpt = _paths(tmp_path)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.py").write_text("def f():\n    pass\n")
    (tmp_path / "in" / "b.txt").write_text("no")
    sinks.append_to(stream_corpus(spark, src), out, ckpt)
    assert [(r["file"], r["content"]) for r in spark.read.parquet(out).collect()] == [("a.py", "def f():\n    pass\n")]


def test_full_cycle(spark, tmp_path):
    rows = spark.range(400).select(
        "id", F.concat(F.lit("f"), F.col("id") % 40).alias("file"), (F.col("id") % 7).cast("int").alias("x"),
        ((F.col("id") * 31) % 11).cast("int").alias("y"),
        ((F.col("id") % 7) + (F.col("id") * 31) % 11 > 9).cast("int").alias("label"))
    train, test, unseen = rows.filter("id % 40 < 20"), rows.filter("id % 40 BETWEEN 20 AND 29"), rows.filter("id % 40 >= 30")
    policy = Policy(families=(Family("logistic"), Family("forest", True, {"n_estimators": 5})))
    none = train.limit(0)
    turn = run_cycle(train, none, test, unseen.drop("label"), ["x", "y"], str(tmp_path), policy=policy)
    assert turn.champion in ("logistic", "forest") and turn.scores.count() == unseen.count()
    new = {r["file"] for r in turn.feedback.collect()}
    high = {r["file"] for r in turn.scores.filter("level = 'HIGH'").collect()}
    assert new == high and new
    assert predict(load_model(str(tmp_path)), unseen).count() == unseen.count()
    feedback = unseen.filter(F.col("file").isin(*new))
    assert merge_pools(train, feedback).count() == train.count() + feedback.count()
    again = run_cycle(train, feedback, test, unseen.drop("label"), ["x", "y"], str(tmp_path),
                      policy=Policy(families=policy.families, promote_only_if_better=True))
    assert {r["file"] for r in again.feedback.collect()} & new == set()
    idle = run_cycle(train, none, test, unseen.drop("label"), ["x", "y"], str(tmp_path), policy=policy, always_retrain=False)
    assert not idle.retrained and idle.scores.count() == unseen.count()


def test_stream_without_a_champion_stops(spark, tmp_path):
    with pytest.raises(ValueError):
        loop.champion_scorer(str(tmp_path))(spark.createDataFrame([("a.py", "def f(x):\n    return x\n", "unseen")], "path string, content string, pool string"))
