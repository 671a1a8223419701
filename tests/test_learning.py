import pytest
from pyspark.sql import functions as F

from pactum.operators import learn as L
from pactum.operators import promotion as G
from pactum.operators import risk as H
from pactum.operators.features import (DATASET_SCHEMA, FEATURE_COLS, check_schema, contract_features,
                                       drop_special_units, feature_columns)
from pactum.operators.monitor import feature_drift, high_risk_surge, recall_drop
from pactum.policy import Family, Policy
from pactum.sources.datasets import read_dataset, write_dataset
from pactum.sources.models import has_model, load_model


@pytest.fixture(scope="module")
def points(spark):
    return spark.range(240).select(
        "id", (F.col("id") % 7).cast("int").alias("x"), ((F.col("id") * 31) % 11).cast("int").alias("y"),
        ((F.col("id") % 7) + (F.col("id") * 31) % 11 > 9).cast("int").alias("label")).cache()


SMALL = Policy(families=(Family("logistic"), Family("forest", True, {"n_estimators": 5})))


@pytest.fixture(scope="module")
def candidates(points):
    split = L.split_once(points, "id", ["x", "y"], SMALL)
    return {f.name: L.train_candidate(split, f.name, ["x", "y"], f.params) for f in SMALL.families}


def test_unknown_family():
    with pytest.raises(ValueError, match="no model family"):
        L.build_model("svm")


def test_logistic_penalty_matches_summed_losses(spark):
    assert L.build_model("logistic", n_rows=50).getRegParam() == 1 / 50
    assert not L.build_model("logistic").getStandardization()


def test_candidates_learn_and_hold_out(candidates):
    for c in candidates.values():
        assert c.validation.count() == 72
        assert L.recall_by(c.validation).first()["recall"] > 0.7
        assert c.validation.filter("score < 0 OR score > 1").count() == 0


def test_fits_repeat(points, candidates):
    split = L.split_once(points.repartition(5, "y"), "id", ["x", "y"], SMALL)
    again = L.train_candidate(split, "forest", ["x", "y"], {"n_estimators": 5})
    key = lambda df: sorted(map(tuple, df.select("id", F.round("score", 9)).collect()))
    assert key(again.validation) == key(candidates["forest"].validation)


def _predicted(spark, pairs, name="m"):
    return spark.createDataFrame([(name, a, b) for a, b in pairs], "name string, label int, prediction int")


def test_report_by_hand(spark):
    df = _predicted(spark, [(1, 1)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(0, 0)] * 4)
    rep = {r["class"]: r for r in L.classification_report(df, ["name"]).collect()}
    assert (rep["1"]["precision"], rep["1"]["recall"], rep["1"]["support"]) == (0.6, 0.75, 4)
    assert rep["0"]["precision"] == 0.8 and rep["accuracy"]["f1"] == 0.7
    assert rep["macro avg"]["recall"] == pytest.approx((0.75 + 4 / 6) / 2)
    assert rep["weighted avg"]["precision"] == pytest.approx((0.6 * 4 + 0.8 * 6) / 10)


def test_no_positives_gives_zero_recall(spark):
    assert L.recall_by(_predicted(spark, [(0, 0), (0, 1)])).first()["recall"] == 0


def _evaluated(spark, *recalls):
    return spark.createDataFrame([(n, float(r), i + 1) for i, (n, r) in enumerate(recalls)], "name string, recall double, ord int")


def test_ties_go_to_the_earlier_candidate(spark):
    assert G.select_champion(_evaluated(spark, ("logistic", 0.5), ("forest", 0.5))).first()["name"] == "logistic"
    assert G.select_champion(_evaluated(spark, ("logistic", 0.5), ("forest", 0.6))).first()["name"] == "forest"
    assert G.select_champion(_evaluated(spark, ("x", 1.0)).limit(0)).count() == 0


@pytest.mark.parametrize("recall, decision", [(0.30, "promoted"), (0.2999, "blocked"), (0.0, "blocked")])
def test_gate(spark, recall, decision):
    champion = G.select_champion(_evaluated(spark, ("forest", recall)))
    assert G.promotion_gate(champion).first()["decision"] == decision
    assert G.promotion_gate(champion, Policy.from_mapping({})).first()["decision"] == "promoted"


def test_only_better_challengers_replace(spark):
    gated = G.promotion_gate(G.select_champion(_evaluated(spark, ("forest", 0.5))))
    now = lambda *r: G.promote_only_if_better(gated, spark.createDataFrame([(x,) for x in r], "recall double")).first()["decision"]
    assert (now(0.5), now(0.4), now()) == ("kept", "promoted", "promoted")


def test_promotion_end_to_end(spark, tmp_path, points, candidates):
    root = str(tmp_path)
    models = {n: c.model for n, c in candidates.items()}
    scored = G.score_candidates(models, points.filter("id % 3 = 0"))
    decision = G.promotion_gate(G.select_champion(G.evaluate_candidates(scored, list(models))))
    assert not has_model(spark, root)
    name = G.promote(models, decision, root)
    assert name in models and has_model(spark, root)
    assert list(G.stored_candidates(spark, root, ["logistic", "best_model"])) == ["best_model"]
    champion = L.predict(load_model(root), points)
    assert sorted(map(tuple, champion.select("id", "prediction").collect())) == \
        sorted(map(tuple, L.predict(models[name], points).select("id", "prediction").collect()))
    blocked = decision.withColumn("decision", F.lit("blocked"))
    assert G.promote(models, blocked, root) is None


@pytest.mark.parametrize("n, champion, want", [(0, True, False), (1, True, False), (2, True, True), (0, False, True)])
def test_retraining(spark, n, champion, want):
    assert G.retrain_decision(spark.range(n), champion).first()["retrain"] is want


def test_event_log(spark, tmp_path):
    from datetime import datetime

    path = str(tmp_path / "log")
    G.log_events(spark, path, [(datetime(2024, 1, 2), "run", "evaluate", "t", "ok")])
    G.log_events(spark, path, [(datetime(2024, 1, 1), "run", "train", "d", "ok")])
    log = spark.read.parquet(path)
    told = G.traces(log).orderBy("step").collect()
    assert [(r["case_id"], r["step"], r["activity"]) for r in told] == [("run", 1, "train"), ("run", 2, "evaluate")]


def test_bands(spark):
    df = spark.createDataFrame([(s,) for s in (0.0, 0.1999, 0.2, 0.5999, 0.6, 1.0)], "score double")
    levels = [r["level"] for r in H.band(df).orderBy("score").collect()]
    assert levels == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH"]


def test_run_order_is_by_name(spark):
    files = spark.createDataFrame([("b",), ("a",), ("c",)], "file string")
    assert [r["file"] for r in H.run_order(files).collect()] == ["a", "b", "c"]


def test_feedback_is_idempotent(spark):
    scores = spark.createDataFrame([("a", "LOW"), ("a", "HIGH"), ("b", "MEDIUM"), ("c", "HIGH")], "file string, level string")
    pool = spark.createDataFrame([("c",)], "file string")
    new = H.collect_feedback(scores, pool)
    assert [r["file"] for r in new.collect()] == ["a"]
    assert H.collect_feedback(scores, pool.unionByName(new)).count() == 0


def test_top_risk_limits_before_the_shuffle(spark):
    scores = spark.range(1000).select("id", (F.col("id") % 3).alias("file"), (F.col("id") / 1000).alias("score"))
    top = H.top_risk(scores, 2, ["id"], ["file"])
    assert sorted(r["id"] for r in top.collect()) == [994, 995, 996, 997, 998, 999]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_schema_checks(spark, tmp_path):
    units = spark.createDataFrame([("p", "f", 1, ["self"], ["r"], ["e == -1"], None, 3)],
                                  "path string, name string, line int, params array<string>, requires array<string>, "
                                  "ensures array<string>, invariant array<string>, n_loc int")
    table = contract_features(units, ("name",))
    assert feature_columns(table) == list(FEATURE_COLS)
    assert tuple(table.first())[1:] == (1, 1, 1, 0, 3, 1, 0, 1, 7, 1, 1)
    check_schema(table, FEATURE_COLS)
    with pytest.raises(ValueError):
        check_schema(table.drop("n_loc"), FEATURE_COLS)
    data = table.drop("name").withColumn("label", F.lit(1)).withColumn("source_file", F.lit("f.py"))
    assert data.columns == DATASET_SCHEMA.fieldNames()
    for form in ("parquet", "csv"):
        path = str(tmp_path / form)
        write_dataset(data, path, form)
        write_dataset(data, path, form)
        assert [tuple(r) for r in read_dataset(spark, path, format=form).collect()] == [tuple(r) for r in data.collect()]
    with pytest.raises(Exception):
        read_dataset(spark, str(tmp_path / "gone")).count()


def test_special_units(spark):
    df = spark.createDataFrame([("__init__",), ("__x",), ("y__",), ("f",)], "name string")
    assert {r["name"] for r in drop_special_units(df).collect()} == {"__x", "y__", "f"}


def test_drift_is_zero_on_the_same_data_and_grows(spark):
    base = spark.range(1000).select((F.col("id") % 100).alias("v"), F.lit(1).alias("c"))
    same = {r["feature"]: r["psi"] for r in feature_drift(base, base, ["v", "c"]).collect()}
    assert same["v"] == pytest.approx(0) and same["c"] == pytest.approx(0)
    moved = feature_drift(base, base.withColumn("v", F.col("v") + 50), ["v"]).first()
    assert moved["psi"] > 0.5 and moved["mean_shift"] == pytest.approx(50)


def test_signals(spark):
    runs = spark.createDataFrame([(1, 0.5), (2, 0.4), (3, 0.4)], "run int, recall double")
    assert [r["dropped"] for r in recall_drop(runs).orderBy("run").collect()] == [False, True, False]
    events = spark.sql("SELECT timestamp'2024-01-01' + make_interval(0, 0, 0, 0, id) AS ts, id >= 24 AS bad FROM range(48)")
    rows = high_risk_surge(events, "ts", F.col("bad"), "1 day", 0.5).orderBy("start").collect()
    assert [(r["n"], r["n_high"], r["surge"]) for r in rows] == [(24, 0, False), (24, 24, True)]


def test_policy_from_config():
    p = Policy.from_mapping({"models": {"logistic": {"enabled": False}, "forest": {"n_estimators": 7}},
                             "risk_thresholds": {"low": 0.1}, "mlops": {"min_recall_risky": 0.5}})
    assert G.enabled_families(p) == ["forest"] and p.low == 0.1 and p.medium == 0.6 and p.min_recall == 0.5


def test_policy_file(tmp_path):
    path = tmp_path / "config.json"
    path.write_text('{"mlops": {"feedback_trigger_size": 5}}')
    assert Policy.from_file(str(path)).feedback_trigger == 5


def test_drift_leaves_nulls_out(spark):
    from pactum.operators.monitor import feature_drift

    values = [(float(v),) for v in range(100)]
    base = spark.createDataFrame(values, "x double")
    with_nulls = spark.createDataFrame(values + [(None,)] * 10, "x double")
    row = feature_drift(base, with_nulls, ["x"]).first()
    assert (row["n_base"], row["n_other"], row["n_null_base"], row["n_null_other"]) == (100, 100, 0, 10)
    assert abs(row["psi"]) < 1e-12 and abs(row["mean_shift"]) < 1e-12
    for a, b in ((base, base.limit(0)), (base.limit(0), base)):
        row = feature_drift(a, b, ["x"]).first()
        assert row["mean_shift"] is None and row["psi"] is not None
    assert feature_drift(base.limit(0), base.limit(0), ["x"]).count() == 0


def test_entries_are_added_once(spark, tmp_path):
    from pactum.sources.registry import add_once, read_entries

    table, schema = str(tmp_path / "t"), "n int"
    assert read_entries(spark, table, schema).count() == 0
    rows = spark.createDataFrame([(1,), (2,)], schema)
    assert add_once(rows, table, "7") and not add_once(rows, table, "7") and add_once(rows.limit(1), table, "a.0001")
    # What a write that failed left behind has no committed file and is replaced.
    (tmp_path / "t" / "entry=half" / "_temporary").mkdir(parents=True)
    assert add_once(rows.limit(1), table, "half")
    told = read_entries(spark, table, schema).collect()
    assert sorted((r["entry"], r["n"]) for r in told) == [("7", 1), ("7", 2), ("a.0001", 1), ("half", 1)]
    for bad in ("", "a/b", "a b", ".x"):
        with pytest.raises(ValueError):
            add_once(rows, table, bad)


def test_steps_are_logged_once(spark, tmp_path):
    root = str(tmp_path)
    for outcome in ("1 rows", "2 rows"):
        G.log_step(spark, root, "run", 2, "score", "all", outcome)
    G.log_step(spark, root, "run", 1, "train", "forest", "ok")
    told = G.traces(G.run_log(spark, root), ["entry"]).orderBy("step").collect()
    assert [(r["step"], r["activity"], r["outcome"]) for r in told] == [(1, "train", "ok"), (2, "score", "1 rows")]


@pytest.fixture(scope="module")
def loop_pools(spark):
    """Files of three rows, x set in one row of every other file: x alone makes old rows risky, later ones all are but every seventh."""
    rows = spark.range(300).selectExpr("id", "CAST(id DIV 3 AS STRING) AS file", "CAST(id % 6 = 0 AS INT) AS x")
    rows = rows.withColumn("label", F.expr("CAST(x = 1 OR id >= 60 AND id % 7 > 0 AS INT)"))
    part = {"train": "id < 21", "test": "id >= 21 AND id < 60", "unseen": "id >= 60"}
    return {name: rows.filter(cond) for name, cond in part.items()}


LOOP_POLICY = Policy(families=(Family("forest", True, {"n_estimators": 3, "max_depth": 1, "bootstrap": False}),))


def test_loop_ends_and_a_repeated_run_adds_nothing(spark, loop_pools, tmp_path):
    from pactum.plans.cycle import run_loop

    def loop():
        return run_loop(loop_pools["train"], loop_pools["train"].limit(0), loop_pools["test"], loop_pools["unseen"], ["x"], str(tmp_path),
                        "id", "file", LOOP_POLICY, "night")

    turns = loop()
    added = [t.feedback.count() for t in turns]
    assert added == [40, 40, 0]  # files with x; those without it, once rows of the first have trained; none
    promoted = sorted(map(tuple, G.promotions(spark, str(tmp_path)).collect()))
    log = sorted(map(tuple, G.run_log(spark, str(tmp_path)).collect()))
    assert [p[0] for p in promoted] == [1, 2, 3] and len(log) == 5 * len(turns)
    assert G.champion(spark, str(tmp_path))["entry"] == "night.0003"
    assert [t.feedback.count() for t in loop()] == added
    assert sorted(map(tuple, G.promotions(spark, str(tmp_path)).collect())) == promoted
    assert sorted(map(tuple, G.run_log(spark, str(tmp_path)).collect())) == log


def test_blocked_loop_scores_nothing(spark, loop_pools, tmp_path):
    from dataclasses import replace

    from pactum.plans.cycle import run_loop

    turns = run_loop(loop_pools["train"], loop_pools["train"].limit(0), loop_pools["test"], loop_pools["unseen"], ["x"], str(tmp_path),
                     "id", "file", replace(LOOP_POLICY, min_recall=1.1))
    assert len(turns) == 1 and turns[0].scores is None and G.champion(spark, str(tmp_path)) is None
    assert [r["outcome"] for r in G.run_log(spark, str(tmp_path)).orderBy("entry").collect()][1:] == ["blocked"]


def test_promotion_of_a_run_is_made_once(spark, loop_pools, tmp_path):
    from pyspark.ml import Pipeline

    from pactum.operators.features import assembler

    def fit(label):
        return Pipeline(stages=[assembler(["x"]), L.build_model("forest", LOOP_POLICY.families[0].params)]).fit(
            loop_pools["train"].withColumn("label", F.expr(label)))

    decision = spark.createDataFrame([("forest", 0.5, "promoted")], "name string, recall double, decision string")
    root = str(tmp_path)
    first = G.promote_once({"forest": fit("x")}, decision, root, "a")
    assert (first["version"], first["entry"]) == (1, "a")
    assert G.promote_once({"forest": fit("1 - x")}, decision, root, "a") == first
    assert G.promote_once({}, decision.withColumn("decision", F.lit("kept")), root, "b") is None
    second = G.promote_once({"forest": fit("1 - x")}, decision, root, "c")
    assert second["version"] == 2 and G.champion(spark, root) == second
    for row, want in ((first, 1), (second, 0)):
        assert L.predict(G.champion_model(spark, root, row), loop_pools["test"]).filter("x = 1").first()["prediction"] == want


def test_node_table_walks_to_the_same_scores(spark):
    from pyspark.ml import Pipeline

    from pactum.operators.features import assembler

    df = spark.range(400).selectExpr("id", "id % 17 AS a", "(id * 7) % 23 AS b", "id % 5 AS c", "CAST((id % 17) * (id % 5) > 20 OR id % 31 = 0 AS INT) AS label")
    model = Pipeline(stages=[assembler(["a", "b", "c"]), L.build_model("forest", {"n_estimators": 12, "max_depth": 4})]).fit(df)
    nodes = L.forest_nodes(model)
    assert nodes.filter("left IS NULL AND feature IS NOT NULL").count() == 0 and nodes.select("tree").distinct().count() == 12
    # A node's rows are those of its children.
    sides = [nodes.selectExpr("tree", f"node AS {s}", f"n_safe + n_risky AS n_{s}") for s in ("left", "right")]
    assert nodes.join(sides[0], ["tree", "left"]).join(sides[1], ["tree", "right"]).filter("abs(n_safe + n_risky - n_left - n_right) > 1e-9").count() == 0
    walked = {r["id"]: (r["n_trees"], r["score"]) for r in L.walk_forest(nodes, df, ["id"], 4).collect()}
    for r in L.predict(model, df).collect():
        assert walked[r["id"]] == (12, pytest.approx(r["score"], abs=1e-12))
    # Trees without a split are their root alone.
    flat = Pipeline(stages=[assembler(["a"]), L.build_model("forest", {"n_estimators": 2, "max_depth": 2})]).fit(df.withColumn("label", F.lit(0)).withColumn("a", F.lit(1)))
    assert {tuple(r)[1:] for r in L.walk_forest(L.forest_nodes(flat), df.limit(5), ["id"]).collect()} == {(2, 0.0)}
