"""Pools, training, evaluation and promotion over documents and labels."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from catalog.shared import (CODE_CTE, DOC_CTE, FEATURES, INTERCEPT_A, POOL_SQL, POOLED_CTE, PRED_CTE, SCORE_A_SQL, WEIGHTS_A, code_corpus,
                            documents, key_hash_sql, labelled, pooled, predictions, read, scored, split_sql)
from pactum.functions.metrics import linear_score
from pactum.operators import learn as L
from pactum.operators import pools as P
from pactum.operators import promotion as G
from pactum.operators.contracts import Contract, violating_rows
from pactum.operators.features import assembler, contract_features, drop_special_units, text_features
from pactum.operators.units import describe_units
from pactum.plans.cycle import run_loop
from pactum.plans.session import materialize, run_dir
from pactum.policy import Family, Policy
from pactum.sources.models import load_model, save_model

REGISTRY = ["logistic", "forest"]


# -- pools --------------------------------------------------------------------

def e1_labelled_dataset(spark, d):
    labels = read(spark, d, "labels").select("doc_id", (F.col("quality") == 0).cast("int").alias("label"))
    return P.labelled_dataset(documents(spark, d), labels, ["doc_id"], "source", FEATURES)


E1 = f"WITH {DOC_CTE} SELECT {', '.join(FEATURES)}, label, source AS source_file FROM lab"


def _train_and_rest(spark, d):
    docs = pooled(spark, d).select("file", "doc_id", "pool")
    return docs.filter("pool = 'train'").drop("pool"), docs.filter("pool <> 'train'").drop("pool")


def e2_merge_pools(spark, d):
    return P.merge_pools(*_train_and_rest(spark, d))


def e3_merge_last_wins(spark, d):
    return P.merge_pools(*_train_and_rest(spark, d), last_wins=True)


E2 = f"""WITH {POOLED_CTE} SELECT file, doc_id FROM pooled p WHERE pool = 'train'
 OR NOT EXISTS (SELECT 1 FROM pooled t WHERE t.pool = 'train' AND t.file = p.file)"""
E3 = f"""WITH {POOLED_CTE} SELECT file, doc_id FROM pooled p WHERE pool <> 'train'
 OR NOT EXISTS (SELECT 1 FROM pooled t WHERE t.pool <> 'train' AND t.file = p.file)"""


def e4_stratified_split(spark, d):
    labels = read(spark, d, "labels").select("doc_id", (F.col("quality") == 0).cast("int").alias("label"))
    return P.stratified_split(labels, "doc_id").select("doc_id", "label", "is_train")


E4 = f"""WITH l AS (SELECT doc_id, CASE WHEN quality = 0 THEN 1 ELSE 0 END AS label FROM labels),
r AS (SELECT *, count(*) OVER (PARTITION BY label) AS n, count(*) OVER () AS total,
  row_number() OVER (PARTITION BY label ORDER BY {key_hash_sql("doc_id", seed=42)}, doc_id) AS rn FROM l),
q AS (SELECT DISTINCT label, n, total - CAST(ceil(total * 3 / 10.0) AS BIGINT) AS train, total FROM r),
s AS (SELECT label, n * train // total AS base, n * train % total AS rest, train FROM q),
t AS (SELECT label, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= train - sum(base) OVER ()
  THEN 1 ELSE 0 END AS quota FROM s)
SELECT doc_id, label, rn <= quota AS is_train FROM r JOIN t USING (label)"""


def e5_pool_overlap(spark, d):
    """Texts shared between training documents and all others or the benchmark, by digest."""
    docs = pooled(spark, d)
    others = docs.filter("pool <> 'train'").select("text").unionByName(read(spark, d, "benchmark").select("text"))
    return P.content_overlap(docs.filter("pool = 'train'"), others, "text")


E5 = f"""WITH {POOLED_CTE} SELECT sha256(text) AS digest FROM pooled WHERE pool = 'train' INTERSECT
(SELECT sha256(text) FROM pooled WHERE pool <> 'train' UNION ALL SELECT sha256(text) FROM benchmark)"""


def e6_unseen_only(spark, d):
    docs = pooled(spark, d).select("file", "doc_id", "lang", "pool")
    pool = {name: docs.filter(F.col("pool") == name).drop("pool") for name in ("train", "test", "unseen")}
    return P.unseen_only(pool["unseen"], pool["train"], pool["test"])


E6 = f"""WITH {POOLED_CTE} SELECT file, doc_id, lang FROM pooled
WHERE pool = 'unseen' AND file NOT IN (SELECT file FROM pooled WHERE pool <> 'unseen')"""


def e7_pool_profile(spark, d):
    out = P.pool_profile(labelled(spark, d), FEATURES)
    return (out.withColumn("pool", F.coalesce("pool", F.lit("all")))
            .withColumn("label", F.coalesce(F.col("label").cast("string"), F.lit("all"))))


E7 = f"""WITH {DOC_CTE} SELECT coalesce(pool, 'all') AS pool, coalesce(CAST(label AS VARCHAR), 'all') AS label,
 CAST(grouping(pool, label) AS INT) AS level, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_risky,
 {", ".join(f"round(avg({c}), 6) AS mean_{c}, min({c}) AS min_{c}, max({c}) AS max_{c}" for c in FEATURES)} FROM lab GROUP BY ROLLUP (pool, label)"""


# -- training -----------------------------------------------------------------

# On one binary feature both families are saturated: without a penalty, or without bootstrap at
# depth 1, the fitted score is the mean label of the feature's value. So SQL can state the fits.
BINARY = ["is_long"]
SATURATED = Policy(families=(
    Family("logistic", True, {"max_iter": 1000, "penalty": 0.0}),
    Family("forest", True, {"n_estimators": 5, "max_depth": 1, "bootstrap": False})))


def _binary(spark, d):
    """Every document with its pool, whether it is long, and a label that differs from that for a quarter of them.

    A tree drops a split whose sides predict one class, so the classes must differ.
    """
    long = (F.col("n_tokens") > 200).cast("int")
    docs = text_features(read(spark, d, "documents")).select("doc_id", F.expr(POOL_SQL).alias("pool"), long.alias("is_long"))
    return docs.withColumn("label", F.when(F.col("doc_id") % 4 == 0, 1 - F.col("is_long")).otherwise(F.col("is_long")))


def _binary_train(spark, d):
    return _binary(spark, d).filter("pool = 'train'")


def _fit(spark, d, family):
    split = L.split_once(_binary_train(spark, d), "doc_id", BINARY, SATURATED)
    return L.train_candidate(split, family, BINARY, {f.name: f.params for f in SATURATED.families}[family])


BINARY_CTE = f"""k AS (SELECT doc_id, {POOL_SQL} AS pool,
  CAST(len(list_filter(regexp_split_to_array(text, '[ \\t\\r\\n\\f]+'), lambda x: x <> '')) > 200 AS INT) AS is_long FROM documents),
b AS (SELECT *, CASE WHEN doc_id % 4 = 0 THEN 1 - is_long ELSE is_long END AS label FROM k),
l AS (SELECT * FROM b WHERE pool = 'train'),
r AS (SELECT *, count(*) OVER (PARTITION BY label) AS n, count(*) OVER () AS total,
  row_number() OVER (PARTITION BY label ORDER BY {key_hash_sql("doc_id", seed=42)}, doc_id) AS rn FROM l),
q AS (SELECT DISTINCT label, n, total - CAST(ceil(total * 3 / 10.0) AS BIGINT) AS train, total FROM r),
s AS (SELECT label, n * train // total AS base, n * train % total AS rest, train FROM q),
t AS (SELECT label, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= train - sum(base) OVER ()
  THEN 1 ELSE 0 END AS quota FROM s),
split AS (SELECT doc_id, is_long, label, rn <= quota AS is_train FROM r JOIN t USING (label)),
fit AS (SELECT is_long, avg(label) AS score, CAST(avg(label) > 0.5 AS INT) AS prediction FROM split WHERE is_train GROUP BY 1)"""
_VALIDATION = f"WITH {BINARY_CTE} SELECT doc_id, label, prediction, round(score, 4) AS score FROM split JOIN fit USING (is_long) WHERE NOT is_train"
F1 = F2 = _VALIDATION


def f1_logistic(spark, d):
    return _fit(spark, d, "logistic").validation.select("doc_id", "label", "prediction", F.round("score", 4).alias("score"))


def f2_forest(spark, d):
    return _fit(spark, d, "forest").validation.select("doc_id", "label", "prediction", F.round("score", 4).alias("score"))


def f3_build_model(spark, d):
    """Every registered family fitted on the training pool, tagged with its name."""
    train = materialize(_binary_train(spark, d).select("doc_id", *BINARY, "label"), "train")
    n = train.count()
    models = {f.name: Pipeline(stages=[assembler(BINARY), L.build_model(f.name, f.params, n)]).fit(train)
              for f in SATURATED.families}
    return G.score_candidates(models, train).groupBy("name").agg(F.count("*").alias("n"), F.sum("prediction").alias("n_risky"))


F3 = f"""WITH {BINARY_CTE}, w AS (SELECT is_long, avg(label) AS score, count(*) AS k FROM l GROUP BY 1)
SELECT name, CAST(sum(k) AS BIGINT) AS n, CAST(sum(CASE WHEN score > 0.5 THEN k ELSE 0 END) AS BIGINT) AS n_risky
FROM w, (VALUES ('logistic'), ('forest')) AS v(name) GROUP BY 1"""


def f4_train_candidate(spark, d):
    return L.recall_by(_fit(spark, d, "forest").validation)


F4 = f"""WITH {BINARY_CTE}, hard AS (SELECT label, prediction FROM split JOIN fit USING (is_long) WHERE NOT is_train),
c AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
 count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 0 AND prediction = 0) AS tn FROM hard)
SELECT *, CAST(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS DOUBLE) AS recall FROM c"""


def f5_predict_label(spark, d):
    """Hard classes of both fitted families over the unseen pool."""
    unseen = materialize(_binary(spark, d).filter("pool = 'unseen'"), "unseen")
    split = L.split_once(_binary_train(spark, d), "doc_id", BINARY, SATURATED)
    rows = [L.predict(L.train_candidate(split, f.name, BINARY, f.params).model, unseen).select("doc_id", F.lit(f.name).alias("name"), "prediction")
            for f in SATURATED.families]
    return rows[0].unionByName(rows[1])


F5 = f"""WITH {BINARY_CTE} SELECT doc_id, name, prediction FROM b JOIN fit USING (is_long), (VALUES ('logistic'), ('forest')) AS v(name)
WHERE pool = 'unseen'"""


def f6_predict_score(spark, d):
    c = _fit(spark, d, "forest")
    return L.predict(c.model, _binary(spark, d).filter("pool = 'unseen'")).select("doc_id", F.round("score", 4).alias("score"), "prediction")


F6 = f"WITH {BINARY_CTE} SELECT doc_id, round(score, 4) AS score, prediction FROM b JOIN fit USING (is_long) WHERE pool = 'unseen'"


def f7_linear_score(spark, d):
    return documents(spark, d).select("doc_id", F.round(linear_score(WEIGHTS_A, INTERCEPT_A), 6).alias("score"))


F7 = f"WITH {DOC_CTE} SELECT doc_id, round({SCORE_A_SQL}, 6) AS score FROM feat"


def f8_confusion_counts(spark, d):
    return L.confusion_counts(predictions(spark, d), ["name"])


_CELLS = """count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
 count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 0 AND prediction = 0) AS tn"""
F8 = f"WITH {PRED_CTE} SELECT name, {_CELLS} FROM hard GROUP BY 1"


def f9_recall_risky(spark, d):
    return L.recall_by(predictions(spark, d), ["name", "source"]).select("name", "source", F.round("recall", 6).alias("recall"))


F9 = f"""WITH {PRED_CTE}, c AS (SELECT name, source, {_CELLS} FROM hard GROUP BY ALL)
SELECT name, source, round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall FROM c"""


def f10_classification_report(spark, d):
    out = L.classification_report(predictions(spark, d), ["name"])
    return out.select("name", "class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


F10 = f"""WITH {PRED_CTE},
k AS (SELECT name, CAST(c AS VARCHAR) AS class, count(*) FILTER (label = c AND prediction = c) AS hit,
  count(*) FILTER (prediction = c) AS said, count(*) FILTER (label = c) AS support
  FROM hard, (VALUES (0), (1)) AS v(c) GROUP BY ALL),
m AS (SELECT name, class, support, hit, CASE WHEN said = 0 THEN 0 ELSE hit / said END AS p,
  CASE WHEN support = 0 THEN 0 ELSE hit / support END AS r,
  CASE WHEN said + support = 0 THEN 0 ELSE 2 * hit / (said + support) END AS f FROM k),
o AS (SELECT name, class, p, r, f, support FROM m
 UNION ALL SELECT name, 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), sum(support) FROM m GROUP BY 1
 UNION ALL SELECT name, 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM m GROUP BY 1
 UNION ALL SELECT name, 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
   sum(f * support) / sum(support), sum(support) FROM m GROUP BY 1)
SELECT name, class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, CAST(support AS BIGINT) AS support FROM o"""


def a5_models(spark, d):
    """Save a fitted candidate, load it and score with the loaded one."""
    root = run_dir(spark, "models")
    c = _fit(spark, d, "logistic")
    save_model(c.model, root, "logistic")
    return L.predict(load_model(root, "logistic"), _binary_train(spark, d)).select("doc_id", "label", "prediction", F.round("score", 4).alias("score"))


A5 = f"WITH {BINARY_CTE} SELECT doc_id, label, prediction, round(score, 4) AS score FROM l JOIN fit USING (is_long)"


# -- the shipped policy on all features ---------------------------------------

def _full_candidate(spark, d, family):
    split = L.split_once(labelled(spark, d).filter("pool = 'train'"), "doc_id", FEATURES, Policy())
    return L.train_candidate(split, family, FEATURES, {f.name: f.params for f in Policy().families}[family])


def full_fit(spark, d, family):
    """The shipped policy on all features and quality labels, for timing: 200 trees or 1000 iterations."""
    return L.recall_by(_full_candidate(spark, d, family).validation)


def f11_forest_audit(spark, d):
    """The shipped 200 trees on all features and quality labels: do the node table's leaves give each held-out row its score?"""
    c = _full_candidate(spark, d, "forest")
    rows = materialize(c.validation, "validation")
    walked = L.walk_forest(materialize(L.forest_nodes(c.model), "nodes"), rows, ["doc_id"])
    return rows.join(walked.withColumnRenamed("score", "walked"), "doc_id").select(
        "doc_id", "label", F.col("n_trees").cast("int").alias("n_trees"), (F.abs(F.col("score") - F.col("walked")) < 1e-9).alias("same"))


F11 = f"""WITH l AS (SELECT doc_id, CASE WHEN quality = 0 THEN 1 ELSE 0 END AS label FROM documents JOIN labels USING (doc_id)
  WHERE {POOL_SQL} = 'train'),
{split_sql("l", ["doc_id"])}
SELECT doc_id, label, 200 AS n_trees, true AS same FROM split WHERE NOT is_train"""


def f12_full_policy(spark, d):
    """Held-out counts and recall of both shipped families on all features; the fits are Spark ML's, so SQL cannot restate them."""
    parts = [full_fit(spark, d, f.name).withColumn("name", F.lit(f.name)) for f in Policy().families]
    return parts[0].unionByName(parts[1])


# -- promotion ----------------------------------------------------------------

def _evaluated(spark, d):
    return G.evaluate_candidates(predictions(spark, d, "test"), REGISTRY)


def _rounded(df):
    return df.withColumn("recall", F.round("recall", 6))


def g1_evaluate_candidates(spark, d):
    return _rounded(_evaluated(spark, d))


_EVAL = f"""{PRED_CTE}, c AS (SELECT name, {_CELLS} FROM hard WHERE pool = 'test' GROUP BY 1),
ev AS (SELECT *, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall,
 CASE name WHEN 'logistic' THEN 1 ELSE 2 END AS ord FROM c),
best AS (SELECT name, recall, ord FROM ev ORDER BY recall DESC, ord LIMIT 1),
gate AS (SELECT *, 0.3 AS min_recall, CASE WHEN recall < 0.3 THEN 'blocked' ELSE 'promoted' END AS decision FROM best)"""
G1 = f"WITH {_EVAL} SELECT name, tp, fp, fn, tn, round(recall, 6) AS recall, CAST(ord AS INT) AS ord FROM ev"


def g2_select_champion(spark, d):
    return _rounded(G.select_champion(_evaluated(spark, d)))


G2 = f"WITH {_EVAL} SELECT name, round(recall, 6) AS recall, CAST(ord AS INT) AS ord FROM best"


def g3_promotion_gate(spark, d):
    return _rounded(G.promotion_gate(G.select_champion(_evaluated(spark, d))))


G3 = f"""WITH {_EVAL} SELECT name, round(recall, 6) AS recall, CAST(ord AS INT) AS ord,
 CAST(min_recall AS DOUBLE) AS min_recall, decision FROM gate"""


def g4_promote(spark, d):
    """Fit both families, promote the better one and score the test pool with the stored champion."""
    root = run_dir(spark, "models")
    split = L.split_once(_binary_train(spark, d), "doc_id", BINARY, SATURATED)
    for f in SATURATED.families:
        save_model(L.train_candidate(split, f.name, BINARY, f.params).model, root, f.name)
    models = G.stored_candidates(spark, root, [*G.enabled_families(SATURATED), "absent"])
    test = materialize(_binary(spark, d).filter("pool = 'test'"), "test")
    evaluated = G.evaluate_candidates(G.score_candidates(models, test), REGISTRY)
    # The two families agree and may both miss every risky row, so the gate is open here.
    gated = G.promotion_gate(G.select_champion(evaluated), Policy(min_recall=0.0))
    promoted = G.promote(models, gated, root)
    champion = L.predict(load_model(root), test)
    return champion.groupBy("label", "prediction").agg(F.count("*").alias("n")).withColumn("champion", F.lit(promoted))


G4 = f"""WITH {BINARY_CTE} SELECT label, prediction, count(*) AS n, 'logistic' AS champion FROM b JOIN fit USING (is_long)
WHERE pool = 'test' GROUP BY 1, 2"""


def g5_promote_only_if_better(spark, d):
    current = L.recall_by(predictions(spark, d, "train").filter("name = 'logistic'")).select("recall")
    out = G.promote_only_if_better(G.promotion_gate(G.select_champion(_evaluated(spark, d))), current)
    return _rounded(out).withColumn("champion_recall", F.round("champion_recall", 6))


G5 = f"""WITH {_EVAL},
cur AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) / count(*) FILTER (label = 1) AS r FROM hard
        WHERE pool = 'train' AND name = 'logistic')
SELECT name, round(recall, 6) AS recall, CAST(ord AS INT) AS ord, CAST(min_recall AS DOUBLE) AS min_recall,
 round(r, 6) AS champion_recall,
 CASE WHEN decision = 'promoted' AND recall <= r THEN 'kept' ELSE decision END AS decision FROM gate, cur"""


def g6_retrain_decision(spark, d):
    feedback = scored(documents(spark, d).filter("pool = 'unseen'")).filter("score_a >= 0.6")
    return G.retrain_decision(feedback, has_champion=True)


G6 = f"""WITH {DOC_CTE} SELECT count(*) AS n_feedback, count(*) >= 2 AS retrain,
 CASE WHEN count(*) >= 2 THEN 'feedback' ELSE 'none' END AS reason
FROM feat WHERE pool = 'unseen' AND {SCORE_A_SQL} >= 0.6"""


def g7_enabled_families(spark, d):
    """Evaluation restricted to the families the policy switches on."""
    policy = Policy(families=(Family("logistic", False), Family("forest", True)))
    return _rounded(_evaluated(spark, d).filter(F.col("name").isin(G.enabled_families(policy)))).select("name", "recall")


G7 = f"WITH {_EVAL} SELECT name, round(recall, 6) AS recall FROM ev WHERE name = 'forest'"


def g8_event_log(spark, d):
    """Activity traces per case, over the user events."""
    log = read(spark, d, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), "event_id", F.col("user_id").cast("string").alias("case_id"),
        F.col("event_type").alias("activity"), F.concat(F.lit("event "), "event_id").alias("artifact"),
        F.when(F.col("event_type") == "error", "failed").otherwise("done").alias("outcome"))
    return G.traces(log, ["ts", "event_id"])


G8 = """SELECT CAST(user_id AS VARCHAR) AS case_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step,
 event_type AS activity, concat('event ', event_id) AS artifact,
 CASE WHEN event_type = 'error' THEN 'failed' ELSE 'done' END AS outcome FROM events"""


# -- the loop -----------------------------------------------------------------

# Files of parts: a tenth train, a tenth test, and the rest arrive unseen. A function is risky by a contract on its
# comments; in files that arrive later most others are risky as well, so a second turn finds what the first could not.
LOOP_FEATURES = ["ensures_has_arith"]
LOOP_POOL_SQL = "CASE CAST(path AS BIGINT) % 10 WHEN 0 THEN 'train' WHEN 1 THEN 'test' ELSE 'unseen' END"
COMMENTED = Contract("commented", "ensures_has_arith", ensures=[
    "result = 0 OR CAST(path AS BIGINT) % 9 = 0", "result = 1 OR CAST(path AS BIGINT) % 10 = 0 OR CAST(path AS BIGINT) % 7 = 0"])


def _loop(spark, d):
    """The folder of the registry and the log, and the turns, of the loop over the derived sources."""
    units = materialize(contract_features(drop_special_units(describe_units(code_corpus(spark, d)))), "units")
    verdicts = violating_rows(units, [COMMENTED], ["path", "line"]).select("path", "line", F.lit(1).alias("label"))
    pools = units.join(verdicts, ["path", "line"], "left").fillna(0, ["label"]).withColumn("pool", F.expr(LOOP_POOL_SQL))
    pools = materialize(pools.select("path", "line", *LOOP_FEATURES, "label", "pool"), "pools")
    pool = {name: pools.filter(F.col("pool") == name).drop("pool") for name in ("train", "test", "unseen")}
    root = run_dir(spark, "loop")
    return root, run_loop(pool["train"], pool["train"].limit(0), pool["test"], pool["unseen"], LOOP_FEATURES, root, ["path", "line"], "path", SATURATED)


LOOP_TURNS = 4  # of the SQL twin; its last turn must be empty, or the twin would lack one


def _turn_sql(k: int) -> str:
    before = "(SELECT path FROM new0)" if k == 1 else "(" + " UNION ALL ".join(f"SELECT path FROM new{j}" for j in range(1, k)) + ")"
    return f"""pool{k} AS (SELECT path, line, x, label FROM u WHERE pool = 'train' OR path IN {before}),
{split_sql(f"pool{k}", ["path", "line"], str(k), ["x"])},
fit{k} AS (SELECT x, avg(label) AS score, CAST(avg(label) > 0.5 AS INT) AS prediction FROM split{k} WHERE is_train GROUP BY 1),
test{k} AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) / count(*) FILTER (label = 1) AS recall FROM u JOIN fit{k} USING (x) WHERE pool = 'test'),
scores{k} AS (SELECT path, score >= 0.6 AS high FROM u JOIN fit{k} USING (x) WHERE pool = 'unseen'),
new{k} AS (SELECT DISTINCT path FROM scores{k} WHERE high AND path NOT IN {before}),
turn{k} AS (SELECT {k} AS turn, (SELECT count(*) FROM split{k}) AS n_pool, recall, CASE WHEN recall < 0.3 THEN 'blocked' ELSE 'promoted' END AS decision,
 (SELECT count(*) FROM scores{k}) AS n_scored, (SELECT count(*) FROM scores{k} WHERE high) AS n_high, (SELECT count(*) FROM new{k}) AS n_added
 FROM test{k} {f"WHERE EXISTS (SELECT 1 FROM new{k - 1})" if k > 1 else ""})"""


LOOP_CTE = f"""{CODE_CTE}, f AS (SELECT path, line, CAST(regexp_matches(ensures, '[-+*/]') AS INT) AS x, CAST(path AS BIGINT) AS p,
  {LOOP_POOL_SQL} AS pool FROM described WHERE NOT (starts_with(name, '__') AND ends_with(name, '__'))),
u AS MATERIALIZED (SELECT path, line, x, pool, CAST(NOT ((x = 0 OR p % 9 = 0) AND (x = 1 OR p % 10 = 0 OR p % 7 = 0)) AS INT) AS label FROM f),
new0 AS (SELECT path FROM u WHERE false), {", ".join(_turn_sql(k) for k in range(1, LOOP_TURNS + 1))},
turns AS ({" UNION ALL ".join(f"SELECT * FROM turn{k}" for k in range(1, LOOP_TURNS + 1))})"""


def g9_learning_loop(spark, d):
    """Train, evaluate, promote, score and feed back over the derived sources until a turn adds no file: one row per turn."""
    root, turns = _loop(spark, d)
    rows = []
    for k, t in enumerate(turns, 1):
        best = t.decision.first()
        told = t.scores.agg(F.count("*").alias("n"), F.count_if(F.col("level") == "HIGH").alias("high")).first()
        rows.append((k, best["name"], round(best["recall"], 6), best["decision"], told["n"], told["high"], t.feedback.count()))
    turned = spark.createDataFrame(rows, "turn int, name string, recall double, decision string, n_scored bigint, n_high bigint, n_added bigint")
    versions = G.promotions(spark, root).select(F.col("entry").substr(-4, 4).cast("int").alias("turn"), "version")
    return turned.join(versions, "turn", "left")


G9 = f"""WITH {LOOP_CTE} SELECT turn, 'logistic' AS name, round(recall, 6) AS recall, decision, n_scored, n_high, n_added, turn AS version FROM turns"""


def g10_run_log(spark, d):
    """The steps that the loop's turns logged, numbered per run."""
    root, _ = _loop(spark, d)
    return G.traces(G.run_log(spark, root), ["entry"])


G10 = f"""WITH {LOOP_CTE} SELECT concat('loop.', lpad(CAST(turn AS VARCHAR), 4, '0')) AS case_id, CAST(k AS BIGINT) AS step,
 CASE k WHEN 1 THEN 'train' WHEN 2 THEN 'evaluate' WHEN 3 THEN 'promote' WHEN 4 THEN 'score' ELSE 'feedback' END AS activity,
 CASE k WHEN 1 THEN 'logistic, forest' WHEN 4 THEN concat(n_scored, ' rows') WHEN 5 THEN 'files' ELSE 'logistic' END AS artifact,
 CASE k WHEN 1 THEN concat(n_pool, ' rows') WHEN 2 THEN decision WHEN 3 THEN concat('version ', turn)
  WHEN 4 THEN concat(n_high, ' HIGH') ELSE concat(n_added, ' added') END AS outcome
FROM turns, range(1, 6) AS s(k)"""


QUERIES = {
    "a5_save_load_model": (a5_models, A5),
    "e1_labelled_dataset": (e1_labelled_dataset, E1),
    "e2_merge_pools": (e2_merge_pools, E2),
    "e3_merge_pools_last_wins": (e3_merge_last_wins, E3),
    "e4_stratified_split": (e4_stratified_split, E4),
    "e5_pool_overlap": (e5_pool_overlap, E5),
    "e6_unseen_only": (e6_unseen_only, E6),
    "e7_pool_profile": (e7_pool_profile, E7),
    "f1_logistic": (f1_logistic, F1),
    "f2_forest": (f2_forest, F2),
    "f3_build_model": (f3_build_model, F3),
    "f4_train_candidate": (f4_train_candidate, F4),
    "f5_predict_label": (f5_predict_label, F5),
    "f6_predict_score": (f6_predict_score, F6),
    "f7_linear_score": (f7_linear_score, F7),
    "f8_confusion_counts": (f8_confusion_counts, F8),
    "f9_recall_risky": (f9_recall_risky, F9),
    "f10_classification_report": (f10_classification_report, F10),
    "f11_forest_audit": (f11_forest_audit, F11),
    "f12_full_policy": (f12_full_policy, None),
    "g1_evaluate_candidates": (g1_evaluate_candidates, G1),
    "g2_select_champion": (g2_select_champion, G2),
    "g3_promotion_gate": (g3_promotion_gate, G3),
    "g4_promote": (g4_promote, G4),
    "g5_promote_only_if_better": (g5_promote_only_if_better, G5),
    "g6_retrain_decision": (g6_retrain_decision, G6),
    "g7_enabled_families": (g7_enabled_families, G7),
    "g8_event_log": (g8_event_log, G8),
    "g9_learning_loop": (g9_learning_loop, G9),
    "g10_run_log": (g10_run_log, G10),
}
