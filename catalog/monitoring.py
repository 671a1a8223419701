"""Risk bands, feedback and monitoring over documents and events."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from catalog.shared import (BAND_SQL, CODE_CTE, DOC_CTE, FEATURES, POOL_SQL, PRED_CTE, SCORED_CTE, code_corpus, documents,
                            predictions, read, scored)
from pactum.operators import learn as L
from pactum.operators import monitor as M
from pactum.operators import risk as H
from pactum.operators.features import assembler, contract_features
from pactum.operators.units import describe_units
from pactum.plans.session import materialize


def _scores(spark, d):
    """(doc_id, source, pool, score, level) of every document."""
    return H.band(scored(documents(spark, d)).select("doc_id", "source", "pool", F.col("score_a").alias("score")))


def h1_risk_level(spark, d):
    return _scores(spark, d).withColumn("score", F.round("score", 6))


H1 = f"WITH {SCORED_CTE} SELECT doc_id, source, pool, round(score, 6) AS score, level FROM sc"


def h2_score_units(spark, d):
    """Fit on one binary feature of the derived functions, with a label of its own for every third file, then write their risk records."""
    corpus = code_corpus(spark, d)
    units = materialize(describe_units(corpus), "units")  # told once, to fit on and to score
    table = materialize(contract_features(units).withColumn(
        "label", F.expr("CASE WHEN CAST(path AS BIGINT) % 3 = 0 THEN 1 - has_self ELSE has_self END")), "features")
    params = {"n_estimators": 5, "max_depth": 1, "bootstrap": False}
    model = Pipeline(stages=[assembler(["has_self"]), L.build_model("forest", params)]).fit(table)
    out = H.score_units(corpus, model, units=units)
    flat = {c: F.array_join(c, "|") for c in ("requires", "ensures", "invariant")}
    return out.withColumns(flat)


H2 = f"""WITH {CODE_CTE}, u AS (SELECT *, CAST(starts_with(params, 'self') AS INT) AS has_self FROM described),
m AS (SELECT has_self, avg(CASE WHEN CAST(path AS BIGINT) % 3 = 0 THEN 1 - has_self ELSE has_self END) AS score FROM u GROUP BY 1)
SELECT path AS file, path, name, CAST(line AS INT) AS line, requires, ensures, invariant, round(score, 3) AS score, {BAND_SQL} AS level
FROM u JOIN m USING (has_self)"""


def h3_high_risk_files(spark, d):
    return H.high_risk_files(_scores(spark, d).filter("pool = 'unseen'"), "source")


H3 = f"WITH {SCORED_CTE} SELECT DISTINCT source FROM sc WHERE pool = 'unseen' AND level = 'HIGH'"


def h4_collect_feedback(spark, d):
    """New feedback next to what the test pool already gave, and a second run that adds nothing."""
    scores = _scores(spark, d).withColumn("file", F.expr("concat(source, '-', doc_id % 53)"))
    have = H.high_risk_files(scores.filter("pool = 'test'"))
    new = H.collect_feedback(scores.filter("pool = 'unseen'"), have)
    again = H.collect_feedback(scores.filter("pool = 'unseen'"), have.unionByName(new))
    return new.select("file", F.lit(1).alias("run")).unionByName(again.select("file", F.lit(2).alias("run")))


H4 = f"""WITH {SCORED_CTE}, f AS (SELECT *, concat(source, '-', doc_id % 53) AS file FROM sc)
SELECT DISTINCT file, CAST(1 AS INT) AS run FROM f WHERE pool = 'unseen' AND level = 'HIGH'
 AND file NOT IN (SELECT file FROM f WHERE pool = 'test' AND level = 'HIGH')"""


def h5_run_order(spark, d):
    """Unseen files in name order: a range-partitioned sort of their distinct names."""
    return H.run_order(documents(spark, d).filter("pool = 'unseen'").select("source").distinct(), "source")


H5 = f"SELECT DISTINCT source FROM documents WHERE {POOL_SQL} = 'unseen' ORDER BY source"


def h6_top_risk(spark, d):
    scores = materialize(_scores(spark, d), "scores")  # read twice, so the texts are parsed once
    each = H.top_risk(scores, 3, ["doc_id"], ["source"]).select("source", "doc_id", "rank")
    overall = H.top_risk(scores, 10, ["doc_id"]).select(F.lit("*").alias("source"), "doc_id", F.lit(0).alias("rank"))
    return each.unionByName(overall)


H6 = f"""WITH {SCORED_CTE} SELECT source, doc_id, CAST(r AS INT) AS rank FROM
 (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS r FROM sc) WHERE r <= 3
UNION ALL SELECT '*', doc_id, 0 FROM (SELECT doc_id FROM sc ORDER BY score DESC, doc_id LIMIT 10)"""


def h7_level_summary(spark, d):
    out = H.level_summary(_scores(spark, d), ["pool", "source"])
    return out.withColumns({c: F.coalesce(c, F.lit("all")) for c in ("pool", "source")})


H7 = f"""WITH {SCORED_CTE} SELECT coalesce(pool, 'all') AS pool, coalesce(source, 'all') AS source,
 CAST(grouping(pool, source) AS INT) AS grp, count(*) AS n, count(*) FILTER (level = 'LOW') AS n_low,
 count(*) FILTER (level = 'MEDIUM') AS n_medium, count(*) FILTER (level = 'HIGH') AS n_high,
 round(count(*) FILTER (level = 'HIGH') / count(*), 6) AS high_share
FROM sc GROUP BY CUBE (pool, source)"""


def h8_high_risk_surge(spark, d):
    out = M.high_risk_surge(read(spark, d, "events"), "ts", F.col("event_type") == "error", "1 day", 0.02, ["user_id"])
    return out.select("user_id", F.date_format("start", "yyyy-MM-dd").alias("day"), "n", "n_high",
                      F.round("share", 6).alias("share"), F.round(F.coalesce("change", F.lit(0.0)), 6).alias("change"), "surge")


H8 = """WITH w AS (SELECT user_id, date_trunc('day', ts) AS s, count(*) AS n,
  count(*) FILTER (event_type = 'error') AS n_high FROM events GROUP BY ALL),
c AS (SELECT *, n_high / n AS share, n_high / n - lag(n_high / n) OVER (PARTITION BY user_id ORDER BY s) AS ch FROM w)
SELECT user_id, strftime(s, '%Y-%m-%d') AS day, n, n_high, round(share, 6) AS share,
 round(coalesce(ch, 0), 6) AS change, coalesce(ch >= 0.02, false) AS surge FROM c"""

DRIFT = FEATURES


def h9_feature_drift(spark, d):
    docs = materialize(documents(spark, d).select("pool", *DRIFT), "drift")
    out = M.feature_drift(docs.filter("pool = 'train'"), docs.filter("pool = 'unseen'"), DRIFT)
    return out.select("feature", "n_base", "n_other", F.round("mean_shift", 6).alias("mean_shift"), F.round("psi", 6).alias("psi"))


H9 = f"""WITH {DOC_CTE},
long AS (UNPIVOT (SELECT pool, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in DRIFT)} FROM feat
         WHERE pool IN ('train', 'unseen')) ON {', '.join(DRIFT)} INTO NAME feature VALUE v),
b AS (SELECT feature, min(v) AS lo, (max(v) - min(v)) / 10 AS width FROM long WHERE pool = 'train' GROUP BY 1),
x AS (SELECT feature, pool, v, CASE WHEN width > 0 THEN greatest(0, least(9, floor((v - lo) / width))) ELSE 0 END AS bin
      FROM long JOIN b USING (feature)),
n AS (SELECT feature, count(*) FILTER (pool = 'train') AS n_base, count(*) FILTER (pool = 'unseen') AS n_other,
      avg(v) FILTER (pool = 'unseen') - avg(v) FILTER (pool = 'train') AS shift FROM x GROUP BY 1),
g AS (SELECT f.feature, k.bin, count(x.v) FILTER (pool = 'train') AS nb, count(x.v) FILTER (pool = 'unseen') AS no
      FROM n f CROSS JOIN range(10) AS k(bin) LEFT JOIN x ON x.feature = f.feature AND x.bin = k.bin GROUP BY ALL),
s AS (SELECT feature, (nb + 0.5) / (n_base + 5.0) AS p, (no + 0.5) / (n_other + 5.0) AS q FROM g JOIN n USING (feature))
SELECT feature, n_base, n_other, round(shift, 6) AS mean_shift, round(psi, 6) AS psi
FROM n JOIN (SELECT feature, sum((q - p) * ln(q / p)) AS psi FROM s GROUP BY 1) USING (feature)"""


def h10_recall_drop(spark, d):
    """Recall of both scorers over runs; a run is a tenth of the documents."""
    runs = L.recall_by(predictions(spark, d).withColumn("run", (F.col("doc_id") % 10).cast("int")), ["name", "run"])
    out = M.recall_drop(runs, "run", ["name"])
    return out.select("name", "run", F.round("recall", 6).alias("recall"),
                      F.round(F.coalesce("previous", F.lit(-1.0)), 6).alias("previous"), "dropped", "action")


H10 = f"""WITH {PRED_CTE}, c AS (SELECT name, doc_id % 10 AS run, count(*) FILTER (label = 1 AND prediction = 1) AS tp,
  count(*) FILTER (label = 1) AS p FROM hard GROUP BY ALL),
r AS (SELECT name, run, CASE WHEN p = 0 THEN 0 ELSE tp / p END AS recall FROM c),
l AS (SELECT *, lag(recall) OVER (PARTITION BY name ORDER BY run) AS previous FROM r)
SELECT name, CAST(run AS INT) AS run, round(recall, 6) AS recall, round(coalesce(previous, -1), 6) AS previous,
 coalesce(recall < previous, false) AS dropped,
 CASE WHEN recall < previous THEN 'keep champion' ELSE 'none' END AS action FROM l"""


QUERIES = {
    "h1_risk_level": (h1_risk_level, H1),
    "h2_score_units": (h2_score_units, H2),
    "h3_high_risk_files": (h3_high_risk_files, H3),
    "h4_collect_feedback": (h4_collect_feedback, H4),
    "h5_run_order": (h5_run_order, H5),
    "h6_top_risk": (h6_top_risk, H6),
    "h7_level_summary": (h7_level_summary, H7),
    "h8_high_risk_surge": (h8_high_risk_surge, H8),
    "h9_feature_drift": (h9_feature_drift, H9),
    "h10_recall_drop": (h10_recall_drop, H10),
}
