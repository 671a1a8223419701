"""The loop as Structured Streaming queries, drained to the end of their input."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from catalog.checking import LINE_CONTRACTS, _MOVE, _OUTCOMES, _START
from catalog.shared import (BAND_SQL, CODE_CTE, FILES_SQL, INTERCEPT_A, POOL_SQL, SCORED_CTE, WEIGHTS_A, code_corpus, read,
                            write_code_files)
from pactum.functions.metrics import linear_score
from pactum.operators import risk as H
from pactum.operators.contracts import check_contracts
from pactum.operators.features import assembler, contract_features, text_features
from pactum.operators.learn import build_model
from pactum.operators.promotion import promote_once
from pactum.operators.units import describe_units
from pactum.plans.session import materialize, run_dir
from pactum.sources.corpus import stream_corpus, stream_table
from pactum.streaming import checks, loop, sinks, windows


def _path(d, name):
    return f"{d.rstrip('/')}/{name}.parquet"


def a6_stream_corpus(spark, d):
    """Derived files arriving in folders, described as they come: two files a batch, one row each."""
    root = run_dir(spark, "arriving")
    write_code_files(spark, d, root)
    out, ckpt = sinks.fresh(spark, "stream-corpus")
    stream = stream_corpus(spark, f"{root}/part=*", glob="*.txt", files_per_trigger=2)
    told = stream.select("pool", F.regexp_extract("path", r"part=(\d+)", 1).cast("int").alias("part"), F.md5("content").alias("digest"),
                         F.length("content").cast("bigint").alias("n_chars"))
    sinks.append_to(told, out, ckpt)
    return spark.read.parquet(out)


A6 = f"SELECT 'unseen' AS pool, * FROM ({FILES_SQL})"


def _score(batch):
    feats = text_features(batch, keep=("doc_id", "source")).withColumn("pool", F.expr(POOL_SQL))
    return H.band(feats.select("doc_id", "source", "pool", linear_score(WEIGHTS_A, INTERCEPT_A).alias("score")))


ARRIVALS = 4


def _arriving(spark, df, slice_of, purpose, start):
    """Rows arrive in four parts; after each the query is started again from its checkpoint. Its output folder.

    So each part is a batch of its own at every size, and what is carried from one to the next is what a restart finds.
    """
    source = run_dir(spark, f"{purpose}-arriving")
    out, ckpt = sinks.fresh(spark, purpose)
    for k in range(ARRIVALS):
        df.filter(slice_of == k).write.mode("append").parquet(source)
        start(stream_table(spark, source, files_per_trigger=1_000_000), out, ckpt)
    return out


def _batches(spark, out):
    return spark.read.parquet(out).select(sinks.BATCH).distinct().count()


def _scored_stream(spark, d):
    """Run I1 and return the folder of its risk records."""
    return _arriving(spark, read(spark, d, "documents"), F.pmod("doc_id", F.lit(ARRIVALS)), "stream-score",
                     lambda stream, out, ckpt: loop.stream_score(stream, _score, out, ckpt))


def i1_stream_score(spark, d):
    out = _scored_stream(spark, d)
    return spark.read.parquet(out).select("doc_id", "source", "pool", F.round("score", 6).alias("score"), "level",
                                          F.lit(_batches(spark, out)).alias("n_batches"))


I1 = f"WITH {SCORED_CTE} SELECT doc_id, source, pool, round(score, 6) AS score, level, 4 AS n_batches FROM sc"


def _units_table(spark, d):
    return materialize(contract_features(describe_units(code_corpus(spark, d))), "units")


def i9_stream_champion(spark, d):
    """Arriving sources, extracted and scored by the stored champion; a second one is promoted after two of the four batches.

    Both are fitted on one binary feature, the first with other labels for every third file, the second for every fourth.
    """
    table, root = _units_table(spark, d), run_dir(spark, "champions")
    decision = spark.createDataFrame([("forest", 1.0, "promoted")], "name string, recall double, decision string")

    def promote(flipped, run_id):
        label = F.when(F.col("path").cast("bigint") % flipped == 0, 1 - F.col("has_self")).otherwise(F.col("has_self"))
        stump = build_model("forest", {"n_estimators": 5, "max_depth": 1, "bootstrap": False})
        promote_once({"forest": Pipeline(stages=[assembler(["has_self"]), stump]).fit(table.withColumn("label", label))}, decision, root, run_id)

    seen = []

    def start(stream, out, ckpt):
        if len(seen) in (0, 2):
            promote(*((3, "first") if not seen else (4, "second")))
        seen.append(loop.stream_score(stream, loop.champion_scorer(root), out, ckpt))

    out = _arriving(spark, code_corpus(spark, d), F.col("path").cast("bigint") % ARRIVALS, "stream-champion", start)
    flat = {c: F.array_join(c, "|") for c in ("requires", "ensures", "invariant")}
    return spark.read.parquet(out).drop(sinks.BATCH).withColumns(flat).withColumn("n_batches", F.lit(_batches(spark, out)))


I9 = f"""WITH {CODE_CTE}, u AS (SELECT *, CAST(starts_with(params, 'self') AS INT) AS has_self, CAST(path AS BIGINT) AS p FROM described),
m AS (SELECT version, has_self, avg(CASE WHEN p % (version + 2) = 0 THEN 1 - has_self ELSE has_self END) AS score
      FROM u, (VALUES (1), (2)) AS v(version) GROUP BY ALL),
a AS (SELECT *, CASE WHEN p % 4 < 2 THEN 1 ELSE 2 END AS version FROM u)
SELECT path AS file, path, name, CAST(line AS INT) AS line, requires, ensures, invariant, round(score, 3) AS score, {BAND_SQL} AS level,
 version, 4 AS n_batches FROM a JOIN m USING (version, has_self)"""


def _scores(spark, d):
    """The risk records, in the part their document arrived in."""
    return spark.read.parquet(_scored_stream(spark, d)).drop(sinks.BATCH), F.pmod("doc_id", F.lit(ARRIVALS))


def i2_stream_feedback(spark, d):
    scores, part = _scores(spark, d)
    out = _arriving(spark, scores.withColumn("file", F.expr("concat(source, '-', doc_id % 53)")), part, "stream-feedback", loop.stream_feedback)
    return spark.read.parquet(out).select("file")


I2 = f"WITH {SCORED_CTE} SELECT DISTINCT concat(source, '-', doc_id % 53) AS file FROM sc WHERE level = 'HIGH'"


def i3_stream_contract_check(spark, d):
    lines = read(spark, d, "lineitem")
    out = _arriving(spark, lines, F.pmod("l_orderkey", F.lit(ARRIVALS)), "stream-check",
                    lambda stream, out, ckpt: checks.stream_contract_check(stream, LINE_CONTRACTS, out, ckpt))
    schema = check_contracts(lines, LINE_CONTRACTS).schema
    return sinks.last_batch(spark, out, schema).withColumn("n_batches", F.lit(_batches(spark, out)))


I3 = f"""WITH {_OUTCOMES} SELECT target, count(*) AS n_rows, count(*) FILTER (pre) AS n_checked,
 count(*) FILTER (NOT pre) AS n_skipped, count(*) FILTER (pre AND bad) AS n_failed,
 count(*) FILTER (pre AND err) AS n_errors, CAST(coalesce(bool_or(pre AND bad), false) AS INT) AS label,
 count(*) FILTER (pre) = 0 AS vacuous, 4 AS n_batches FROM o GROUP BY 1"""


def i4_stream_surge(spark, d):
    """Tumbling days and sliding half days; the last windows stay open and are not emitted."""
    is_error = F.col("event_type") == "error"
    parts = []
    for kind, every, slide in (("tumbling", "1 day", None), ("sliding", "1 day", "12 hours")):
        out, ckpt = sinks.fresh(spark, f"surge-{kind}")
        stream = stream_table(spark, _path(d, "events"))
        sinks.append_to(windows.stream_surge(stream, "ts", is_error, every, "1 hour", slide), out, ckpt)
        parts.append(spark.read.parquet(out).select(
            F.lit(kind).alias("kind"), F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "n", "n_high"))
    return parts[0].unionByName(parts[1])


I4 = """WITH late AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events),
t AS (SELECT date_trunc('day', ts) AS s, event_type FROM events),
h AS (SELECT time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '2024-01-01') - INTERVAL 12 HOUR * k AS s, event_type
      FROM events, range(2) AS r(k))
SELECT 'tumbling' AS kind, strftime(s, '%Y-%m-%d %H:%M') AS "start", count(*) AS n,
 count(*) FILTER (event_type = 'error') AS n_high FROM t, late WHERE s + INTERVAL 1 DAY <= mark GROUP BY s
UNION ALL SELECT 'sliding', strftime(s, '%Y-%m-%d %H:%M'), count(*), count(*) FILTER (event_type = 'error')
FROM h, late WHERE s + INTERVAL 1 DAY <= mark GROUP BY s"""


def i5_stream_sessions(spark, d):
    out, ckpt = sinks.fresh(spark, "sessions")
    stream = stream_table(spark, _path(d, "events"))
    sinks.append_to(windows.stream_sessions(stream, "ts", F.col("event_type") == "error", "6 hours", "1 hour", "user_id"),
                    out, ckpt)
    return spark.read.parquet(out).select(
        "user_id", F.unix_micros("start").alias("first_us"), F.unix_micros("end").alias("end_us"), "n")


I5 = """WITH e AS (SELECT user_id, epoch_us(ts) AS t FROM events WHERE event_type = 'error'),
g AS (SELECT *, CASE WHEN t - lag(t) OVER w < 21600000000 THEN 0 ELSE 1 END AS opens
      FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t)),
s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(t) AS first_us, max(t) + 21600000000 AS end_us, count(*) AS n FROM s GROUP BY user_id, k
HAVING max(t) + 21600000000 <= (SELECT max(t) - 3600000000 FROM e)"""


def i6_stream_dedup(spark, d):
    out, ckpt = sinks.fresh(spark, "dedup")
    stream = stream_table(spark, _path(d, "events")).withColumn("day", F.to_date("ts"))
    twice = stream.unionByName(stream)
    sinks.append_to(windows.stream_dedup(twice, "ts", "40 days", ["event_id"]).select("event_id", "user_id", "event_type"),
                    out, ckpt)
    return spark.read.parquet(out)


I6 = "SELECT event_id, user_id, event_type FROM events"


def i7_stream_state_check(spark, d):
    """Balances carried by the engine over four batches, each a restart: the events arrive in order of time."""
    moves = read(spark, d, "events").select("user_id", "ts", "event_id", F.expr(_MOVE).alias("move"), "event_type")
    first, last = moves.agg(F.min("ts"), F.max("ts")).first()
    part = F.floor(ARRIVALS * (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lit(first).cast("timestamp")))
                   / (F.unix_micros(F.lit(last).cast("timestamp")) - F.unix_micros(F.lit(first).cast("timestamp")) + 1))
    out = _arriving(spark, moves, part, "state-check", lambda stream, out, ckpt: checks.stream_state_check(
        stream, ["user_id"], ["ts", "event_id"], "move", "balance >= 0", out, ckpt, requires="event_type <> 'view'", start=_START))
    return (spark.read.parquet(out).groupBy("user_id")
            .agg(F.sum("n_rows").alias("n_rows"), F.sum("n_checked").alias("n_checked"), F.sum("n_failed").alias("n_failed"),
                 F.sum("n_late").alias("n_late"), F.max_by("balance", sinks.BATCH).alias("balance"))
            .withColumn("n_batches", F.lit(_batches(spark, out))))


I7 = f"""WITH m AS (SELECT user_id, ts, event_id, event_type <> 'view' AS ok, {_START} +
 sum(CASE WHEN event_type <> 'view' THEN {_MOVE} ELSE 0 END)
 OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS balance FROM events)
SELECT user_id, count(*) AS n_rows, count(*) FILTER (ok) AS n_checked, count(*) FILTER (ok AND balance < 0) AS n_failed,
 CAST(0 AS BIGINT) AS n_late, CAST(arg_max(balance, (ts, event_id)) AS BIGINT) AS balance, 4 AS n_batches FROM m GROUP BY 1"""


def i8_feedback_trigger(spark, d):
    scores, part = _scores(spark, d)
    out = _arriving(spark, scores, part, "trigger", lambda stream, out, ckpt: loop.feedback_trigger(
        stream.filter("level = 'HIGH' AND pool = 'unseen'"), out, ckpt))
    last = spark.read.parquet(out).agg(F.max_by(F.struct("n_feedback", "retrain", "reason"), sinks.BATCH).alias("r"), F.count_distinct(sinks.BATCH).alias("n_batches"))
    return last.select("r.*", "n_batches")


I8 = f"""WITH {SCORED_CTE} SELECT count(*) AS n_feedback, count(*) >= 2 AS retrain,
 CASE WHEN count(*) >= 2 THEN 'feedback' ELSE 'none' END AS reason, CAST(4 AS BIGINT) AS n_batches
FROM sc WHERE level = 'HIGH' AND pool = 'unseen'"""


QUERIES = {
    "a6_stream_corpus": (a6_stream_corpus, A6),
    "i1_stream_score": (i1_stream_score, I1),
    "i2_stream_feedback": (i2_stream_feedback, I2),
    "i3_stream_contract_check": (i3_stream_contract_check, I3),
    "i4_stream_surge": (i4_stream_surge, I4),
    "i5_stream_sessions": (i5_stream_sessions, I5),
    "i6_stream_dedup": (i6_stream_dedup, I6),
    "i7_stream_state_check": (i7_stream_state_check, I7),
    "i8_feedback_trigger": (i8_feedback_trigger, I8),
    "i9_stream_champion": (i9_stream_champion, I9),
}
