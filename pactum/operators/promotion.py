"""Champion / challenger decisions as small tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from pactum.operators.learn import predict, recall_by
from pactum.plans.scan import running_sum
from pactum.policy import Policy
from pactum.sources.models import CHAMPION, has_model, load_model, save_model
from pactum.sources.registry import ENTRY, add_once, read_entries


def enabled_families(policy: Policy) -> list[str]:
    return [f.name for f in policy.families if f.enabled]


def evaluate_candidates(predictions: DataFrame, registry: Sequence[str]) -> DataFrame:
    """(name, ord, tp, fp, fn, tn, recall) from predictions tagged with `name`.

    `registry` gives the order; names it does not hold are ignored, and absent
    candidates simply have no row.
    """
    position = F.array_position(F.array(*[F.lit(n) for n in registry]), F.col("name"))
    return recall_by(predictions, ["name"]).withColumn("ord", position.cast("int")).filter("ord > 0")


def score_candidates(models: Mapping[str, PipelineModel], test: DataFrame) -> DataFrame:
    """Predictions of every candidate on the same rows, tagged with its name.

    One narrow scan of `test` per candidate, so `test` should be a written table.
    """
    parts = [predict(m, test).select(F.lit(n).alias("name"), "label", "prediction", "score")
             for n, m in models.items()]
    return reduce(DataFrame.unionByName, parts)


def select_champion(evaluated: DataFrame) -> DataFrame:
    """One row: the highest recall, the earlier in the registry on a tie. Empty if no candidate."""
    best = evaluated.agg(F.max_by(F.struct("name", "recall", "ord"), F.struct("recall", -F.col("ord"))).alias("b"))
    return best.filter("b IS NOT NULL").select("b.name", "b.recall", "b.ord")


def promotion_gate(champion: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Add `decision`: promoted, or blocked below the minimum recall. Equal passes."""
    return (champion.withColumn("min_recall", F.lit(policy.min_recall))
            .withColumn("decision", F.when(F.col("recall") < policy.min_recall, "blocked").otherwise("promoted")))


def promote_only_if_better(gated: DataFrame, current: DataFrame) -> DataFrame:
    """Also block a winner that does not beat the current champion's recall.

    `current` holds at most one row (recall); none means there is no champion.
    """
    reigning = current.agg(F.max("recall").alias("champion_recall"), F.lit(1).alias("_one"))
    beaten = F.col("champion_recall").isNull() | (F.col("recall") > F.col("champion_recall"))
    return (gated.withColumn("_one", F.lit(1)).join(reigning, "_one", "left").drop("_one")
            .withColumn("decision", F.when((F.col("decision") == "promoted") & ~beaten, "kept")
                        .otherwise(F.col("decision"))))


def promote(models: Mapping[str, PipelineModel], decision: DataFrame, root: str) -> str | None:
    """Save the promoted candidate as champion; returns its name, or None."""
    row = decision.filter("decision = 'promoted'").select("name").first()
    if row is None:
        return None
    save_model(models[row["name"]], root, CHAMPION)
    return row["name"]


PROMOTION_SCHEMA = "version int, name string, recall double"


def promotions(spark: SparkSession, root: str) -> DataFrame:
    """(version, name, recall, entry): every promotion, `entry` being the run that made it."""
    return read_entries(spark, f"{root}/promotions", PROMOTION_SCHEMA)


def champion(spark: SparkSession, root: str) -> Row | None:
    """The latest promotion: what `promote_once` returned last is what is read next."""
    return promotions(spark, root).orderBy(F.desc("version"), F.desc(ENTRY)).first()


def champion_model(spark: SparkSession, root: str, promotion: Row) -> PipelineModel:
    return load_model(f"{root}/champions", promotion[ENTRY])


def promoted_by(spark: SparkSession, root: str, run_id: str) -> Row | None:
    return promotions(spark, root).filter(F.col(ENTRY) == run_id).first()


def promote_once(models: Mapping[str, PipelineModel], decision: DataFrame, root: str, run_id: str) -> Row | None:
    """The run's promotion, or None if the decision is another. A run that is repeated adds nothing.

    The model is stored in a folder of its own before its row is added, so no reader finds a champion without a
    whole model, and earlier champions stay. One promotion is made at a time.
    """
    spark = decision.sparkSession
    told = promoted_by(spark, root, run_id)
    row = None if told else decision.filter("decision = 'promoted'").select("name", "recall").first()
    if row is None:
        return told
    last = promotions(spark, root).agg(F.max("version")).first()[0] or 0
    save_model(models[row["name"]], f"{root}/champions", run_id)
    add_once(spark.createDataFrame([(last + 1, row["name"], row["recall"])], PROMOTION_SCHEMA), f"{root}/promotions", run_id)
    return promoted_by(spark, root, run_id)


def stored_candidates(spark: SparkSession, root: str, registry: Sequence[str]) -> dict[str, PipelineModel]:
    """Saved candidates in registry order; absent ones are skipped."""
    return {name: load_model(root, name) for name in registry if has_model(spark, root, name)}


def retrain_decision(feedback: DataFrame, has_champion: bool, policy: Policy = Policy()) -> DataFrame:
    """One row (n_feedback, retrain, reason)."""
    return decide_retraining(feedback.agg(F.count("*").alias("n_feedback")), has_champion, policy)


def decide_retraining(counted: DataFrame, has_champion: bool, policy: Policy = Policy()) -> DataFrame:
    """The decision from a row that already holds `n_feedback`."""
    enough = F.col("n_feedback") >= policy.feedback_trigger
    fresh = F.lit(policy.retrain_if_no_champion and not has_champion)
    return (counted.withColumn("retrain", enough | fresh)
            .withColumn("reason", F.when(fresh, "no champion").when(enough, "feedback").otherwise("none")))


EVENT_SCHEMA = "ts timestamp, case_id string, activity string, artifact string, outcome string"


def log_events(spark: SparkSession, path: str, rows: Sequence[tuple]) -> None:
    """Append events to the log. Files are only ever added."""
    spark.createDataFrame(list(rows), EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def log_step(spark: SparkSession, root: str, run_id: str, step: int, activity: str, artifact: str, outcome: str) -> None:
    """Log one step of a run, once: a step that is repeated leaves the row of its first time."""
    row = (datetime.now(timezone.utc), run_id, activity, artifact, outcome)
    add_once(spark.createDataFrame([row], EVENT_SCHEMA), f"{root}/log", f"{run_id}.{step:04d}")


def run_log(spark: SparkSession, root: str) -> DataFrame:
    """What `log_step` wrote; `traces(run_log(...), ["entry"])` numbers each run's steps."""
    return read_entries(spark, f"{root}/log", EVENT_SCHEMA)


def traces(log: DataFrame, order: Sequence[str] = ("ts", "activity")) -> DataFrame:
    """(case_id, step, activity, artifact, outcome): each case's activities numbered in order.

    A case of any length stays whole: steps are a running count, never one collected value.
    """
    counted = running_sum(log.withColumn("_one", F.lit(1).cast("bigint")), ["case_id"], list(order), "_one", 0)
    return counted.select("case_id", F.col("total").alias("step"), "activity", "artifact", "outcome")
