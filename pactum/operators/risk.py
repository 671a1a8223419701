"""Scoring, banding and feedback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pactum.functions.metrics import risk_level
from pactum.operators.features import FEATURE_COLS, contract_features
from pactum.operators.learn import predict
from pactum.operators.units import describe_units
from pactum.policy import Policy


def band(scores: DataFrame, policy: Policy = Policy(), score: str = "score") -> DataFrame:
    return scores.withColumn("level", risk_level(F.col(score), policy))


def score_units(corpus: DataFrame, model: PipelineModel, policy: Policy = Policy(), units: DataFrame | None = None) -> DataFrame:
    """Risk record of every function of a corpus, special ones included.

    `units` is what `describe_units` told of this corpus, where it is already kept; else the corpus is read here.
    """
    said = ("path", "name", "line", "requires", "ensures", "invariant")
    table = contract_features(describe_units(corpus) if units is None else units, said)
    scored = predict(model, table).drop(*FEATURE_COLS, "prediction")
    return (band(scored, policy)
            .select(F.element_at(F.split("path", "/"), -1).alias("file"), *said,
                    F.round("score", 3).alias("score"), "level"))


def high_risk_files(scores: DataFrame, file: str = "file") -> DataFrame:
    """Files with any HIGH function; partial aggregation keeps big files cheap."""
    return scores.groupBy(file).agg(F.bool_or(F.col("level") == "HIGH").alias("_high")).filter("_high").select(file)


def collect_feedback(scores: DataFrame, feedback: DataFrame, file: str = "file") -> DataFrame:
    """Qualifying files not yet in the feedback pool. A second run yields none."""
    return high_risk_files(scores, file).join(feedback.select(file).distinct(), file, "left_anti")


def run_order(files: DataFrame, file: str = "file") -> DataFrame:
    return files.orderBy(file)


def top_risk(scores: DataFrame, k: int, order: Sequence[str], by: Sequence[str] = (), score: str = "score") -> DataFrame:
    """Highest scores, overall or per group; `order` breaks ties.

    The per-group form filters on row_number, which Spark applies before the shuffle
    too, so a group of any size sends at most k rows per task.
    """
    ranking = [F.desc(score), *order]
    if not by:
        return scores.orderBy(*ranking).limit(k)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*ranking))
    return scores.withColumn("rank", rank).filter(F.col("rank") <= k)


def level_summary(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows per level for every subset of `by`, with the share of HIGH."""
    return (scores.cube(*by)
            .agg(F.grouping_id().cast("int").alias("grp"), F.count("*").alias("n"),
                 *[F.count_if(F.col("level") == v).alias(f"n_{v.lower()}") for v in ("LOW", "MEDIUM", "HIGH")])
            .withColumn("high_share", F.round(F.col("n_high") / F.col("n"), 6)))
