"""The scoring loop on streams: score what arrives, feed HIGH files back, signal retraining."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pactum.operators.promotion import champion, champion_model, decide_retraining
from pactum.operators.risk import score_units
from pactum.policy import Policy
from pactum.streaming.sinks import each_batch


def stream_score(stream: DataFrame, score: Callable[[DataFrame], DataFrame], out: str, checkpoint: str,
                 every: str | None = None) -> StreamingQuery:
    """Score each batch with any batch scorer and append the risk records.

    The scorer sees a plain DataFrame, so it may extract units, which needs
    windows a stream does not have.
    """
    return each_batch(stream, lambda batch, _: score(batch), out, checkpoint, every=every)


def champion_scorer(root: str, policy: Policy = Policy()) -> Callable[[DataFrame], DataFrame]:
    """Scorer of arriving source files for `stream_score`: risk records by the champion of the moment, with its version.

    The champion is looked up for each batch, so one promoted while the stream runs scores from the next batch on.
    Without a champion the stream stops with an error and takes the batch again when it is restarted.
    """
    def score(batch: DataFrame) -> DataFrame:
        spark = batch.sparkSession
        current = champion(spark, root)
        if current is None:
            raise ValueError(f"no champion has been promoted in {root}")
        return score_units(batch, champion_model(spark, root, current), policy).withColumn("version", F.lit(current["version"]))

    return score


def stream_feedback(scores: DataFrame, out: str, checkpoint: str, file: str = "file",
                    every: str | None = None) -> StreamingQuery:
    """Add files with a HIGH score to the feedback pool, each once over all batches.

    Which files were taken is the engine's state, one row a file, so no batch reads what earlier ones wrote.
    """
    new = scores.filter(F.col("level") == "HIGH").select(file).filter(F.col(file).isNotNull()).dropDuplicates([file])
    return each_batch(new, lambda batch, _: batch, out, checkpoint, every=every)


def feedback_trigger(feedback: DataFrame, out: str, checkpoint: str, has_champion: bool = True,
                     policy: Policy = Policy(), every: str | None = None) -> StreamingQuery:
    """Count feedback rows over all batches and write a retraining decision per batch.

    The count is the engine's state: one number, whatever came before.
    """
    counted = feedback.agg(F.count("*").alias("n_feedback"))
    return each_batch(counted, lambda batch, _: decide_retraining(batch, has_champion, policy), out, checkpoint, mode="complete", every=every)
