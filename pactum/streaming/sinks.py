"""Running queries to the end of their input, and sinks that survive a retry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from pactum.plans.session import run_dir

BATCH = "batch_id"


def run(writer: DataStreamWriter, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start a query. With `every` ('30 seconds') it keeps running and is returned as it is;
    without, it processes everything available now and is returned once it has ended."""
    writer = writer.option("checkpointLocation", checkpoint)
    if every is not None:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_to(stream: DataFrame, out: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append a stream's final rows to Parquet; the file sink commits each batch once."""
    return run(stream.writeStream.format("parquet").option("path", out).outputMode("append"), checkpoint, every)


def each_batch(stream: DataFrame, make: Callable[[DataFrame, int], DataFrame], out: str, checkpoint: str,
               mode: str = "append", every: str | None = None) -> StreamingQuery:
    """Write `make(batch, id)` to the batch's own folder.

    A batch that runs again after a failure replaces its folder, so nothing is
    doubled.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        make(batch, batch_id).write.mode("overwrite").parquet(f"{out}/{BATCH}={batch_id}")

    return run(stream.writeStream.foreachBatch(write).outputMode(mode), checkpoint, every)


def read_batches(spark: SparkSession, out: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """All batches written so far (those before a batch, if given); empty if none."""
    wide = T.StructType([*[f for f in schema.fields if f.name != BATCH], T.StructField(BATCH, T.LongType())])
    try:
        df = spark.read.schema(wide).parquet(out)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], wide)
    return df if before is None else df.filter(F.col(BATCH) < before)


def last_batch(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The newest batch alone: the state of the result in complete mode."""
    df = read_batches(spark, out, schema)
    newest = df.agg(F.max(BATCH)).first()[0]
    return df.filter(F.col(BATCH) == F.lit(newest)).drop(BATCH)


def fresh(spark: SparkSession, purpose: str) -> tuple[str, str]:
    """(output, checkpoint) paths of a new run in the shared folder."""
    root = run_dir(spark, purpose)
    return f"{root}/out", f"{root}/checkpoint"
