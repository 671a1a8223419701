"""Session helpers: shared storage for intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by spark.checkpoint.dir.

    Only a local session that names none gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    own = tempfile.mkdtemp(prefix="pactum-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder; runs never overwrite one another."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Cut lineage through a written table, so a lost executor costs a re-read only."""
    path = run_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
