"""Labelled tables on disk: Parquet by default, CSV with a header for interchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pactum.operators.features import DATASET_SCHEMA


def read_dataset(spark: SparkSession, path: str, schema: T.StructType = DATASET_SCHEMA,
                 format: str = "parquet") -> DataFrame:
    """Read with a declared schema; a missing path is an error."""
    reader = spark.read.schema(schema)
    return reader.csv(path, header=True, enforceSchema=False) if format == "csv" else reader.format(format).load(path)


def write_dataset(df: DataFrame, path: str, format: str = "parquet") -> None:
    """Write, replacing what was there. `df` must not read from `path`."""
    writer = df.write.mode("overwrite")
    if format == "csv":
        writer.csv(path, header=True)
    else:
        writer.format(format).save(path)
