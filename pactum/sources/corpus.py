"""Text corpora as tables: corpus(pool, path, file, content)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CORPUS_SCHEMA = "path string, content string"


def _named(df: DataFrame, pool: str) -> DataFrame:
    return df.select(F.lit(pool).alias("pool"), "path",
                     F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def read_corpus(spark: SparkSession, paths: str | Sequence[str], pool: str, glob: str = "*.py") -> DataFrame:
    """One row per file directly inside each folder, whole UTF-8 content."""
    return _named(
        spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True, pathGlobFilter=glob)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")), pool)


def corpus_from_table(df: DataFrame, id_col: str, text_col: str, pool: str = "table") -> DataFrame:
    """A corpus from any table with a unique id and a text column."""
    return _named(df.select(F.col(id_col).cast("string").alias("path"), F.col(text_col).alias("content")), pool)


def stream_corpus(spark: SparkSession, path: str, pool: str = "unseen", glob: str = "*.py",
                  files_per_trigger: int = 1000) -> DataFrame:
    """Files arriving in a folder, one row each."""
    return _named(
        spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_trigger).load(path)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")), pool)


def stream_table(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """A Parquet table read as a stream with its own schema.

    A folder is read as it is and may be partitioned; of one file's folder only that file.
    """
    table = spark.read.parquet(path)
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files_per_trigger)
    folder, _, name = path.rstrip("/").rpartition("/")
    files = table.inputFiles()
    if len(files) == 1 and files[0].endswith(f"/{name}"):
        return stream.option("pathGlobFilter", name).parquet(folder)
    return stream.parquet(path)
