"""Tables that runs add to, each run's rows once: promotions and log rows."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTRY = "entry"


def read_entries(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """All rows added so far, with the entry each came in; none if there is no table yet."""
    wide = T.StructType([*T.StructType.fromDDL(schema).fields, T.StructField(ENTRY, T.StringType())])
    try:
        return spark.read.schema(wide).parquet(table)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], wide)


def add_once(rows: DataFrame, table: str, entry: str) -> bool:
    """Add the few rows of an entry; False, and nothing changes, if it is there already.

    An entry is one file in a folder of its own, which appears whole or not at all; what a failed write left is
    replaced. Its name takes letters, digits, '.', '_' and '-'. One run at a time writes an entry; others may read.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", entry):
        raise ValueError(f"no name for an entry: {entry!r}")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    if not read_entries(rows.sparkSession, table, schema).filter(F.col(ENTRY) == entry).isEmpty():
        return False
    rows.coalesce(1).write.mode("overwrite").parquet(f"{table}/{ENTRY}={entry}")
    return True
