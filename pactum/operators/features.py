"""Feature tables: contract features of functions, text features of documents."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Feature columns in order, and the columns that are never features.
FEATURE_COLS = (
    "n_params", "n_requires", "n_ensures", "n_invariants", "n_loc", "has_self", "has_other",
    "requires_complexity", "ensures_complexity", "ensures_has_arith", "ensures_has_cmp",
)
NOT_FEATURES = ("name", "class", "source_file", "label")

FEATURE_SCHEMA = T.StructType([T.StructField(c, T.IntegerType(), False) for c in FEATURE_COLS])
DATASET_SCHEMA = T.StructType(
    [*FEATURE_SCHEMA.fields, T.StructField("label", T.IntegerType(), False),
     T.StructField("source_file", T.StringType(), True)])

TEXT_FEATURE_COLS = (
    "n_lines", "n_chars_text", "n_tokens", "n_distinct", "longest_line", "n_digits", "n_upper",
    "has_arith", "has_cmp",
)


def drop_special_units(units: DataFrame) -> DataFrame:
    """Without functions whose name starts and ends with two underscores."""
    return units.filter(~(F.col("name").startswith("__") & F.col("name").endswith("__")))


def contract_features(units: DataFrame, keep: Sequence[str] = ("path", "name", "line")) -> DataFrame:
    """The eleven features of each function, after the `keep` columns."""
    def size(c: str) -> Column:
        return F.coalesce(F.greatest(F.size(c), F.lit(0)), F.lit(0))

    def chars(c: str) -> Column:
        return F.coalesce(F.aggregate(c, F.lit(0), lambda acc, e: acc + F.length(e)), F.lit(0))

    def any_match(c: str, pattern: str) -> Column:
        return F.coalesce(F.exists(c, lambda e: e.rlike(pattern)), F.lit(False))

    flag = {
        "has_self": F.coalesce(F.try_element_at("params", F.lit(1)) == "self", F.lit(False)),
        "has_other": F.coalesce(F.array_contains("params", "other"), F.lit(False)),
        "ensures_has_arith": any_match("ensures", r"[-+*/]"),
        "ensures_has_cmp": any_match("ensures", r"[<>]|=="),
    }
    values = {
        "n_params": size("params"), "n_requires": size("requires"), "n_ensures": size("ensures"),
        "n_invariants": size("invariant"), "n_loc": F.col("n_loc"),
        "requires_complexity": chars("requires"), "ensures_complexity": chars("ensures"),
        **{name: col.cast("int") for name, col in flag.items()},
    }
    return units.select(*keep, *[values[c].cast("int").alias(c) for c in FEATURE_COLS])


def feature_columns(df: DataFrame) -> list[str]:
    """All columns but the descriptive ones and the label, in table order."""
    return [c for c in df.columns if c not in NOT_FEATURES]


def assembler(columns: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="error")


def check_schema(df: DataFrame, expected: Sequence[str] | T.StructType) -> DataFrame:
    """`df` if its features are the expected ones in the expected order; else ValueError.

    Given a schema, types are aligned as well.
    """
    names = expected.fieldNames() if isinstance(expected, T.StructType) else list(expected)
    names = [n for n in names if n not in NOT_FEATURES]
    found = feature_columns(df)
    if found != names:
        missing = [n for n in names if n not in found]
        extra = [n for n in found if n not in names]
        raise ValueError(f"features differ: missing {missing}, extra {extra}, or in another order")
    if not isinstance(expected, T.StructType):
        return df
    types = {f.name: f.dataType for f in expected.fields}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def text_features(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Size and pattern proxies of whole documents, same kind as the contract features."""
    c = F.col(text)
    lines = F.split(c, "\n")
    tokens = F.filter(F.split(c, r"[ \t\r\n\f]+"), lambda t: t != "")
    staged = df.select(*keep, c.alias("_t"), lines.alias("_l"), tokens.alias("_k"))

    def count(kept: str) -> Column:
        return F.length(F.regexp_replace("_t", f"[^{kept}]+", ""))

    def has(*parts: str) -> Column:
        return reduce(lambda a, b: a | b, [F.contains(F.col("_t"), F.lit(p)) for p in parts]).cast("int")

    return staged.select(
        *keep,
        F.size("_l").alias("n_lines"),
        F.length("_t").alias("n_chars_text"),
        F.size("_k").alias("n_tokens"),
        F.size(F.array_distinct("_k")).alias("n_distinct"),
        F.array_max(F.transform("_l", F.length)).alias("longest_line"),
        count("0-9").alias("n_digits"),
        count("A-Z").alias("n_upper"),
        has("+", "-", "*", "/").alias("has_arith"),
        has("<", ">", "==").alias("has_cmp"),
    )
