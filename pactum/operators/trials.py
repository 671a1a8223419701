"""Trial rows: argument tables for targets, and samples of real tables.

Arguments come from small domains chosen by parameter name. A trial table is made
by one explode over trial numbers, never by a cross join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactum.functions.metrics import key_hash, lcg
from pactum.plans.ranking import HASH_SPACE, flag_lowest
from pactum.policy import TRIALS

# Trial domains and the parameter names that select them.
STRING_PARAMS = ("s", "text", "name")
LIST_PARAMS = ("lst", "values", "items")
OBJECT_PARAM = "other"
STRINGS = ("a", "hello", "XYZ")
LISTS = ((1, 2, 3), (0,), (5, -1))
LOWEST_INT, HIGHEST_INT = -5, 5
OBJECT_START = 10
N_INTS = HIGHEST_INT - LOWEST_INT + 1
#: Trial numbers one row is filled with.
BLOCK = 1 << 20


def _is(param: Column, names: Sequence[str]) -> Column:
    return param.isin(*names)


def param_kind(param: Column, method: Column) -> Column:
    """string, list, object or int. `other` is an object in methods only."""
    return (F.when((param == OBJECT_PARAM) & method, "object")
            .when(_is(param, STRING_PARAMS), "string")
            .when(_is(param, LIST_PARAMS), "list").otherwise("int"))


def domain_size(kind: Column) -> Column:
    return (F.when(kind == "object", 1).when(kind == "string", len(STRINGS))
            .when(kind == "list", len(LISTS)).otherwise(N_INTS)).cast("bigint")


def _strings() -> Column:
    return F.array(*[F.lit(v) for v in STRINGS])


def _lists() -> Column:
    return F.array(*[F.array(*[F.lit(x).cast("bigint") for x in v]) for v in LISTS])


def _argument(kind: Column, pick: Column) -> Column:
    """Typed value number `pick` (from 0) of a domain; an object carries its start value."""
    at = (pick + 1).cast("int")
    return F.struct(
        F.when(kind == "int", pick + LOWEST_INT).when(kind == "object", F.lit(OBJECT_START)).cast("bigint").alias("number"),
        F.when(kind == "string", F.try_element_at(_strings(), at)).alias("string"),
        F.when(kind == "list", F.try_element_at(_lists(), at)).alias("list"))


def _call_params(units: DataFrame) -> DataFrame:
    """Add `_args`: (pos, param, kind, size) per argument; the receiver is not one."""
    method = F.col("class").isNotNull()
    named = F.when(method & (F.coalesce(F.try_element_at("params", F.lit(1)) == "self", F.lit(False))),
                   F.slice("params", F.lit(2), F.greatest(F.size("params") - 1, F.lit(0)))).otherwise(F.col("params"))
    return units.withColumn("_args", F.transform(named, lambda p, i: F.struct(
        i.alias("pos"), p.alias("param"), param_kind(p, method).alias("kind"),
        domain_size(param_kind(p, method)).alias("size"))))


def make_trials(units: DataFrame, keys: Sequence[str], seed_key: str | Sequence[str], n: int = TRIALS, seed: int = 0) -> DataFrame:
    """`n` seeded trials per unit, one row per argument.

    (keys, trial, pos, param, kind, number, string, list). Choices depend on the
    `seed_key` columns, the trial and the position only, so reruns agree.
    """
    spread = (_call_params(units)
              .select(*keys, key_hash(seed_key, seed).alias("_seed"), "_args",
                      F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("trial"))
              .select(*keys, "_seed", "trial", F.inline("_args")))
    pick = F.pmod(F.floor(lcg("_seed", "trial", "pos") / 65536), F.col("size"))
    return (spread.withColumn("_pick", pick)
            .select(*keys, "trial", "pos", "param", "kind", _argument(F.col("kind"), F.col("_pick")).alias("_v"))
            .select(*keys, "trial", "pos", "param", "kind", "_v.*"))


def exhaustive_trials(units: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every combination of every argument's domain, one row per argument.

    Trial numbers count through the combinations in mixed radix, so no domains are
    ever joined. A unit without arguments has one trial and no argument rows. Trials
    are made in blocks that are dealt out before they are filled, so no row holds more
    numbers than a block; more combinations than a BIGINT counts are an overflow error.
    """
    # Stride of each position: product of the domain sizes before it.
    staged = _call_params(units).withColumn("_total", F.aggregate(
        "_args", F.lit(1).cast("bigint"), lambda acc, a: acc * a["size"]))
    strides = F.transform("_args", lambda a: F.struct(
        a["pos"].alias("pos"), a["param"].alias("param"), a["kind"].alias("kind"), a["size"].alias("size"),
        F.aggregate(F.filter("_args", lambda b: b["pos"] < a["pos"]), F.lit(1).cast("bigint"), lambda acc, b: acc * b["size"])))
    # Arguments come apart before trials do, so a trial is a number and no list is looked into for it.
    spread = (staged
              .select(*keys, strides.alias("_args"), "_total", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_total") - 1, F.lit(BLOCK))).alias("_block"))
              .repartition(*keys, "_block")
              .select(*keys, "_block", (F.least(F.col("_block") + BLOCK, F.col("_total")) - 1).alias("_last"),
                      F.inline("_args").alias("pos", "param", "kind", "size", "stride"))
              .select(*keys, "pos", "param", "kind", "size", "stride", F.explode(F.sequence("_block", "_last")).alias("trial")))
    pick = F.pmod(F.expr("trial div stride"), F.col("size"))
    return (spread.select(*keys, "trial", "pos", "param", "kind", _argument(F.col("kind"), pick).alias("_v"))
            .select(*keys, "trial", "pos", "param", "kind", "_v.*"))


def argument_grid(df: DataFrame, params: Sequence[str], method: bool = False) -> DataFrame:
    """Cross each row of `df` with every argument combination, one typed column per parameter.

    Use it to check one signature exhaustively with the contract checker. More combinations than a block are made in
    blocks dealt out before they are filled; more than a BIGINT counts are an error.
    """
    sizes = [1 if p == OBJECT_PARAM and method else len(STRINGS) if p in STRING_PARAMS
             else len(LISTS) if p in LIST_PARAMS else N_INTS for p in params]
    total = 1
    for size in sizes:
        total *= size
    if total > 1 << 62:
        raise OverflowError(f"{total} combinations of {len(params)} arguments")
    numbers = lambda first, last, step=1: F.explode(F.sequence(first, last, F.lit(step).cast("bigint")))
    start, last = F.lit(0).cast("bigint"), F.lit(total - 1).cast("bigint")
    if total <= BLOCK:
        out = df.withColumn("trial", numbers(start, last))
    else:
        dealt = df.withColumn("trial", numbers(start, last, BLOCK)).repartition("trial")
        out = dealt.withColumn("trial", numbers(F.col("trial"), F.least(F.col("trial") + (BLOCK - 1), last)))
    stride = 1
    for p, size in zip(params, sizes, strict=True):
        pick = F.expr(f"(trial div {stride}) % {size}")
        at = (pick + 1).cast("int")
        if p == OBJECT_PARAM and method:
            value = F.struct(F.lit(OBJECT_START).cast("bigint").alias("balance"))
        elif p in STRING_PARAMS:
            value = F.element_at(_strings(), at)
        elif p in LIST_PARAMS:
            value = F.element_at(_lists(), at)
        else:
            value = (pick + LOWEST_INT).cast("bigint")
        out = out.withColumn(p, value)
        stride *= size
    return out


def sample_trials(df: DataFrame, key: str | Sequence[str], fraction: float, seed: int = 0) -> DataFrame:
    """About `fraction` of the rows by seeded hash of any key; moves nothing."""
    return df.filter(key_hash(key, seed) < int(fraction * HASH_SPACE))


def sample_n_trials(df: DataFrame, key: str | Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """Exactly `n` rows (all, if fewer) with the lowest seeded hash of a unique key."""
    keys = [key] if isinstance(key, str) else list(key)
    staged = df.withColumn("_all", F.lit(0))
    quota = df.sparkSession.range(1).select(F.lit(0).alias("_all"), F.lit(n).cast("bigint").alias("quota"))
    return flag_lowest(staged, key_hash(keys, seed), keys, quota, ["_all"]).filter("picked").drop("picked", "_all")
