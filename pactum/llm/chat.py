"""Keep only maximal conversations of cumulative logs, and render them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pactum.llm.common import table
from pactum.plans.session import materialize

#: Three lanes of 40 bits: sums of up to 8 million turns stay inside a bigint.
LANES, HEX = 3, 10


def turn_line(role: Column, text: Column) -> Column:
    """One turn as it is rendered; a null role is `unknown`, a null text empty. Marks inside a text are escaped."""
    plain = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("<\\|")), F.lit("|>"), F.lit("|\\>"))
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("unknown")), F.lit("|>\n"), plain, F.lit("\n<|end|>\n"))


def prefix_hashes(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, at, role, text, h0, h1, h2): the turns numbered from 1 with the rolling hash of each prefix.

    The hash of a prefix is the sum of the hashes of its turns, each with its place, so it is carried along
    in one pass in order. Turns of equal number follow by role and text; exact repeats of a turn count once.
    """
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    rows = rows.filter("conv is not null").dropDuplicates(["conv", "turn", "role", "text"])
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    numbered = rows.withColumn("at", F.row_number().over(order))
    shown = F.concat_ws("|", F.col("at").cast("string"), *[F.coalesce(F.concat(F.lit("="), c), F.lit("-")) for c in ("role", "text")])
    digest = numbered.withColumn("digest", F.md5(shown.cast("binary")))
    upto = Window.partitionBy("conv").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lanes = [F.sum(F.conv(F.substring("digest", 1 + HEX * k, HEX), 16, 10).cast("bigint")).over(upto).alias(f"h{k}") for k in range(LANES)]
    return digest.select("conv", "at", "role", "text", *lanes)


def maximal_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per kept conversation: (conv, n_turns, n_assistant, n_same, rendered).

    A conversation goes if its turns (role and text) are the beginning of a longer one; of equal ones
    that with the least id stays, and n_same tells how many there were. Rows without a
    conversation id belong to none. Empty and null texts are turns; an empty table gives no rows; other
    columns are ignored. Turn prefixes are reduced to distinct hashes before the anti join, so a beginning
    that many share is one row, and only the kept conversations' turns are gathered, each by its own.
    """
    hashes = [f"h{k}" for k in range(LANES)]
    rolled = materialize(prefix_hashes(turns, conv_col, turn_col, role_col, text_col), "chat-prefixes")
    whole = rolled.groupBy("conv").agg(F.max(F.struct("at", *hashes)).alias("end"))
    ends = whole.select("conv", "end.*").groupBy("at", *hashes).agg(F.min("conv").alias("conv"), F.count("*").alias("n_same"))
    inner = rolled.join(whole.select("conv", F.col("end.at").alias("n")), "conv").filter("at < n").select("at", *hashes).distinct()
    kept = materialize(ends.join(inner, ["at", *hashes], "left_anti").select("conv", "n_same"), "chat-kept")
    told = rolled.join(kept, "conv").groupBy("conv", "n_same").agg(
        F.count("*").alias("n_turns"), F.count(F.when(F.col("role") == "assistant", 1)).alias("n_assistant"),
        F.array_sort(F.collect_list(F.struct("at", turn_line(F.col("role"), F.col("text")).alias("line")))).alias("lines"))
    return told.select(F.col("conv").alias(conv_col), "n_turns", "n_assistant", "n_same",
                       F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("rendered"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maximal_conversations(table(spark, sf_dir, "conversations"))


OP10_SQL = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k FROM t),
c AS (SELECT conv_id, count(*) AS n_turns, count(*) FILTER (role = 'assistant') AS n_assistant,
        list(coalesce('=' || role, '-') || coalesce('=' || text, '-') ORDER BY k) AS seq,
        string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) ||
                   replace(replace(coalesce(text, ''), '<|', '<\|'), '|>', '|\>') || chr(10) || '<|end|>' || chr(10), '' ORDER BY k) AS rendered
      FROM n GROUP BY conv_id),
prefixes AS (SELECT DISTINCT seq[1:i] AS seq FROM (SELECT seq, unnest(range(1, n_turns)) AS i FROM c)),
first AS (SELECT seq, min(conv_id) AS conv_id, count(*) AS n_same FROM c GROUP BY seq)
SELECT c.conv_id, n_turns, n_assistant, n_same, rendered
FROM c JOIN first USING (conv_id) ANTI JOIN prefixes ON c.seq = prefixes.seq
"""
