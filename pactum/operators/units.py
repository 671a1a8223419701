"""Contract extraction: source text to one row per function with its clauses.

The whole job needs one exchange. Files are hashed by path before they are cut
into lines, which is cheaper than moving line records, and every later step is a
window or a grouping within a path. A corpus bucketed by path moves nothing.

Structure is read off masked text (string insides and comments blanked), so
docstrings, brackets in strings and headers over several lines do not confuse it;
clauses are read off the raw lines. Not handled, as they need a full grammar:
strings nested in f-string replacement fields, and several statements after
`def f(): ...` on one line. `path` must be unique in the corpus.
A file that cannot be read (see `quarantine`) is set aside and the job goes on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pactum.functions import text

_DEF = r"^\s*def\s+([^\s(\[:]+)\s*[(\[]"
_CLASS = r"^\s*class\s+([^\s(\[:]+)"


def explode_lines(corpus: DataFrame) -> DataFrame:
    """(path, line, text), lines numbered from 1."""
    return (corpus.select("path", F.posexplode(text.split_lines(F.col("content"))).alias("line", "text"))
            .withColumn("line", F.col("line") + 1))


def classify_lines(lines: DataFrame) -> DataFrame:
    """Add `stripped`, `indent` and `kind`: blank, comment or code."""
    stripped = text.strip(F.col("text"))
    return (lines.withColumn("stripped", stripped)
            .withColumn("kind", F.when(F.col("stripped") == "", "blank")
                        .when(F.col("stripped").startswith("#"), "comment").otherwise("code"))
            .withColumn("indent", text.indent_width(F.col("text"))))


def extract_clauses(lines: DataFrame) -> DataFrame:
    """(path, line, clause, expr) of every contract comment."""
    stripped = text.strip(F.col("text"))
    kind = text.clause_kind(stripped)
    return (lines.withColumn("stripped", stripped).withColumn("clause", kind)
            .filter(F.col("clause").isNotNull())
            .select("path", "line", "clause", text.clause_text(F.col("stripped"), F.col("clause")).alias("expr")))


def _in_order(*keys: str) -> Window:
    return Window.partitionBy("path", *keys).orderBy("line")


def _by_path(corpus: DataFrame) -> DataFrame:
    """Files hashed by path into the session's shuffle partitions.

    The number is explicit: left to itself, adaptive execution merges partitions by
    the size of the files, not of the much bigger line records they turn into.
    """
    n = int(corpus.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return corpus.select("path", "content").repartition(n, F.col("path"))


def structure(corpus: DataFrame) -> DataFrame:
    """Every line with the item it belongs to.

    An item is a statement at module level or directly in the body of a
    module-level class. `item` is its first line; `unit` / `holder` are the name
    and class when the item is a function; `occupied` marks lines an item's
    extent can end on. Files that `quarantine` sets aside have no lines here.
    """
    return _placed(corpus).select("path", "line", "stripped", "indent", "occupied", "masked", "item", "unit", "holder", "top", "top_class", "in_header")


def _placed(corpus: DataFrame) -> DataFrame:
    """The lines of `structure`, with the comment blocks that `gather` asks for.

    What depends on nothing else is asked of the same window: each further one copies every line again.
    """
    # The array of one binds the masked text, so it is made once for the verdict and the lines.
    sound = F.transform(F.array(text.mask_literals(F.col("content"))), lambda masked: F.when(
        text.scan_fault(masked).isNull(),
        F.arrays_zip(text.split_lines(F.col("content")).alias("raw"), text.split_lines(masked).alias("masked"))))
    both = _by_path(corpus).select("path", F.posexplode(F.element_at(sound, 1)).alias("i", "l"))
    stripped = text.strip(F.col("raw"))
    lines = both.select(
        "path", (F.col("i") + 1).alias("line"), F.col("l.raw").alias("raw"), F.col("l.masked").alias("masked")
    ).select(
        "path", "line", "masked", stripped.alias("stripped"),
        text.indent_width(F.col("masked")).alias("indent"),
        text.bracket_balance(F.col("masked")).alias("_net"),
        F.col("masked").endswith("\\").alias("_joined"),
        F.col("masked").startswith(text.MASK).alias("_in_string"),
        text.strip(F.col("masked")).alias("_m"),
    ).withColumn("occupied", (F.col("_m") != "") & ~F.col("_m").startswith("#"))

    w = _in_order()
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def latest(cond: Column, value: Column, frame) -> Column:
        return F.last(F.when(cond, value), ignorenulls=True).over(frame)

    comment = F.col("stripped").startswith("#")
    blank = F.col("stripped") == ""
    # A comment block is a run of comment lines; a header sees the block of the last
    # non-blank line above it, if that line is a comment.
    seen = F.last(F.when(~blank, F.struct(comment.alias("is_block"), F.col("_block").alias("block"))), ignorenulls=True).over(before)
    summed = lines.select("*", F.sum("_net").over(before).alias("_open"), F.lag("_joined").over(w).alias("_goes_on"),
                          F.count_if(~comment).over(upto).alias("_block"))
    begins = (F.col("occupied") & ~F.col("_in_string")
              & (F.coalesce(F.col("_open"), F.lit(0)) <= 0) & ~F.coalesce(F.col("_goes_on"), F.lit(False)))
    marked = summed.withColumn("_begins", begins).drop("_net", "_joined", "_in_string", "_open", "_goes_on", "_m")
    top = F.col("_begins") & (F.col("indent") == 0)
    deeper = F.col("_begins") & (F.col("indent") > 0)
    class_name = F.regexp_extract("masked", _CLASS, 1)
    levels = marked.select(
        "*", latest(top, F.struct(F.col("line"), F.nullif(class_name, F.lit("")).alias("name")), upto).alias("_top"),
        latest(F.col("_begins"), F.col("indent"), before).alias("_prev"),
        latest(F.col("_begins"), F.col("line"), upto).alias("_statement"), seen.alias("_seen"),
    ).withColumn("_body", latest(deeper & (F.col("_prev") == 0), F.col("indent"), upto))  # indent of a class body: that of the first statement below its header
    in_class = F.col("_top.name").isNotNull()
    starts = F.col("_begins") & ((F.col("indent") == 0) | (in_class & (F.col("indent") <= F.col("_body"))))
    name = F.nullif(F.regexp_extract("masked", _DEF, 1), F.lit(""))
    return (
        levels
        .withColumn("_starts", starts)
        .withColumn("_item", latest(F.col("_starts"), F.struct(
            F.col("line"), name.alias("unit"), (F.col("indent") > 0).alias("member")), upto))
        .select("path", "line", "stripped", "indent", "occupied", "masked",
                F.col("_item.line").alias("item"), F.col("_item.unit").alias("unit"),
                F.when(F.col("_item.member"), F.col("_top.name")).alias("holder"),
                F.col("_top.line").alias("top"), F.col("_top.name").alias("top_class"),
                (F.col("_statement") == F.col("_item.line")).alias("in_header"), "_block", "_seen")
    )


def gather(corpus: DataFrame, invariant_scope: str = "above") -> DataFrame:
    """One row per header line: functions and classes with extent and clauses.

    Each line goes to the item it lies in; a contract comment goes to the header
    below it as well, so it may be read twice. Both windows and the grouping work
    on the partitioning by path that `structure` set up.
    """
    if invariant_scope not in ("above", "body"):
        raise ValueError(f"unknown invariant scope: {invariant_scope}")
    below = Window.partitionBy("path").orderBy(F.desc("line"))
    upto, after = below.rowsBetween(Window.unboundedPreceding, Window.currentRow), below.rowsBetween(Window.unboundedPreceding, -1)
    code = ~F.col("stripped").startswith("#") & (F.col("stripped") != "")
    tagged = F.col("clause").isNotNull()
    rows = (
        _placed(corpus)
        .withColumn("clause", text.clause_kind(F.col("stripped")))
        .withColumn("expr", text.clause_text(F.col("stripped"), F.col("clause")))
        .withColumn("_code", code)
        # Blank lines and other comments say nothing to the lines above them.
        .filter(tagged | F.col("_code") | F.col("occupied"))
        # Text is carried on for headers only.
        .withColumn("masked", F.when(F.col("in_header") & F.col("unit").isNotNull(), F.col("masked"))).drop("stripped", "indent")
        .select("*", F.last(F.when(F.col("_code"), F.struct(
            F.when(F.col("line") == F.col("item"), F.col("line")).alias("line"),
            F.when(F.col("_seen.is_block"), F.col("_seen.block")).alias("block"))), ignorenulls=True).over(upto).alias("_next"),
            F.last(F.when(F.col("occupied"), F.col("item")), ignorenulls=True).over(after).alias("_below"))
    )
    # From here on only clauses, headers and last lines matter; bodies go no further.
    last = F.col("occupied") & F.coalesce(F.col("_below") != F.col("item"), F.lit(True))
    rows = rows.filter(tagged | (F.col("in_header") & F.col("occupied")) | last)
    class_line = F.when(F.col("top_class").isNotNull(), F.col("top"))
    is_head = F.col("item") == F.col("line")
    own = F.when(F.col("unit").isNotNull() | (is_head & (F.col("item") == class_line)), F.col("item"))
    owners = [
        F.struct(F.lit("inside").alias("place"), own.alias("owner")),
        F.struct(F.lit("above").alias("place"),
                 F.when(tagged & (F.col("_next.block") == F.col("_block")), F.col("_next.line")).alias("owner")),
    ]
    if invariant_scope == "body":
        owners.append(F.struct(F.lit("body").alias("place"),
                               F.when(F.col("clause") == "invariant", class_line).alias("owner")))
    inside = F.col("place") == "inside"
    spread = rows.select(
        "path", "line", "clause", "expr", "occupied", "unit", "holder", "top_class", "masked", "in_header",
        F.inline(F.filter(F.array(*owners), lambda o: o["owner"].isNotNull())))
    at_head = inside & (F.col("line") == F.col("owner"))
    grouped = spread.groupBy("path", "owner").agg(
        F.max(F.when(at_head, F.col("unit"))).alias("name"),
        F.max(F.when(at_head, F.col("holder"))).alias("class"),
        F.max(F.when(at_head & F.col("unit").isNull(), F.col("top_class"))).alias("class_header"),
        F.max(F.when(inside & F.col("occupied"), F.col("line"))).alias("end"),
        F.collect_list(F.when(inside & F.col("unit").isNotNull() & F.col("in_header") & F.col("occupied"),
                              F.struct("line", "masked"))).alias("_header"),
        F.collect_list(F.when(F.col("clause").isNotNull(), F.struct(
            inside.alias("later"), "line", "place", "clause", "expr"))).alias("_clauses"))
    kept = F.filter(F.array_sort("_clauses"), lambda c: (c["place"] != "inside") | (c["line"] <= F.col("end")))
    header = F.array_join(F.transform(
        F.array_sort("_header"), lambda h: F.regexp_replace(h["masked"], r"\\\s*$", "")), " ")
    return (grouped.filter(F.col("name").isNotNull() | F.col("class_header").isNotNull())
            .select("path", F.col("owner").alias("line"), "name", "class", "class_header", "end",
                    F.greatest(F.lit(1), F.col("end") - F.col("owner") + 1).alias("n_loc"),
                    header.alias("_header"), kept.alias("clauses")))


def _functions(gathered: DataFrame) -> DataFrame:
    return gathered.filter(F.col("name").isNotNull())


def find_units(corpus: DataFrame) -> DataFrame:
    """Module-level functions and direct methods of module-level classes."""
    return _functions(gather(corpus)).select(
        "path", "name", "class", text.parameter_names(F.col("_header")).alias("params"), "line")


def unit_spans(corpus: DataFrame) -> DataFrame:
    return _functions(gather(corpus)).select("path", "name", "line", "end", "n_loc")


def clauses_inside(corpus: DataFrame) -> DataFrame:
    """Clauses between a function's first and last line."""
    return (_functions(gather(corpus)).select("path", F.col("line").alias("unit_line"), F.inline("clauses"))
            .filter("place = 'inside'").select("path", "unit_line", "line", "clause", "expr"))


def clauses_above(corpus: DataFrame) -> DataFrame:
    """Clauses in the comment block above a function or class header."""
    return (gather(corpus).select("path", F.col("line").alias("header_line"), F.inline("clauses"))
            .filter("place = 'above'").select("path", "header_line", "line", "clause", "expr"))


def class_invariants(corpus: DataFrame, invariant_scope: str = "above") -> DataFrame:
    """(path, name, class, line, invariant): the invariants methods take from their class."""
    return (describe_units(corpus, invariant_scope).filter(F.col("class").isNotNull())
            .select("path", "name", "class", "line", "invariant"))


def describe_units(corpus: DataFrame, invariant_scope: str = "above") -> DataFrame:
    """One nested row per function: parameters, clauses in order, size.

    Clauses above come before clauses inside. Invariants come from the block above
    the class header (`invariant_scope="body"` also takes those in the class body);
    invariants among a function's own comments do not count.
    """
    def texts(tag: str, places: tuple[str, ...]) -> Column:
        return F.transform(
            F.filter("clauses", lambda c: (c["clause"] == tag) & c["place"].isin(*places)), lambda c: c["expr"])

    upto = _in_order().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = F.last(F.when(F.col("class_header").isNotNull(), texts("invariant", ("above", "body"))),
                  ignorenulls=True).over(upto)
    return _functions(gather(corpus, invariant_scope).withColumn("_held", held)).select(
        "path", "name", "class", text.parameter_names(F.col("_header")).alias("params"),
        texts("requires", ("above", "inside")).alias("requires"),
        texts("ensures", ("above", "inside")).alias("ensures"),
        F.when(F.col("class").isNotNull(), F.col("_held"))
        .otherwise(F.array().cast("array<string>")).alias("invariant"),
        "line", "n_loc")


def quarantine(corpus: DataFrame) -> DataFrame:
    """Files that cannot be read as source, with the reason in `fault`: a stray quote, or brackets that
    do not pair up in order and kind. Units, spans and clauses of functions leave these files out."""
    faults = corpus.withColumn("fault", text.scan_fault(text.mask_literals(F.col("content"))))
    return faults.filter(F.col("fault").isNotNull())
