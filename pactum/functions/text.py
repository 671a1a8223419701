"""String columns for scanning contract comments in source text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a plain strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
TAGS = ("requires", "ensures", "invariant")

NEWLINE = r"\r\n|\r|\n"

# Stands in for the inside of a string literal in masked text.
MASK = "\u0001"

# One lexical piece: a triple-quoted string, a plain string, a comment, or a run
# of anything else. Possessive loops: linear time and no regex-engine recursion.
_TRIPLE_D = r'"""[^"\\]*+(?:(?:\\[\s\S]|"(?!""))[^"\\]*+)*+"""'
_TRIPLE_S = r"'''[^'\\]*+(?:(?:\\[\s\S]|'(?!''))[^'\\]*+)*+'''"
_PLAIN_D = r'"[^"\\\r\n]*+(?:\\[\s\S][^"\\\r\n]*+)*+"'
_PLAIN_S = r"'[^'\\\r\n]*+(?:\\[\s\S][^'\\\r\n]*+)*+'"
_PIECE = "|".join([_TRIPLE_D, _TRIPLE_S, _PLAIN_D, _PLAIN_S,
                   r"#[^\r\n]*+", r"""[^"'#]++""", r"""["']"""])

# Left behind by a quote that opens no complete string.
STRAY_QUOTE = "\u0002"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def split_lines(content: Column) -> Column:
    """Lines of a text; a trailing newline opens no further line."""
    body = F.regexp_replace(content, rf"(?:{NEWLINE})\z", "")
    return F.when(content == "", F.array().cast("array<string>")).otherwise(F.split(body, NEWLINE))


def mask_literals(content: Column) -> Column:
    """Text with string insides and comments blanked and every newline kept.

    Brackets, `def` or `#` inside strings disappear, so line structure can be
    read off the result. A line that starts inside a string starts with MASK.
    """
    def blank(piece: Column) -> Column:
        quoted = piece.startswith('"') | piece.startswith("'")
        return (
            F.when(piece.startswith("#"), F.lit("#"))
            .when(quoted & (F.length(piece) > 1),
                  F.concat(F.substring(piece, 1, 1),
                           F.regexp_replace(F.substring(piece, 2, 2147483647), r"[^\r\n]+", MASK)))
            .when(quoted, F.lit(STRAY_QUOTE))
            .otherwise(piece)
        )

    return F.array_join(F.transform(F.regexp_extract_all(content, F.lit(_PIECE), F.lit(0)), blank), "")


def bracket_balance(masked: Column) -> Column:
    """Opening minus closing brackets on a masked line."""
    size = F.length(masked)
    opened = size - F.length(F.translate(masked, "([{", ""))
    closed = size - F.length(F.translate(masked, ")]}", ""))
    return opened - closed


def scan_fault(masked: Column) -> Column:
    """Why masked text cannot be read as source: 'stray quote', 'unpaired bracket' or NULL.

    Brackets must close in the order and kind they open in. Pairs with nothing between them are taken
    out first, so the fold over what is left, with the closers still awaited as its state, is short.
    """
    left = F.regexp_replace(masked, r"[^()\[\]{}]+", "")
    for _ in range(4):
        left = F.regexp_replace(left, r"\(\)|\[\]|\{\}", "")

    def step(awaited: Column, bracket: Column) -> Column:
        return (F.when(awaited == "!", awaited)
                .when(bracket.isin("(", "[", "{"), F.concat(F.translate(bracket, "([{", ")]}"), awaited))
                .when(awaited.startswith(bracket), F.substring(awaited, 2, 2147483647))
                .otherwise("!"))

    awaited = F.aggregate(F.regexp_extract_all(left, F.lit(r"[\s\S]"), F.lit(0)), F.lit(""), step)
    return F.when(masked.contains(STRAY_QUOTE), "stray quote").when(awaited != "", "unpaired bracket")


def indent_width(masked: Column) -> Column:
    lead = F.regexp_extract(masked, r"^[ \t\f]*", 0)
    return F.length(F.replace(lead, F.lit("\t"), F.lit(" " * 8)))


def clause_kind(stripped: Column) -> Column:
    """Tag of a stripped comment line, or NULL. Prefix match: `@requiresX` counts."""
    body = strip(F.substring(stripped, 2, 2147483647))
    kind = F.when(body.startswith("@" + TAGS[0]), F.lit(TAGS[0]))
    for tag in TAGS[1:]:
        kind = kind.when(body.startswith("@" + tag), F.lit(tag))
    return F.when(stripped.startswith("#"), kind)


def clause_text(stripped: Column, kind: Column) -> Column:
    body = strip(F.substring(stripped, 2, 2147483647))
    return strip(body.substr(F.length(kind) + 2, F.lit(2147483647)))


def parameter_names(header: Column) -> Column:
    """Positional parameter names of a masked `def` header.

    Positional-only, keyword-only and starred parameters are left out.
    """
    inner = F.regexp_extract(header, r"(?s)^\s*def\s+[^\s(\[:]+\s*(?:\[[^\]]*\])?\s*\((.*)$", 1)
    # Brackets now only pair up in defaults and annotations: keep what stands outside
    # of them, at any depth, up to the bracket that closes the list.
    pieces = F.regexp_extract_all(inner, F.lit(r"[(\[{]|[)\]}]|[^()\[\]{}]+"), F.lit(0))
    state = F.struct(F.lit(0).alias("depth"), F.lit("").alias("kept"))

    def step(acc: Column, piece: Column) -> Column:
        depth = (F.when(piece.isin("(", "[", "{"), acc["depth"] + 1).when(piece.isin(")", "]", "}"), acc["depth"] - 1)
                 .otherwise(acc["depth"]))
        outside = (acc["depth"] == 0) & (depth == 0)
        # Once below zero the list is over and the depth stays there.
        return F.struct(F.when(acc["depth"] < 0, acc["depth"]).otherwise(depth).alias("depth"),
                        F.when(outside, F.concat(acc["kept"], piece)).otherwise(acc["kept"]).alias("kept"))

    inner = F.aggregate(pieces, state, step, lambda acc: acc["kept"])
    inner = F.regexp_replace(inner, r"\blambda\b[^:]*:", "")
    inner = F.regexp_replace(inner, r"(?s)(?:^|,)\s*\*.*$", "")
    inner = F.regexp_replace(inner, r"(?s)^.*?(?:^|,)\s*/\s*(?:,|$)", "")
    names = F.transform(F.split(inner, "[,]"), lambda p: F.regexp_extract(p, r"^\s*([^\s:=]*)", 1))
    return F.filter(names, lambda p: p != "")
