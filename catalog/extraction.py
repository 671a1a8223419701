"""Sources and contract extraction over source text, documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.shared import CODE_CTE, CODE_SQL, DOC_CTE, FILES_SQL, code_corpus, documents, labelled, read, write_code_files
from pactum.operators import features as C
from pactum.operators import units as B
from pactum.plans.session import run_dir
from pactum.sources import corpus as A
from pactum.sources.datasets import read_dataset, write_dataset


def a1_read_corpus(spark, d):
    """Write the derived text to files in several folders and read them back whole, one row each."""
    root = run_dir(spark, "corpus")
    write_code_files(spark, d, root)
    back = A.read_corpus(spark, f"{root}/part=*", "train", glob="*.txt")
    return back.select("pool", F.regexp_extract("path", r"part=(\d+)", 1).cast("int").alias("part"), F.md5("content").alias("digest"),
                       F.length("content").cast("bigint").alias("n_chars"))


A1 = f"SELECT 'train' AS pool, * FROM ({FILES_SQL})"


def a2_corpus_from_table(spark, d):
    return (A.corpus_from_table(read(spark, d, "documents"), "doc_id", "text", "docs")
            .select("pool", "path", "file", F.length("content").alias("n_chars"), F.md5("content").alias("digest")))


A2 = """SELECT 'docs' AS pool, CAST(doc_id AS VARCHAR) AS path, CAST(doc_id AS VARCHAR) AS file,
 CAST(length(text) AS INT) AS n_chars, md5(text) AS digest FROM documents"""


def _dataset(spark, d):
    return labelled(spark, d).select(*C.TEXT_FEATURE_COLS, "label", F.col("source").alias("source_file"))


def a3_read_dataset(spark, d):
    path = run_dir(spark, "dataset")
    df = _dataset(spark, d)
    write_dataset(df, path, "csv")
    return read_dataset(spark, path, df.schema, "csv")


A3 = f"WITH {DOC_CTE} SELECT {', '.join(C.TEXT_FEATURE_COLS)}, label, source AS source_file FROM lab"


def a4_write_dataset(spark, d):
    path = run_dir(spark, "dataset")
    df = _dataset(spark, d)
    write_dataset(df, path)
    write_dataset(df, path)
    return read_dataset(spark, path, df.schema)


def _documents_corpus(spark, d):
    return A.corpus_from_table(read(spark, d, "documents"), "doc_id", "text")


def _pages_corpus(spark, d):
    return A.corpus_from_table(read(spark, d, "pages"), "page_id", "html")


def b1_explode_lines(spark, d):
    return B.explode_lines(_documents_corpus(spark, d)).select("path", "line", F.md5("text").alias("digest"))


B1 = """WITH p AS (SELECT doc_id, regexp_split_to_array(text, '\\r\\n|\\r|\\n') AS ls FROM documents),
x AS (SELECT doc_id, ls, unnest(ls) AS t, generate_subscripts(ls, 1) AS line FROM p)
SELECT CAST(doc_id AS VARCHAR) AS path, CAST(line AS INT) AS line, md5(t) AS digest
FROM x WHERE NOT (line = len(ls) AND t = '')"""


def b2_classify_lines(spark, d):
    return (B.classify_lines(B.explode_lines(_pages_corpus(spark, d)))
            .select("path", "line", "kind", "indent", F.length("stripped").alias("n_stripped")))


_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || " \
      "chr(133) || chr(160) || chr(5760) || " + " || ".join(f"chr({i})" for i in range(8192, 8203)) + \
      " || chr(8232) || chr(8233) || chr(8239) || chr(8287) || chr(12288)"
B2 = f"""WITH p AS (SELECT page_id, regexp_split_to_array(html, '\\r\\n|\\r|\\n') AS ls FROM pages),
x AS (SELECT page_id, ls, unnest(ls) AS t, generate_subscripts(ls, 1) AS line FROM p),
y AS (SELECT *, trim(t, {_WS}) AS st FROM x WHERE NOT (line = len(ls) AND t = ''))
SELECT CAST(page_id AS VARCHAR) AS path, CAST(line AS INT) AS line,
 CASE WHEN st = '' THEN 'blank' WHEN starts_with(st, '#') THEN 'comment' ELSE 'code' END AS kind,
 CAST(length(replace(regexp_extract(t, '^[ \\t\\f]*'), chr(9), '        ')) AS INT) AS indent,
 CAST(length(st) AS INT) AS n_stripped FROM y"""


def b3_extract_clauses(spark, d):
    return B.extract_clauses(B.explode_lines(code_corpus(spark, d)))


B3 = f"WITH {CODE_CTE} SELECT path, CAST(line AS INT) AS line, clause, expr FROM tags"


def b4_find_units(spark, d):
    return B.find_units(code_corpus(spark, d)).select(
        "path", "name", F.coalesce("class", F.lit("")).alias("class"), F.array_join("params", ",").alias("params"), "line")


B4 = f"WITH {CODE_CTE} SELECT path, name, class, params, CAST(line AS INT) AS line FROM described"


def b5_unit_spans(spark, d):
    return B.unit_spans(code_corpus(spark, d)).withColumnRenamed("end", "last_line")


B5 = f"WITH {CODE_CTE} SELECT path, name, CAST(line AS INT) AS line, last_line, n_loc FROM described"


def b6_clauses_inside(spark, d):
    return B.clauses_inside(code_corpus(spark, d))


B6 = f"""WITH {CODE_CTE} SELECT path, CAST(owner AS INT) AS unit_line, CAST(line AS INT) AS line, clause, expr
FROM inside"""


def b7_clauses_above(spark, d):
    return B.clauses_above(code_corpus(spark, d))


B7 = f"""WITH {CODE_CTE} SELECT path, CAST(owner AS INT) AS header_line, CAST(line AS INT) AS line, clause, expr
FROM above"""


def b8_class_invariants(spark, d):
    return B.class_invariants(code_corpus(spark, d)).withColumn("invariant", F.array_join("invariant", "|"))


B8 = f"""WITH {CODE_CTE} SELECT path, name, class, CAST(line AS INT) AS line, invariant
FROM described WHERE class <> ''"""


def b9_describe_units(spark, d):
    flat = {c: F.array_join(c, "|") for c in ("requires", "ensures", "invariant")}
    return (B.describe_units(code_corpus(spark, d)).withColumns(flat)
            .withColumn("params", F.array_join("params", ","))
            .withColumn("class", F.coalesce("class", F.lit(""))))


B9 = f"""WITH {CODE_CTE} SELECT path, name, class, params, requires, ensures, invariant,
 CAST(line AS INT) AS line, n_loc FROM described"""


# Every eighth source ends in one of six tails, of which the last two are sound.
_TAILS = ("x = )(", "x = (]", "y = 'open", 'z = [1, {"a": (2, 3])}', "s = ')('  # ((", "t = {'k': [(1), \"]\"]}")
_TAIL_SQL = ("CASE WHEN p_partkey % 8 = 3 THEN concat(chr(10), CASE CAST(floor(p_partkey / 8) AS BIGINT) % 6 "
             + " ".join(f"WHEN {i} THEN '{t.replace(chr(39), chr(39) * 2)}'" for i, t in enumerate(_TAILS)) + " END) ELSE '' END")
_FAULT_SQL = """CASE WHEN p_partkey % 8 = 3 AND CAST(floor(p_partkey / 8) AS BIGINT) % 6 = 2 THEN 'stray quote'
 WHEN p_partkey % 8 = 3 AND CAST(floor(p_partkey / 8) AS BIGINT) % 6 IN (0, 1, 3) THEN 'unpaired bracket' END"""


def b10_quarantine(spark, d):
    """Sources of which some have a broken tail: the broken ones with their fault, the others with the number of their functions."""
    parts = read(spark, d, "part").select("p_partkey", F.expr(f"concat({CODE_SQL}, {_TAIL_SQL})").alias("content"))
    corpus = A.corpus_from_table(parts, "p_partkey", "content", "parts")
    described = B.describe_units(corpus).groupBy("path").agg(F.count("*").alias("n_units")).withColumn("fault", F.lit("none"))
    aside = B.quarantine(corpus).select("path", F.lit(0).cast("bigint").alias("n_units"), "fault")
    return described.unionByName(aside)


B10 = f"""WITH {CODE_CTE}, f AS (SELECT CAST(p_partkey AS VARCHAR) AS path, {_FAULT_SQL} AS fault FROM part)
SELECT f.path, CASE WHEN fault IS NULL THEN (SELECT count(*) FROM described x WHERE x.path = f.path) ELSE 0 END AS n_units,
 coalesce(fault, 'none') AS fault FROM f"""


def c1_drop_special_units(spark, d):
    return C.drop_special_units(B.find_units(code_corpus(spark, d))).select("path", "name", "line")


C1 = f"""WITH {CODE_CTE} SELECT path, name, CAST(line AS INT) AS line FROM described
WHERE NOT (name LIKE '\\_\\_%' ESCAPE '\\' AND name LIKE '%\\_\\_' ESCAPE '\\')"""


def c2_contract_features(spark, d):
    return C.contract_features(B.describe_units(code_corpus(spark, d)))


_N = "CASE WHEN {0} = '' THEN 0 ELSE len(string_split({0}, '|')) END"
_CH = "length(replace({0}, '|', ''))"
_FEATURES = f"""SELECT path, name, CAST(line AS INT) AS line,
 CAST(len(string_split(params, ',')) AS INT) AS n_params,
 CAST({_N.format('requires')} AS INT) AS n_requires, CAST({_N.format('ensures')} AS INT) AS n_ensures,
 CAST({_N.format('invariant')} AS INT) AS n_invariants, n_loc,
 CAST(starts_with(params, 'self') AS INT) AS has_self,
 CAST(list_contains(string_split(params, ','), 'other') AS INT) AS has_other,
 CAST({_CH.format('requires')} AS INT) AS requires_complexity,
 CAST({_CH.format('ensures')} AS INT) AS ensures_complexity,
 CAST(regexp_matches(ensures, '[-+*/]') AS INT) AS ensures_has_arith,
 CAST(regexp_matches(ensures, '[<>]|==') AS INT) AS ensures_has_cmp FROM described"""
C2 = f"WITH {CODE_CTE} {_FEATURES}"


def c3_feature_columns(spark, d):
    """Assemble the feature vector by column list and read it back, so order is checked."""
    from pyspark.ml.functions import vector_to_array

    table = C.contract_features(B.describe_units(code_corpus(spark, d)), keep=("name", "path"))
    columns = [c for c in C.feature_columns(table) if c != "path"]
    vec = C.assembler(columns).transform(table).select("path", "name", vector_to_array("features").alias("v"))
    return vec.select("path", "name", *[F.col("v")[i].cast("bigint").alias(f"x{i}") for i in range(len(columns))])


_ORDER = ["n_params", "n_requires", "n_ensures", "n_invariants", "n_loc", "has_self", "has_other",
          "requires_complexity", "ensures_complexity", "ensures_has_arith", "ensures_has_cmp"]
C3 = f"""WITH {CODE_CTE}, feats AS ({_FEATURES})
SELECT path, name, {', '.join(f'CAST({c} AS BIGINT) AS x{i}' for i, c in enumerate(_ORDER))} FROM feats"""


def c4_check_schema(spark, d):
    df = documents(spark, d).select(*C.TEXT_FEATURE_COLS, F.col("source").alias("source_file"))
    return C.check_schema(df, C.TEXT_FEATURE_COLS)


C4 = f"WITH {DOC_CTE} SELECT {', '.join(C.TEXT_FEATURE_COLS)}, source AS source_file FROM feat"


def c5_text_features(spark, d):
    return documents(spark, d)


C5 = f"WITH {DOC_CTE} SELECT * FROM feat"


QUERIES = {
    "a1_read_corpus": (a1_read_corpus, A1),
    "a2_corpus_from_table": (a2_corpus_from_table, A2),
    "a3_read_dataset": (a3_read_dataset, A3),
    "a4_write_dataset": (a4_write_dataset, A3),
    "b1_explode_lines": (b1_explode_lines, B1),
    "b2_classify_lines": (b2_classify_lines, B2),
    "b3_extract_clauses": (b3_extract_clauses, B3),
    "b4_find_units": (b4_find_units, B4),
    "b5_unit_spans": (b5_unit_spans, B5),
    "b6_clauses_inside": (b6_clauses_inside, B6),
    "b7_clauses_above": (b7_clauses_above, B7),
    "b8_class_invariants": (b8_class_invariants, B8),
    "b9_describe_units": (b9_describe_units, B9),
    "b10_quarantine": (b10_quarantine, B10),
    "c1_drop_special_units": (c1_drop_special_units, C1),
    "c2_contract_features": (c2_contract_features, C2),
    "c3_feature_columns": (c3_feature_columns, C3),
    "c4_check_schema": (c4_check_schema, C4),
    "c5_text_features": (c5_text_features, C5),
}
