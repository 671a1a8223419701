"""Tables and SQL fragments the registered queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum.functions.metrics import linear_score
from pactum.operators.features import TEXT_FEATURE_COLS, text_features


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lcg_sql(*parts: str, seed: int = 0) -> str:
    state = str(seed)
    for p in parts:
        state = f"((({state} + ({p}) % 2147483648) * 1103515245 + 12345) % 2147483648)"
    return state


def key_hash_sql(*keys: str, seed: int = 0) -> str:
    parts = "".join(f" || '|' || coalesce('=' || CAST({k} AS VARCHAR), '-')" for k in keys)
    return f"(CAST('0x' || substr(md5('{seed}'{parts}), 1, 8) AS BIGINT) % 2147483648)"


def split_sql(table: str, keys: list[str], suffix: str = "", carried: list[str] | None = None) -> str:
    """CTEs ending in split{suffix} (keys, carried, label, is_train): the stratified split at 30 percent, seed 42."""
    own = ", ".join([*keys, *(carried or []), "label"])
    return f"""r{suffix} AS (SELECT *, count(*) OVER (PARTITION BY label) AS n, count(*) OVER () AS total,
  row_number() OVER (PARTITION BY label ORDER BY {key_hash_sql(*keys, seed=42)}, {", ".join(keys)}) AS rn FROM {table}),
q{suffix} AS (SELECT DISTINCT label, n, total - CAST(ceil(total * 3 / 10.0) AS BIGINT) AS train, total FROM r{suffix}),
s{suffix} AS (SELECT label, n * train // total AS base, n * train % total AS rest, train FROM q{suffix}),
t{suffix} AS (SELECT label, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= train - sum(base) OVER ()
  THEN 1 ELSE 0 END AS quota FROM s{suffix}),
split{suffix} AS (SELECT {own}, rn <= quota AS is_train FROM r{suffix} JOIN t{suffix} USING (label))"""


# -- documents as the labelled, pooled data set ------------------------------

# Two fixed scorers that stand in for stored logistic weights.
WEIGHTS_A = {"n_tokens": -0.002, "n_upper": 0.01, "n_digits": 0.02}
INTERCEPT_A = 0.3
WEIGHTS_B = {"n_lines": 0.03, "n_distinct": -0.004, "has_cmp": 1.5}
INTERCEPT_B = 0.4

FILE_SQL = "concat(source, '-', doc_id % 53, '.txt')"
POOL_SQL = "CASE WHEN doc_id % 10 <= 5 THEN 'train' WHEN doc_id % 10 <= 7 THEN 'test' ELSE 'unseen' END"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text features of every document with its source and pool."""
    docs = read(spark, sf_dir, "documents")
    return text_features(docs, keep=("doc_id", "source")).withColumn("pool", F.expr(POOL_SQL))


def pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its pool and a file name several documents share."""
    return (read(spark, sf_dir, "documents").withColumn("pool", F.expr(POOL_SQL))
            .withColumn("file", F.expr(FILE_SQL)))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a label: low quality is the risky class."""
    labels = read(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 0).cast("int").alias("label"))
    return documents(spark, sf_dir).join(labels, "doc_id")


def scored(df: DataFrame) -> DataFrame:
    return (df.withColumn("score_a", linear_score(WEIGHTS_A, INTERCEPT_A))
            .withColumn("score_b", linear_score(WEIGHTS_B, INTERCEPT_B)))


def predictions(spark: SparkSession, sf_dir: str, pool: str | None = None) -> DataFrame:
    """(name, label, prediction, score) of both scorers over labelled documents."""
    df = scored(labelled(spark, sf_dir))
    if pool:
        df = df.filter(F.col("pool") == pool)
    both = F.array(F.struct(F.lit("logistic").alias("name"), F.col("score_a").alias("score")),
                   F.struct(F.lit("forest").alias("name"), F.col("score_b").alias("score")))
    return (df.select("doc_id", "source", "label", F.inline(both))
            .withColumn("prediction", (F.col("score") >= 0.5).cast("int")))


POOLED_CTE = f"pooled AS (SELECT *, {POOL_SQL} AS pool, {FILE_SQL} AS file FROM documents)"

DOC_CTE = f"""
tok AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS ls,
         list_filter(regexp_split_to_array(text, '[ \\t\\r\\n\\f]+'), lambda x: x <> '') AS ks
  FROM documents),
feat AS (
  SELECT doc_id, source, {POOL_SQL} AS pool,
         CAST(len(ls) AS INT) AS n_lines, CAST(length(text) AS INT) AS n_chars_text,
         CAST(len(ks) AS INT) AS n_tokens, CAST(len(list_distinct(ks)) AS INT) AS n_distinct,
         CAST(list_max(list_transform(ls, lambda x: length(x))) AS INT) AS longest_line,
         CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS INT) AS n_digits,
         CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS INT) AS n_upper,
         CAST(regexp_matches(text, '[-+*/]') AS INT) AS has_arith,
         CAST(contains(text, '<') OR contains(text, '>') OR contains(text, '==') AS INT) AS has_cmp
  FROM tok),
lab AS (SELECT feat.*, CASE WHEN quality = 0 THEN 1 ELSE 0 END AS label
        FROM feat JOIN labels USING (doc_id))
"""


def _linear_sql(weights: dict[str, float], intercept: float) -> str:
    z = " + ".join([str(intercept)] + [f"({w}) * CAST({c} AS DOUBLE)" for c, w in weights.items()])
    return f"1.0 / (1.0 + exp(-(CAST(0 AS DOUBLE) + {z})))"


SCORE_A_SQL = _linear_sql(WEIGHTS_A, INTERCEPT_A)
SCORE_B_SQL = _linear_sql(WEIGHTS_B, INTERCEPT_B)

PRED_CTE = DOC_CTE + f""",
pred AS (
  SELECT doc_id, source, pool, label, 'logistic' AS name, {SCORE_A_SQL} AS score FROM lab
  UNION ALL
  SELECT doc_id, source, pool, label, 'forest' AS name, {SCORE_B_SQL} AS score FROM lab),
hard AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction FROM pred)
"""

BAND_SQL = "CASE WHEN score < 0.2 THEN 'LOW' WHEN score < 0.6 THEN 'MEDIUM' ELSE 'HIGH' END"
SCORED_CTE = DOC_CTE + f""",
sc AS (SELECT doc_id, source, pool, score, {BAND_SQL} AS level
       FROM (SELECT *, {SCORE_A_SQL} AS score FROM feat))
"""

# -- source text derived from `part`, one file per row ------------------------

# Plain SQL that both engines read the same way.
CODE_SQL = """concat(
 '# helpers for part ', p_partkey, chr(10), chr(10),
 '# @requires size >= 0', chr(10),
 CASE WHEN p_partkey % 3 = 0 THEN chr(10) ELSE '' END,
 'def f_', p_partkey, '(a, b):', chr(10),
 CASE WHEN p_partkey % 4 = 2 THEN concat('    "', '""adds (two numbers', chr(10),
   '    # @ensures documented', chr(10), '    "', '""', chr(10)) ELSE '' END,
 repeat(concat('    # @requires a >= 0', chr(10)), CAST(p_size % 3 AS INT)),
 repeat(concat('    #   @ensures result == a + b  ', chr(10)), CAST(p_partkey % 4 AS INT)),
 '    return a + b', chr(10),
 CASE WHEN p_partkey % 5 = 0 THEN concat('    # @ensures trailing', chr(10)) ELSE '' END,
 CASE WHEN p_partkey % 4 = 1 THEN concat('@cached', chr(10), 'def h_', p_partkey, '(values, s="x(,", *,', chr(10),
   '      scale=(1, 2)):', chr(10), '    ## @requires ignored', chr(10), '    # @requiresvalues', chr(10),
   '    return values', chr(10)) ELSE '' END,
 CASE WHEN p_partkey % 7 = 0 THEN concat('if debug:', chr(10), '    def hidden(x):', chr(10),
   '        # @requires x', chr(10), '        return x', chr(10), 'async def later(x):', chr(10),
   '    return x', chr(10)) ELSE '' END,
 chr(10), '# @invariant self.v >= 0', chr(10),
 'class C:', chr(10),
 '    # @invariant self.w', chr(10),
 '    def __init__(self, v):', chr(10),
 '        self.v = v  # @ensures not a comment line', chr(10), chr(10),
 '    # @requires n > 0', chr(10),
 '    def move(self, other, n):', chr(10),
 '        def inner(q):', chr(10),
 '            # @ensures q != 1', chr(10),
 '            return q', chr(10),
 '        return inner(n)', chr(10),
 'last = 1')"""

CODE_CTE = f"""
src AS (SELECT CAST(p_partkey AS VARCHAR) AS path, string_split({CODE_SQL}, chr(10)) AS ls FROM part),
ln AS (SELECT path, unnest(ls) AS text, generate_subscripts(ls, 1) AS line FROM src),
lines AS (
  SELECT path, line, text, trim(text) AS st, length(text) - length(ltrim(text)) AS ind,
         CASE WHEN trim(text) = '' THEN 'blank' WHEN trim(text) LIKE '#%' THEN 'comment' ELSE 'code' END AS kind
  FROM ln),
runs AS (
  SELECT *, sum(CASE WHEN kind = 'comment' THEN 0 ELSE 1 END) OVER (PARTITION BY path ORDER BY line) AS run,
         max(CASE WHEN kind <> 'blank' THEN line END) OVER (PARTITION BY path ORDER BY line
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS above_line
  FROM lines),
tops AS (SELECT path, line, st, lead(line) OVER (PARTITION BY path ORDER BY line) AS nxt
         FROM lines WHERE kind = 'code' AND ind = 0),
cls AS (SELECT path, line, regexp_extract(st, '^class ([A-Za-z]+)', 1) AS cname, coalesce(nxt, 1000000) AS nxt
        FROM tops WHERE st LIKE 'class %'),
units AS (
  SELECT r.path, r.line, r.ind, r.above_line, regexp_extract(r.st, '^def ([A-Za-z_0-9]+)', 1) AS name,
         c.cname, c.line AS cls_line
  FROM runs r LEFT JOIN cls c ON r.path = c.path AND r.line > c.line AND r.line < c.nxt
  WHERE r.st LIKE 'def %' AND (r.ind = 0 OR (r.ind = 4 AND c.cname IS NOT NULL))),
stops AS (
  SELECT u.path, u.line, coalesce(min(l.line), 1000000) AS stop
  FROM units u LEFT JOIN lines l ON l.path = u.path AND l.line > u.line AND l.kind = 'code' AND l.ind <= u.ind
  GROUP BY ALL),
spans AS (
  SELECT u.path, u.line, max(l.line) AS last_line
  FROM stops u JOIN lines l ON l.path = u.path AND l.line >= u.line AND l.line < u.stop AND l.kind = 'code'
  GROUP BY ALL),
tags AS (
  SELECT path, line, run, regexp_extract(st, '^#\\s*@(requires|ensures|invariant)', 1) AS clause,
         trim(regexp_extract(st, '^#\\s*@(requires|ensures|invariant)(.*)$', 2)) AS expr
  FROM runs WHERE regexp_matches(st, '^#\\s*@(requires|ensures|invariant)')),
inside AS (
  SELECT s.path, s.line AS owner, t.line, t.clause, t.expr
  FROM spans s JOIN tags t ON t.path = s.path AND t.line BETWEEN s.line AND s.last_line),
heads AS (SELECT path, line, above_line FROM units
          UNION ALL SELECT r.path, r.line, r.above_line FROM runs r JOIN cls USING (path, line)),
above AS (
  SELECT h.path, h.line AS owner, t.line, t.clause, t.expr
  FROM heads h JOIN runs b ON b.path = h.path AND b.line = h.above_line AND b.kind = 'comment'
  JOIN tags t ON t.path = h.path AND t.run = b.run AND t.line <= h.above_line),
own AS (SELECT *, 0 AS later FROM above UNION ALL SELECT *, 1 AS later FROM inside),
params AS (
  SELECT path, line, CASE WHEN name LIKE 'f\\_%' ESCAPE '\\' THEN 'a,b' WHEN name LIKE 'h\\_%' ESCAPE '\\' THEN 'values,s'
                          WHEN name = 'move' THEN 'self,other,n' ELSE 'self,v' END AS params
  FROM units),
described AS (
  SELECT u.path, u.name, coalesce(u.cname, '') AS class, u.line, p.params,
         CAST(s.last_line - u.line + 1 AS INT) AS n_loc, CAST(s.last_line AS INT) AS last_line,
         coalesce((SELECT string_agg(expr, '|' ORDER BY later, line) FROM own o
                   WHERE o.path = u.path AND o.owner = u.line AND clause = 'requires'), '') AS requires,
         coalesce((SELECT string_agg(expr, '|' ORDER BY later, line) FROM own o
                   WHERE o.path = u.path AND o.owner = u.line AND clause = 'ensures'), '') AS ensures,
         coalesce((SELECT string_agg(expr, '|' ORDER BY line) FROM above o
                   WHERE o.path = u.path AND o.owner = u.cls_line AND clause = 'invariant'), '') AS invariant
  FROM units u JOIN spans s USING (path, line) JOIN params p USING (path, line))
"""


def code_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pactum.sources.corpus import corpus_from_table

    part = read(spark, sf_dir, "part")
    return corpus_from_table(part.select("p_partkey", F.expr(CODE_SQL).alias("content")), "p_partkey", "content", "parts")


FILES = 8


def write_code_files(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The derived sources as FILES files, part=0 to part=7, each with its sources in order of their keys."""
    part = read(spark, sf_dir, "part").select("p_partkey", F.expr(CODE_SQL).alias("value"), (F.col("p_partkey") % FILES).alias("part"))
    (part.repartition(FILES, "part").sortWithinPartitions("part", "p_partkey").select("value", "part")
     .write.partitionBy("part").text(root))


FILES_SQL = f"""SELECT CAST(p_partkey % {FILES} AS INT) AS part, md5(string_agg({CODE_SQL} || chr(10), '' ORDER BY p_partkey)) AS digest,
 CAST(sum(length({CODE_SQL}) + 1) AS BIGINT) AS n_chars FROM part GROUP BY 1"""

FEATURES = list(TEXT_FEATURE_COLS)
