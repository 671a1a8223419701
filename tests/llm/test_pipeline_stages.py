import random
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from pactum.llm.decontamination import decontaminate
from pactum.llm.mixing import mix, mixed_copies
from pactum.llm.ngram_join import distinct_documents
from pactum.llm.sharding import sharded_documents

from .conftest import SCHEMA, prose, rows_of
from .test_mixing import water_fill
from .test_ngram_join import shingles


def jaccard(a, b, size):
    x, y = shingles(a, size), shingles(b, size)
    return len(x & y) / len(x | y)


def test_near_duplicate_stage_takes_five_words_and_80_percent(spark):
    def fresh(k, n):
        rng = random.Random(k)
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    pairs = []
    for k in range(4):  # scattered words, an inserted passage, a deleted passage, and one pair too far apart
        base = fresh(k, 412)
        other = [f"new{i}" if i % 45 == 20 else w for i, w in enumerate(base)]
        if k == 1:
            other = base[:200] + fresh(50, 84) + base[200:]
        elif k == 2:
            other = base[:150] + base[218:]
        elif k == 3:
            other = [f"new{i}" if i % 30 == 20 else w for i, w in enumerate(base)]
        pairs.append((" ".join(base), " ".join(other)))
    near = [jaccard(a, b, 5) for a, b in pairs]
    assert all(0.8 <= x < 0.85 for x in near[:3]) and near[3] < 0.8
    assert all(jaccard(a, b, 4) < 0.85 for a, b in pairs)
    rows = [(10 * k + side, text) for k, pair in enumerate(pairs) for side, text in enumerate(pair)]
    docs = spark.createDataFrame(rows_of(rows), SCHEMA).repartition(3)
    kept = dict(corpus_pipeline.STAGES)["ngram_join"](spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 10, 20, 30, 31]


def test_mixing_stage_meets_the_targets(odd, nothing):
    stage = dict(corpus_pipeline.STAGES)["mixing"]
    out = stage(odd.sparkSession, odd, "")
    assert out.columns == odd.columns
    want = Counter()
    for r in mix(odd).collect():
        want[r["doc_id"], r["source"], r["size"]] += r["times"]
    words = lambda r: len((r["text"] or "").encode().split())
    rows, docs = out.collect(), odd.collect()
    assert Counter((r["doc_id"], r["source"], words(r)) for r in rows) == +want
    sizes, taken = Counter(), Counter()
    for r in docs:
        sizes[r["source"]] += words(r)
    for r in rows:
        taken[r["source"]] += words(r)
    targets = water_fill(sizes)
    assert any(targets[s] > sizes[s] for s in targets)
    for s, target in targets.items():
        assert abs(taken[s] - target) <= max(words(r) for r in docs if r["source"] == s)
    assert mixed_copies(nothing).count() == 0


def test_distinct_documents_decide_by_id_and_text(spark):
    def near(text):
        return text + " tail"

    a, b, c, d = (prose(70 + k, 120) for k in range(4))
    alone = [prose(80 + k, 60) for k in range(6)]
    rows = [(1, a), (None, near(a)), (None, alone[0]), (None, alone[1]),  # a null id is a copy, others are not
            (2, b), (3, near(b)), (3, alone[2]),  # of one id a text is a copy and one is not
            (4, c), (4, near(c)), (4, alone[3]),  # one id has both linked texts
            (None, d), (None, near(d)), (None, alone[4]),  # null ids alone
            (5, alone[5]), (5, alone[5]), (None, None), (None, None), (6, "")]
    docs = spark.createDataFrame(rows_of(rows), SCHEMA).repartition(3)
    kept = distinct_documents(docs)
    assert kept.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    one_of = [{(4, c), (4, near(c))}, {(None, d), (None, near(d))}]
    for group in one_of:
        assert sum(got.pop(x, 0) for x in group) == 1
    assert got == Counter([(1, a), (None, alone[0]), (None, alone[1]), (2, b), (3, alone[2]), (4, alone[3]), (None, alone[4]),
                           (5, alone[5]), (None, None), (None, None), (6, "")])


def test_no_document_is_taken_more_than_three_times(spark):
    rows = [(i, "word", "en", "small") for i in range(3)] + [(10 + i, ["", None][i % 2], "en", "small") for i in range(50)]
    rows += [(100 + i, prose(i, 80), "en", "large") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    small = [r for r in mix(docs).collect() if r["source"] == "small"]
    assert {r["target"] for r in small} == {9.0} and {r["times"] for r in small} == {3}
    copies = Counter(r["doc_id"] for r in mixed_copies(docs).collect() if r["source"] == "small")
    assert set(copies.values()) == {3} and len(copies) == 53


def test_columns_named_like_those_a_stage_adds(odd):
    names = ["mix_times", "mix_times_", "mix_source", "mix_whole", "mix_cut", "p_key", "P_AT", "p_id", "p_tie", "p_turn",
             "hit_id", "hit_hash", "hit_spans", "seen_id", "gone_hash", "goes"]
    clash = odd
    for n in names:
        clash = clash.withColumn(n, F.concat(F.lit(n), F.coalesce(F.col("text"), F.lit(""))))
    bench = odd.filter("doc_id in (8, 10)").select(F.col("doc_id").alias("item_id"), "text")
    stages = [lambda d: mixed_copies(d), lambda d: sharded_documents(d, 4),
              lambda d: decontaminate(d, bench, remove="spans"), lambda d: decontaminate(d, bench)]
    for k, stage in enumerate(stages):
        out, plain = stage(clash), stage(odd)
        assert out.columns == clash.columns + plain.columns[len(odd.columns):]
        rows = [r.asDict() for r in out.collect()]
        assert Counter(tuple(r[c] for c in plain.columns if c not in ("shard", "slot")) for r in rows) == Counter(
            tuple(r[c] for c in plain.columns if c not in ("shard", "slot")) for r in plain.collect())
        if k != 2:  # span removal changes the text
            assert all(r[n] == n + (r["text"] or "") for r in rows for n in names)
