import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pactum.llm import collocations as c
from pactum.llm.collocations import collocations, frequent_phrases

from .conftest import SCHEMA, odd_texts, prose, rows_of


def brute(rows, size=4, least=30, percent=80, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", (text or "").encode().lower()):
            w = re.findall(rb"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, size + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    candidates = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    gone = set()
    for (lang, w), longer in candidates.items():
        for k in range(2, len(w)):
            gone |= {p for i in range(len(w) - k + 1) if 100 * longer >= percent * f[p := (lang, w[i:i + k])]}
    found = {}
    for (lang, w), a in candidates.items():
        if (lang, w) not in gone:
            score, k = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
            found.setdefault(lang, []).append((-score, -a, b" ".join(w), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, rank, p.decode(), -a, l, r, n[lang], -s) for lang, x in found.items() for rank, (s, a, p, l, r) in enumerate(sorted(x)[:top], 1))


def got(df, group="lang"):
    return sorted(tuple(r[k] for k in (group, "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def own(rows):
    return [(r[2], r[1]) for r in rows_of(rows)]


def test_odd_rows_match_brute_force(odd, nothing):
    result = collocations(odd, least=3)
    assert result.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut"]
    want = brute(own(odd_texts()), least=3)
    assert got(result) == want and {x[0] for x in want} == {"en", "fr", "und"}
    assert collocations(nothing).count() == 0 and collocations(odd, least=10**6).count() == 0


def passages(seed, documents):
    rng = random.Random(seed)
    fixed = [prose(seed * 10 + k, 12) for k in range(6)] + ["a a a a a a", "x\x01y  tab\tbed", "red red blue; red"]
    return [" ".join(rng.choice(fixed) if rng.random() < 0.4 else prose(rng.randrange(10**6), 8) for _ in range(rng.randrange(30))) for _ in range(documents)]


@pytest.mark.parametrize(("chunk", "size", "top"), [(2_000_000, 4, 2000), (300, 4, 40), (1000, 3, 7)])
def test_passages_match_brute_force(spark, monkeypatch, chunk, size, top):
    monkeypatch.setattr(c, "CHUNK", chunk)
    rows = [(i, t) for i, t in enumerate(passages(7, 240))]
    df = spark.createDataFrame(rows_of(rows), SCHEMA).repartition(5)
    want = brute(own(rows), size=size, top=top)
    assert got(collocations(df, size=size, top=top)) == want and len(want) >= 3 * min(top, 20)


def test_full_buckets_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(c, "_often", lambda *_: [np.full(1, 255, np.uint8)] * 2)
    rows = [(i, t) for i, t in enumerate(passages(8, 150))]
    df = spark.createDataFrame(rows_of(rows), SCHEMA).repartition(2)
    assert got(collocations(df)) == brute(own(rows))


def test_one_first_word_over_many_parts(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        text = ". ".join(f"the w{k} z{k % 9}" for k in range(120))
        df = spark.createDataFrame(rows_of([(i, text) for i in range(99)]), SCHEMA)
        assert got(collocations(df, top=50)) == brute(own([(i, text) for i in range(99)]), top=50)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_counts_beyond_products_of_64_bits(spark, monkeypatch):
    big = 10**13
    rows = [("en", ["a"], 2 * big), ("en", ["b"], big + 1), ("en", ["a", "b"], big)]
    given = spark.createDataFrame(rows, "group string, words array<string>, f long"), spark.createDataFrame([("en", 5 * big)], "group string, n long")
    monkeypatch.setattr(c, "frequent_phrases", lambda *_: given)
    result = c.collocations(given[0].withColumnRenamed("group", "lang"))
    assert got(result) == [("en", 1, "a b", big, 2 * big, big + 1, 5 * big, 2_000_000 * big // (3 * big + 1))]


def test_long_texts_are_read_whole(spark):
    text = "one two three. " * 60_000
    assert len(text) < 1 << 20
    text += "\t".join(["long", "words"] * 200_000)
    phrases, totals = frequent_phrases(spark.createDataFrame([("en", text)], "lang string, text string"))
    f = {tuple(r["words"]): r["f"] for r in phrases.collect()}
    assert f["long",] == 200_000 and f["words", "long"] == 199_999 and f["long", "words", "long", "words"] == 199_999
    assert f["one", "two", "three"] == 60_000 and ("three", "one") not in f and totals.first()["n"] == 580_000


def test_rows_handed_on_grow_with_phrases_not_with_parts(spark, monkeypatch):
    texts = spark.createDataFrame([("en", "one two three four five six")] * 400, "`group` string, text string").repartition(40)
    frames, plain = [], type(texts).mapInArrow

    def recorded(self, *given):
        frames.append(plain(self, *given))
        return frames[-1]

    monkeypatch.setattr(type(texts), "mapInArrow", recorded)
    counts = c._longer_counts(texts, 4, [np.full(1, 255, np.uint8)] * 2)
    assert sorted(r["n"] for r in counts.collect()) == [400] * 12
    assert frames[0].count() <= 12 * spark.sparkContext.defaultParallelism


def test_a_worker_holds_few_bytes_a_word(spark, monkeypatch):
    """Neither every array of a chunk at once, nor a chunk while the next one is read."""
    monkeypatch.setattr(c, "CHUNK", 200_000)
    monkeypatch.setattr(c, "PLACES", 1 << 14, raising=False)
    monkeypatch.setattr(c, "materialize", lambda df, _: df)
    texts = spark.createDataFrame([], "`group` string, text string")
    made, plain = [], type(texts).mapInArrow
    monkeypatch.setattr(type(texts), "mapInArrow", lambda self, f, schema: made.append(f) or plain(self, f, schema))
    c._words_and_buckets(texts, 3)
    c._longer_counts(texts, 4, [np.full(1, 255, np.uint8)] * 2)
    rng = random.Random(3)
    lines = [" ".join(f"w{rng.randrange(300)}" for _ in range(1000)) for _ in range(20)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 500), pa.array([lines[k % 20] for k in range(500)])], ["group", "text"])
    assert len(made) == 2
    for make in made:
        tracemalloc.start()
        try:
            words = sum(sum(filter(None, out["n"].to_pylist())) for out in make([batch] * 2))
            peak = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
        assert words >= 1_000_000 and peak < 60 * c.CHUNK


def test_many_different_words_end_a_chunk_sooner():
    texts = pa.RecordBatch.from_arrays([pa.array(["en"] * 50), pa.array([" ".join(f"w{k}x{i}" for i in range(100)) for k in range(50)])], ["group", "text"])
    assert [(len(x.codes), x.words) for x in c._chunks([texts], 4000)] == [(1111, 1100)] * 4 + [(606, 600)]
    wide = pa.RecordBatch.from_arrays([pa.array(["en"] * 4), pa.array(["x" * 10_000] * 4)], ["group", "text"])
    assert [len(x.codes) for x in c._chunks([wide], 600)] == [4, 4, 0]
