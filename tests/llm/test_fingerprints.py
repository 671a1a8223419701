import hashlib
import random
import string
from collections import Counter

from pyspark.sql import functions as F

from pactum.llm.fingerprints import combine, edited_fingerprints, fingerprint, likeness, vectors

from .conftest import odd_texts


def test_edited_texts(odd, nothing):
    rows = edited_fingerprints(odd).collect()
    texts = odd_texts()
    assert len(rows) == len(texts) and edited_fingerprints(nothing).count() == 0
    # Ids that occur once, with their neighbours by descending id: null ids come last.
    ids = sorted({i for i, _ in texts if i is not None}, reverse=True)
    body = {i: t or "" for i, t in texts if i is not None}
    for r in rows:
        i = r["doc_id"]
        if i is None or i == 11:
            continue
        at = ids.index(i)
        if at + 1 < len(ids) and ids[at + 1] != 11:
            own, after = body[i], body[ids[at + 1]]
            half = len(own) // 2
            edited = own[:len(own) - half] + after[:half]
            assert r["n_chars"] == len(own) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    by_text = {}
    for r in rows:
        if r["doc_id"] is not None and r["doc_id"] != 11:
            assert by_text.setdefault(body[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
            assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert len(set(by_text.values())) == len(by_text)
    long = next(r for r in rows if r["doc_id"] == 10)
    assert long["near_edited"] > long["near_next"]


def test_single_document_is_its_own_next(spark):
    row = edited_fingerprints(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and row["near_next"] == 1.0


def test_paragraphs_add_and_take_away(spark):
    texts = spark.createDataFrame([("ab", "one two\nthree four five"), ("ba", "three four five\none two"), ("a", "one two"), ("b", "three four five")], "k string, text string")
    vec = vectors(texts, ["k"], "text")
    row = vec.groupBy().pivot("k", ["a", "ab", "b", "ba"]).agg(F.first("vec"))
    got = row.select(fingerprint(F.col("ab")).alias("f_ab"), fingerprint(F.col("ba")).alias("f_ba"), fingerprint(combine(F.col("a"), F.col("b"))).alias("f_sum"),
                     fingerprint(F.col("a")).alias("f_a"), fingerprint(combine(F.col("ab"), F.col("b"), -1)).alias("f_less"),
                     likeness(F.col("ab"), F.col("ba")).alias("same")).first()
    assert got["f_ab"] == got["f_ba"] == got["f_sum"] and got["f_a"] == got["f_less"] and got["f_a"] != got["f_ab"] and got["same"] == 1.0


def pairs_of(text):
    """Neighbouring word pairs of each line; one unit for a line of a word or none."""
    units = Counter()
    for line in text.split("\n"):
        words = line.split(" ")
        units.update(zip(words, words[1:], strict=False) if len(words) > 1 else [(words[0], None)])
    return units


def test_likeness_is_near_that_of_the_pairs(spark):
    rng = random.Random(4)
    texts = {}
    for i in range(60):  # every second text is the one before it with a share of its lines replaced
        lines = [" ".join(rng.choice(string.ascii_lowercase) * rng.randint(1, 4) + str(rng.randint(0, 99)) for _ in range(9)) for _ in range(30)]
        if i % 2:
            kept = rng.randint(0, 30)
            lines = texts[i - 1].split("\n")[:kept] + lines[kept:]
        texts[i] = "\n".join(lines)
    rows = edited_fingerprints(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    off = []
    for r in rows:
        own, after = texts[r["doc_id"]], texts[(r["doc_id"] - 1) % 60]
        half = len(own) // 2
        for told, other in ((r["near_next"], after), (r["near_edited"], own[:len(own) - half] + after[:half])):
            a, b = pairs_of(own), pairs_of(other)
            apart = sum((a[k] - b[k]) ** 2 for k in a.keys() | b.keys())
            off.append(abs(told - (1 - apart / (sum(v * v for v in a.values()) + sum(v * v for v in b.values())))))
    assert len(off) == 120 and sorted(off)[107] <= 0.15 and sum(off) / len(off) <= 0.1
