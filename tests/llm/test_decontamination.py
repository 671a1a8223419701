import hashlib
import re

from pactum.llm.decontamination import contamination, decontaminate

from .conftest import odd_texts, prose

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    ws, hit, found = words(text), set(), set()
    for item, body in items:
        iw = words(body)
        n = min(13, len(iw))
        for j in range(len(iw) - n + 1) if n else []:
            for i in range(len(ws) - n + 1):
                if ws[i:i + n] == iw[j:j + n]:
                    hit.update(range(i, i + n))
                    found.add("" if item is None else str(item))
    return (len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(ws))


ITEMS = [(1, " ".join(prose(10, 20).split()[:16])), (2, prose(1, 120)[:90]), (3, "two WORDS"), (4, None), (5, ""), (6, "..."), (10, "two words"), (None, "日本語"),
         (1, "word"), (7, prose(3, 3000)[500:700])]


def test_matches_brute_force(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = contamination(odd, items).drop("text_hash").collect()
    want = sorted(((i, *brute(t, ITEMS)) for i, t in odd_texts()), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert any(w[5] for w in want) and not all(w[5] for w in want)


def test_empty_tables(spark, odd, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert contamination(nothing, items).count() == 0
    none = contamination(odd, items.filter("false")).collect()
    assert len(none) == odd.count() and not any(r["contaminated"] or r["n_items"] for r in none)


def test_removes_documents_or_spans(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate(odd, items)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.filter("doc_id is not null").collect() if r["text"]) == sorted(
        (i, t) for i, t in odd_texts() if i is not None and t and not brute(t, ITEMS)[4])
    cut = decontaminate(odd, items, remove="spans")
    assert cut.count() == odd.count() and cut.columns == odd.columns
    for r in cut.collect():
        whole = dict((i, t) for i, t in odd_texts() if i is not None).get(r["doc_id"])
        if r["doc_id"] in (5, 4):
            assert words(r["text"]) == []
        elif whole and not brute(whole, ITEMS)[1]:
            assert r["text"] in [t for i, t in odd_texts() if i == r["doc_id"]]
