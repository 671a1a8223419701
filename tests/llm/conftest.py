"""Small documents with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

import pytest
from pyspark.sql import functions as F

WORDS = "the of and to in réd BLUE green, old. New stone river Älter 42 x".split()
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, place long, node int, win string, key string, th long, "
          "copies int, term string, rare string, part int, id string, codes string, leaves int, unders int")


def prose(seed, n):
    rng = random.Random(seed)
    words = [rng.choice(WORDS) + rng.choice(["", "", "", "a", "b", "cd", "efg"]) for _ in range(n)]
    return "".join(w + ("\n" if rng.random() < 0.1 else " ") for w in words).rstrip(" ")


def odd_texts():
    base = prose(1, 120)
    near = base.replace("stone", "stones", 1)
    texts = [(None, prose(2, 30)), (None, None), (1, None), (2, ""), (3, "  \n\t "), (4, "word"), (5, "two Words"), (6, base), (7, base), (8, near),
             (9, base + " tail"), (10, prose(3, 3000)), (11, "x"), (11, "x"), (11, "y"), (12, "!!! ... ###"), (13, "日本語 の テキスト"), (14, "a  b \n c\x00d"),
             (15, base.upper())]
    return texts + [(100 + i, prose(10 + i % 7, 20 + 9 * (i % 7))) for i in range(24)]


def rows_of(texts):
    langs, sources = ["en", "fr", None], ["s1", None, "s2", "s10", "é"]
    return [(i, t, langs[k % 3], sources[k % 5], None if t is None else len(t), k, k, "w", "k", 1, 2, "t", "r", 3, "i", "c", 4, 5)
            for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows_of(odd_texts()), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.filter(F.lit(False))
