"""Language identification with string kernels, Nystroem landmarks and kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum.llm.common import fold, hash60, table
from pactum.plans.session import materialize

#: Byte n-grams of lengths 1 to SPECTRUM, present or not, in 2 ** BITS places.
SPECTRUM, BITS = 3, 14
#: Bounds of the fit: labelled rows in all (at least LEAST for each language) and landmarks (at least one for each language).
SAMPLE, LEAST, LANDMARKS = 4_000, 16, 256
RIDGE = 1e-2
#: Languages whose counts are broadcast; the counts of more are joined as usual.
BROADCAST = 10_000
UNKNOWN = "und"


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # places x languages


def presence(text: str, spectrum: int = SPECTRUM, bits: int = BITS) -> np.ndarray:
    """Which places the n-grams of the whole text fall into."""
    codes = np.frombuffer(text.encode().lower(), np.uint8).astype(np.uint32)
    there = np.zeros(1 << bits, bool)
    gram = np.zeros(len(codes), np.uint32)
    for n in range(1, spectrum + 1):
        if len(codes) < n:
            break
        gram = (gram[:len(codes) - n + 1] << np.uint32(8)) | codes[n - 1:]
        there[((gram + np.uint32(n << 28)) * np.uint32(2654435761)) >> np.uint32(32 - bits)] = True
    return there


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def kernel(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Shared places of each pair over the geometric mean of their numbers."""
    norm = np.sqrt(np.maximum(x.sum(1), 1))[:, None] * np.sqrt(np.maximum(y.sum(1), 1))[None, :]
    return (x @ y.T) / norm


def fit(x: np.ndarray, labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel:
    """One-versus-rest ridge regression in the Nystroem space of landmarks taken in turn from each language,
    so that each has one at least.

    A score is k(x, landmarks) times a matrix; as the kernel is a product over a norm, that matrix is
    multiplied with the landmarks once, and a batch of texts costs one matrix product.
    """
    languages = sorted(set(labels))
    where = np.array([languages.index(v) for v in labels])
    rank = np.zeros(len(where), np.int64)
    for k in range(len(languages)):
        rank[where == k] = np.arange((where == k).sum())
    marks = x[np.lexsort((where, rank))[:max(landmarks, len(languages))]].astype(np.float32)
    values, vectors = np.linalg.eigh(kernel(marks, marks).astype(np.float64))
    keep = values > 1e-8 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    # A few rows at a time: the bit sets of the whole sample stay bytes.
    phi = np.concatenate([kernel(x[at:at + 256].astype(np.float32), marks) for at in range(0, len(x), 256)]).astype(np.float64) @ root
    weight = (1 / np.bincount(where, minlength=len(languages)))[where]
    targets = np.where(where[:, None] == np.arange(len(languages)), 1.0, -1.0)
    scaled = phi * weight[:, None]
    beta = np.linalg.solve(phi.T @ scaled + ridge / len(x) * np.eye(phi.shape[1]), scaled.T @ targets)
    by_mark = root @ beta / np.sqrt(np.maximum(marks.sum(1), 1))[:, None]
    return LanguageModel(languages, (marks.T @ by_mark).astype(np.float32))


def predict(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score, 0 to 1, of each whole text; `und` and 0 without a letter or a model."""
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    known = [i for i, t in enumerate(texts) if has_letter(t)]
    for at in range(0, len(known) if model.languages else 0, 256):
        part = known[at:at + 256]
        x = np.stack([presence(texts[i]) for i in part]).astype(np.float32)
        margins = (x @ model.weights) / np.sqrt(x.sum(1))[:, None]
        best = margins.argmax(1)
        for i, k, m in zip(part, best, margins[np.arange(len(part)), best], strict=True):
            names[i], scores[i] = model.languages[k], float(min(1.0, max(0.0, (m + 1) / 2)))
    return names, scores


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample: int = SAMPLE, least: int = LEAST) -> LanguageModel:
    """Fit on a sample of the rows with a language for which `learn` holds, spread evenly over languages.

    A row is taken if its hash lies below its language's share of the hash space: about `sample` rows in all,
    or `least` for each language, whatever the size of the table. Only counts and those rows' bit sets reach the driver.
    """
    rows = docs.filter(learn & F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), hash60(F.col(id_col), F.col(text_col)).alias("place"))
    counts = materialize(rows.groupBy("lang").count(), "lang-counts")
    languages = counts.count()
    if not languages:
        return LanguageModel([], np.zeros((1 << BITS, 0), np.float32))
    share = F.least(F.lit(1.0), F.lit(float(max(least, sample // languages))) / F.col("count"))
    cuts = counts.select("lang", (share * float(1 << 60)).cast("bigint").alias("cut"))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(presence(t)).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(bits, pa.binary()), batch.column(1), batch.column(2)], ["bits", "lang", "place"])

    got = (rows.join(F.broadcast(cuts) if languages <= BROADCAST else cuts, "lang").filter("place < cut").select("text", "lang", "place")
           .mapInArrow(pack, "bits binary, lang string, place bigint").dropDuplicates(["place"]).collect())
    got.sort(key=lambda r: (r["place"], r["lang"]))
    x = np.stack([np.unpackbits(np.frombuffer(r["bits"], np.uint8)) for r in got])
    return fit(x, [r["lang"] for r in got])


def identify_languages(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: (id, text_hash, lang_pred, score), from the whole text alone.

    Learns from a bounded sample (`SAMPLE` rows, evenly by language) of the rows with `learn` and a language.
    `und` with score 0: null text, text without a letter, or nothing to learn from. Repeated rows
    stay repeated, null ids stay, an empty table gives no rows, other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, learn, id_col, text_col, lang_col))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = predict(model.value, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             ["id", "text_hash", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(score, f"id {kind}, text_hash bigint, lang_pred string, score double").withColumnRenamed("id", id_col)


def with_known_language(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents whose language the classifier can tell (not `und`), all columns as they are."""
    found = identify_languages(docs, learn, id_col, text_col, lang_col).filter(F.col("lang_pred") == UNKNOWN)
    gone = found.select(F.col(id_col).alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct()
    same = docs[id_col].eqNullSafe(gone["gone_id"]) & (F.xxhash64(docs[text_col]) == gone["gone_hash"])
    return docs.join(gone, same, "left_anti")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    return identify_languages(docs, ~held_out).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
