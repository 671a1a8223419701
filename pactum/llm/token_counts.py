"""Token counts of documents from the piece counts of distinct pre-tokens."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum.llm.common import repeat_copies, table
from pactum.llm.terms import count_terms, frequent, is_marker, rare_array, with_marker
from pactum.plans.session import materialize

#: Most frequent pre-tokens, resolved where documents are read; all others are joined.
HOT = 200_000
PRE_TOKEN = re.compile(r"\n[^ \n]*| +[^ \n]*")


def pre_tokens(text: str) -> list[bytes]:
    """Runs that no piece can cross: each starts with its spaces or its line feed.

    The tokenizer puts one space before a text, so the first run gets one too.
    """
    return [p.encode() for p in PRE_TOKEN.findall(" " + text)] if text else []


def _processor(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    inner = [p for p in pieces if "▁" in p.lstrip("▁") or ("\n" in p and len(p) > 1)]
    if inner or model.encode("a  b\n") != model.encode("a") + model.encode(" b") + model.encode("\n")[1:]:
        raise ValueError(f"pieces of {path} can cross spaces or lines, so counts of pre-tokens would not add up")
    return model


def piece_counts(terms: list[bytes], model) -> list[int]:
    """Pieces of each pre-token where it stands. The model adds a space in front of what it is given:
    that replaces the run's own first space, and is taken off again before a line feed."""
    texts = [t.decode()[1:] if t[:1] == b" " else t.decode() for t in terms]
    sizes = [len(ids) for ids in model.encode(texts, num_threads=1)] if texts else []
    return [1 if t == b" " else n - (t[:1] != b" ") for t, n in zip(terms, sizes, strict=True)]


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096, hot: int = HOT) -> DataFrame:
    """One row per document: (id, n_bytes, n_tokens, over_limit), equal to encoding each whole text.

    Pieces never cross a space that follows other characters, nor a line feed, so the count of a text is
    the sum over its pre-tokens. Each distinct pre-token of the corpus is encoded once. The `hot` most
    frequent ones (a fixed bound) go to the workers that read the documents; rarer ones are joined to the
    documents' frequencies. Ids of tokens are never kept. Null text is empty and has no tokens; rows equal
    in id and text give equal rows; an empty table gives none; other columns are ignored. `model_path`
    must be readable on every worker.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _processor(model_path)
        for batch in batches:
            counts = piece_counts(batch.column(0).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["term", "n", "pieces"])

    vocabulary = materialize(count_terms(texts, "text", pre_tokens).mapInArrow(encode, "term binary, n bigint, pieces bigint"), "token-vocabulary")
    top = frequent(vocabulary, hot, "pieces")
    known = dict(zip(top["term"].to_pylist(), top["pieces"].to_pylist(), strict=True))
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def tally(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        for batch in batches:
            sums, sizes, rest = [], [], []
            for value in batch.column(2):
                value = value.as_py()
                total, rare = 0, {}
                for term, tf in Counter(pre_tokens(value)).items():
                    n = pieces.get(term)
                    if n is None:
                        rare[term] = tf
                    else:
                        total += n * tf
                sums.append(total)
                sizes.append(len(value.encode()))
                rest.append(rare)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), rare_array(rest)],
                                             ["id", "th", "n_bytes", "hot_tokens", "rare"])

    id_type = texts.schema["id"].dataType.simpleString()
    per_doc = texts.mapInArrow(tally, f"id {id_type}, th bigint, n_bytes bigint, hot_tokens bigint, rare array<struct<term:binary,tf:int>>")
    joined = with_marker(per_doc, ["id", "th"], "rare").join(vocabulary.select("term", "pieces"), "term", "left")
    summed = joined.groupBy("id", "th", "n_bytes", "hot_tokens").agg(
        F.coalesce(F.sum(F.col("tf") * F.col("pieces")), F.lit(0)).alias("rare_tokens"), F.count(F.when(is_marker(), 1)).alias("copies"))
    n_tokens = (F.col("hot_tokens") + F.floor(F.col("rare_tokens") / F.col("copies"))).cast("bigint")
    out = summed.select(F.col("id").alias(id_col), "n_bytes", n_tokens.alias("n_tokens"), "copies")
    return repeat_copies(out, "copies").withColumn("over_limit", F.col("n_tokens") > limit)


def op8_token_counts(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    if model_path is None:
        import public_tokenizers

        model_path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts(table(spark, sf_dir, "documents"), model_path)
