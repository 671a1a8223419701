import pytest

from pactum.llm.token_counts import piece_counts, pre_tokens, token_counts

from .conftest import odd_texts

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a  b", " a", "a ", "", " ", "  ", "   ", "\n", " \n ", "\n\n\nx", "a \n b", "é\r\n é\r\n", "a▁b ▁c", "<s> hi </s><unk>", "\x00a", "a　b\xa0c", "한국 😀😀 x",
       "x" * 5000, "word " * 3000]


def test_counts_equal_the_library(odd, nothing, spark):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = token_counts(odd, PATH, hot=20).collect()
    want = sorted((str(i), len((t or "").encode()), len(model.encode(t or ""))) for i, t in odd_texts())
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in rows) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in rows)
    assert token_counts(nothing, PATH).count() == 0
    more = token_counts(spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string"), PATH, hot=0).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in more} == {i: len(model.encode(t)) for i, t in enumerate(ODD)}


def test_pre_tokens_cover_the_text():
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text in ODD:
        parts = pre_tokens(text)
        assert b"".join(parts).decode() == (" " + text if text else "")
        assert sum(piece_counts(parts, model)) == len(model.encode(text))
