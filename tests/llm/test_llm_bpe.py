import struct

import odd
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from stockweek.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokens():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def reference(tokens):
    ranks = {token: rank for rank, token in enumerate(tokens)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def encoder(tokens):
    return bpe._Encoder(tokens, public_tokenizers.PATTERN)


def ids(data):
    return list(struct.unpack(f"<{len(data) // 4}I", data))


@given(st.text())
@settings(max_examples=300, deadline=None)
def test_ids_equal_those_of_an_independent_library(encoder, reference, text):
    assert ids(encoder.texts([text])[0]) == reference.encode_ordinary(text)


def test_every_token_is_one_id(encoder, tokens):
    found = encoder._model.encode([bpe._mapped(t) for t in tokens], num_threads=1)
    assert found == [[rank] for rank in range(len(tokens))]


def test_cache_that_overflows_changes_nothing(encoder, reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    for n in range(20):
        text = f"word{n} other{n} <|endoftext|>"
        assert ids(encoder.texts([text])[0]) == reference.encode_ordinary(text)


def test_round_trip_of_odd_documents(spark, reference):
    docs = odd.documents(spark)
    model = bpe.ByteBpe(docs, PATH, public_tokenizers.PATTERN)
    found = model.decode(
        model.encode(docs, keep=("doc_id", "text", "score")), keep=("text", "n_tokens", "token_bytes")
    )
    rows = found.collect()
    assert len(rows) == len(odd.texts())
    once = model.round_trip(docs, keep=("text", "decoded"))
    assert sorted(map(str, once.select(found.columns).collect())) == sorted(map(str, rows))
    for row in rows:
        text = row["text"] or ""
        assert bytes(row["decoded"]).decode() == text
        assert row["n_tokens"] == len(row["token_bytes"]) // 4
        if len(text) < 50_000:
            assert ids(row["token_bytes"]) == reference.encode_ordinary(text)


def test_long_texts_in_rounds(encoder, reference, monkeypatch):
    monkeypatch.setattr(bpe, "ROUND_TOKENS", 7)
    for text in ("", "one", "Words, and  more words\n\n  indented 12345 äöü 日本語 " * 9, " \n " * 50):
        assert ids(encoder.long_text(text)) == reference.encode_ordinary(text)


def peak_mb(work):
    """The most memory that the work takes beyond what was there."""
    import gc
    import tracemalloc

    gc.collect()
    tracemalloc.start()
    work()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most / 1e6


def test_memory_of_a_long_text(tokens):
    import types

    import pyarrow as pa

    text = "the quick brown fox jumps over the lazy dog and 12 others\n" * 100_000  # 5.8 MB
    texts = pa.array([text.encode()], pa.large_binary())
    shared = types.SimpleNamespace(value=tokens)
    work = bpe._round_trip_work(shared, public_tokenizers.PATTERN)
    assert peak_mb(lambda: work(texts)) < 8 * len(text) / 1e6 + 10


def test_empty_table(spark):
    docs = odd.documents(spark, [])
    model = bpe.ByteBpe(docs, PATH, public_tokenizers.PATTERN)
    assert model.decode(model.encode(docs, keep=("doc_id",)), keep=("doc_id",)).collect() == []


def test_a_vocabulary_with_gaps_is_refused(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(b"YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError, match="ranks"):
        bpe.read_ranks(str(path))
