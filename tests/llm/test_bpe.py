import hashlib

import public_tokenizers
import pytest

from articlelake.llm import bpe
from tests.llm.fixtures import documents, texts

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _encoding():
    with open(RANKS, "rb") as file:
        return bpe._encoding(file.read(), PATTERN)


@pytest.mark.parametrize("text", [
    "a b c " * 50, "it's  a \n test_x 12 34  x", "word " * 40 + " " * 60 + "end's", "é à ü " * 40, "x" * 300, " " * 300,
    "a\x1cb c\x85d e f " * 30, "日本 語 です " * 40])
def test_pieces_encode_like_the_whole(text, monkeypatch):
    whole = _encoding().encode_ordinary(text)
    for size in (1, 2, 7, 50):
        cut = list(bpe.pieces(text, size))
        assert "".join(cut) == text
        assert [i for piece in cut for i in _encoding().encode_ordinary(piece)] == whole


def test_very_long_texts():
    for text in ("ab " * 200_000, "a" * 300_000, " " * 300_000):
        ids = bpe.encode_text(_encoding(), text)
        assert _encoding().decode_bytes(ids) == text.encode()


def test_round_trip_of_awkward_rows(spark):
    given = texts() + [(300, "🙂 \x00 tail"), (301, "<|endoftext|>")]
    out = bpe.decode(bpe.encode(documents(spark, given, "ids", "_in", "decoded"), RANKS, PATTERN), RANKS, PATTERN)
    assert set(out.columns) == {"doc_id", "text", "_in", "ids", "decoded"}
    rows = out.collect()
    assert len(rows) == len(given)
    for row in rows:
        assert bytes(row.decoded).decode() == (row.text or "") and row._in == 7
        assert row.ids == (_encoding().encode_ordinary(row.text) if row.text else [])


def test_digests(spark):
    row = bpe.token_digests(documents(spark, [(1, "hello world")]), RANKS, PATTERN).first()
    ids = _encoding().encode_ordinary("hello world")
    assert row.n_tokens == len(ids)
    assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(b"hello world").hexdigest()
    empty = bpe.token_digests(documents(spark, [(1, None)]), RANKS, PATTERN).first()
    assert empty.n_tokens == 0 and empty.ids_sha256 == hashlib.sha256(b"").hexdigest() == empty.decoded_sha256
    assert bpe.token_digests(documents(spark, []), RANKS, PATTERN).count() == 0


def test_raw_bytes_need_not_be_text(spark):
    half = spark.createDataFrame([(1, [_encoding()._mergeable_ranks[b"\xc3"]]), (2, None)], "doc_id long, ids array<int>")
    out = {row.doc_id: row.decoded for row in bpe.decode(half, RANKS, PATTERN).collect()}
    assert bytes(out[1]) == b"\xc3" and out[2] is None
