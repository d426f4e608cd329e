"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file."""

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articlelake.llm.common import bound_batches

# Texts longer than this are cut, at safe places only, before the library sees them.
PIECE_CHARS = 1 << 16
# texts encoded before their ids leave the worker
ROWS = 200
# A single blank between two word characters: every pattern that takes white space only as the one
# blank before a word, or in a run of its own, starts a match there, and no match crosses it.
_SAFE = re.compile(r"(?<=\w) (?=\w)")


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` in order, cut before blanks at which the pattern starts a match anyway.

    A stretch without such a blank stays whole, whatever its length.
    """
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


@lru_cache(maxsize=4)
def _encoding(rank_file: bytes, pattern: str) -> tiktoken.Encoding:
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, rank_file.splitlines())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode_text(encoding: tiktoken.Encoding, text: str) -> list[int]:
    ids: list[int] = []
    for piece in pieces(text):
        ids += encoding.encode_ordinary(piece)
    return ids


def _map(docs: DataFrame, source: Column, outs: dict[str, T.DataType], make, ranks: str, pattern: str) -> DataFrame:
    """All columns of ``docs`` and ``outs``, which ``make(encoding, values)`` gives for a batch of ``source``."""
    spark = docs.sparkSession
    bound_batches(spark)
    file = spark.sparkContext.broadcast(Path(ranks).read_bytes())  # one vocabulary, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(file.value, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):  # few ids at a time, also from many short texts
                part = batch.slice(start, ROWS)
                made = make(encoding, part.column(part.num_columns - 1))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names=[*names, *outs])

    names = [name for name in docs.columns if name not in outs]
    given = docs.select(*names, source.alias("__input"))
    made = [T.StructField(name, kind) for name, kind in outs.items()]
    return given.mapInArrow(run, T.StructType([*given.schema.fields[:-1], *made]))


def _encoded(encoding: tiktoken.Encoding, texts: pa.Array) -> list[np.ndarray]:
    """Ids as small whole numbers of four bytes, text by text."""
    return [
        np.array(encode_text(encoding, value.decode("utf-8", "replace")) if value else [], np.int32)
        for value in (text.as_py() for text in texts)
    ]


def _lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*ids, np.zeros(0, np.int32)])))


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``, the token ids of the whole of ``text``, without special tokens.

    Null and empty texts have an empty list.  Bytes that are no UTF-8 count as
    U+FFFD.  A former column ``ids`` is replaced; all others, repeated rows and
    rows without id stay as they are.  ``ranks`` is a file on the driver, whose
    content goes to the tasks; nothing is shuffled.
    """
    def make(encoding, texts):
        return [_lists(_encoded(encoding, texts))]

    return _map(docs, F.col(text).cast("binary"), {ids: T.ArrayType(T.IntegerType())}, make, ranks, pattern)


def decode(docs: DataFrame, ranks: str, pattern: str, ids: str = "ids", raw: str = "decoded") -> DataFrame:
    """Add ``raw``, the bytes that ``ids`` stand for; they need not be valid text.

    A null list gives null, an empty list no bytes; an id outside the vocabulary fails the job.
    """
    def make(encoding, lists):
        values = (item.as_py() for item in lists)
        return [pa.array([None if value is None else encoding.decode_bytes(value) for value in values], pa.binary())]

    return _map(docs, F.col(ids), {raw: T.BinaryType()}, make, ranks, pattern)


def round_trip(
    docs: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids", raw: str = "decoded"
) -> DataFrame:
    """``encode``, then ``decode``, by one Python worker instead of two."""
    def make(encoding, texts):
        found = _encoded(encoding, texts)
        return [_lists(found), pa.array([encoding.decode_bytes(part.tolist()) for part in found], pa.binary())]

    outs = {ids: T.ArrayType(T.IntegerType()), raw: T.BinaryType()}
    return _map(docs, F.col(text).cast("binary"), outs, make, ranks, pattern)


def token_digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each row of ``docs``."""
    both = round_trip(docs.select("doc_id", "text"), ranks, pattern).drop("text")
    listed = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
