"""Text quality from compressed sizes: zstandard dictionaries of good and of bad text."""

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from articlelake.llm.common import bound_batches, labelled_sample, logistic

# A dictionary helps most at the start of a frame, so every text is compressed in pieces of this many bytes.
PIECE = 4096
LEVEL = 6
# Bounds of the training sample: texts of each class, and characters of one text.
PER_CLASS = 1500
MAX_CHARS = 20_000
DICTIONARY_BYTES = 1024 ** 2


@dataclass(frozen=True)
class CompressionModel:
    """Two dictionaries, and the line from the size difference to the log odds of good text."""

    good: bytes
    bad: bytes
    slope: float
    intercept: float

    def score(self, text: str | None) -> float:
        difference = size_difference(text or "", *_compressors(self.good, self.bad))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.slope * difference + self.intercept))))


@lru_cache(maxsize=4)
def _compressors(good: bytes, bad: bytes) -> tuple[zstandard.ZstdCompressor, ...]:
    made = []
    for data in (good, bad):
        dictionary = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=LEVEL)
        made.append(zstandard.ZstdCompressor(
            dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False))
    return tuple(made)


def size_difference(text: str, good, bad) -> float:
    """By how many bytes of each byte the dictionary of good text makes the whole of ``text`` smaller.

    Text that repeats itself is small under either dictionary, so its difference is near 0, below
    that of good text.
    """
    data = text.encode("utf-8", "replace")
    with_good = with_bad = 0
    for start in range(0, len(data), PIECE):
        piece = data[start:start + PIECE]
        with_good += len(good.compress(piece))
        with_bad += len(bad.compress(piece))
    return (with_bad - with_good) / len(data) if data else 0.0


def _dictionary(texts: Sequence[str]) -> bytes:
    """The same share of every text, up to the size of a dictionary."""
    share = max(64, DICTIONARY_BYTES // max(1, len(texts)))
    parts = [text.encode("utf-8", "replace") for text in texts]
    # what the short texts leave over goes to the long ones
    for _ in range(8):
        used = sum(min(len(part), share) for part in parts)
        if used >= 0.95 * DICTIONARY_BYTES or all(len(part) <= share for part in parts):
            break
        share = int(share * 1.25)
    return b"\n".join(part[:share] for part in parts)[:DICTIONARY_BYTES] or b"\n" * 8


def train(examples: Sequence[tuple[str, int]], share: float | None = None) -> CompressionModel:
    """Every other text of a class goes into its dictionary; the rest calibrates the difference.

    ``share`` is the share of good texts that the calibration aims at, by default
    that of ``examples``.  Without examples of both classes it is every score.
    """
    by_class = {value: [text for text, label in examples if label == value] for value in (0, 1)}
    good, bad = (_dictionary(by_class[value][::2]) for value in (1, 0))
    rest = [(text, value) for value in (0, 1) for text in by_class[value][1::2]]
    share = (len(by_class[1]) + 1) / (len(examples) + 2) if share is None else share
    if not by_class[0][1::2] or not by_class[1][1::2]:
        return CompressionModel(good, bad, 0.0, math.log(share / (1 - share)))
    compressors = _compressors(good, bad)
    x = np.array([size_difference(text, *compressors) for text, _ in rest])
    y = np.array([label for _, label in rest], float)
    weight = np.where(y > 0, share / y.sum(), (1 - share) / (1 - y).sum()) * len(y)
    return CompressionModel(good, bad, *logistic(x, y, weight))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS,
        max_chars: int = MAX_CHARS) -> CompressionModel:
    """A model from at most ``per_class`` labelled texts of each class, held-out quarter excepted."""
    examples, share = labelled_sample(docs, labels, label, per_class, max_chars)
    return train(examples, share)


def score(docs: DataFrame, model: CompressionModel, text: str = "text", out: str = "score") -> DataFrame:
    """Add ``out``: the chance, 0 to 1, that the whole text is good.

    Null and empty texts get the chance that belongs to a difference of 0.
    Other columns, repeated rows and rows without id stay as they are; a
    former column ``out`` is replaced.  Nothing is shuffled.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of bounded size
    names = [name for name in docs.columns if name != out]
    given = docs.select(*names, docs[text].alias("__input"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([shared.value.score(value.as_py()) for value in batch.columns[-1]], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], scores], names=[*names, out])

    return given.mapInArrow(run, T.StructType([*given.schema.fields[:-1], T.StructField(out, T.DoubleType())]))
