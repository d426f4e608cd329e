"""Toxicity by a string-subsequence kernel: a support vector machine over Nyström landmarks.

The kernel counts subsequences of four letters that two words share.  Neighbouring letters of a
subsequence may have one other letter between them, and every place that a subsequence spans costs
a factor, so ``idxiot`` stays close to the plain word; letters that stand alone, as in ``i.d.i.o.t``,
are read as one word.  A text is as toxic as the worst word in it.
"""

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from articlelake.llm.common import bound_batches, labelled_sample, logistic

LETTERS = 28  # 0 other characters, 1-26 a-z without marks, 27 other letters
PAIR = LETTERS * LETTERS
DECAY = 0.8  # for each place that a subsequence spans
STEPS = tuple(product((1, 2), repeat=3))  # distances between the four letters
CHUNK = 1 << 20  # letters scored at once
LONGEST = 64  # places of a word that count for its norm
LANDMARKS = 256
ROUNDS = 3  # of looking for hard clean words and training again
HARD = 3000  # clean words added in a round
# Bounds of the training sample: texts of each class, and characters of one text.
PER_CLASS = 1500
MAX_CHARS = 20_000
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


@lru_cache(maxsize=1)
def _codes() -> np.ndarray:
    """Code of each UTF-16 unit: accents and case fall away, digits that stand for letters are read as such."""
    table = np.zeros(65536, np.uint8)
    for unit in range(65536):
        char = chr(unit)
        if char.isalpha():
            first = unicodedata.normalize("NFKD", char.casefold())[0]
            table[unit] = ord(first) - 96 if "a" <= first <= "z" else 27
    for digit, letter in zip("013457@", "oieasta", strict=True):
        table[ord(digit)] = ord(letter) - 96
    return table


def letters(text: str) -> np.ndarray:
    """Letter codes of ``text`` as words between single 0s, with a 0 at both ends.

    A gap between two letters that both stand alone is no gap: spaced-out words close up.
    """
    units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)
    codes = np.concatenate([[0], _codes()[units], [0]]).astype(np.uint8)
    keep = codes > 0
    keep[1:] |= keep[:-1]
    codes = codes[keep] if keep[0] else np.concatenate([[0], codes[keep]]).astype(np.uint8)
    if len(codes) > 4:
        gap = codes == 0
        inner = np.zeros(len(codes), bool)
        inner[2:-2] = gap[2:-2] & gap[:-4] & gap[4:]
        codes = codes[~inner]
    return codes


def _subsequences(codes: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """For each way to step, the code of the subsequence starting at every place, and its weight."""
    n = len(codes)
    padded = np.concatenate([codes.astype(np.int32), np.zeros(8, np.int32)])
    pair = {step: padded[:n + 4] * LETTERS + padded[step:n + 4 + step] for step in (1, 2)}
    for first, second, third in STEPS:
        ahead = first + second
        yield pair[first][:n] * PAIR + pair[third][ahead:ahead + n], DECAY ** (first + second + third)


def _apart(codes: np.ndarray) -> np.ndarray:
    """Two 0s between words instead of one, so that no subsequence steps from word to word."""
    return np.insert(codes, np.flatnonzero(codes == 0), 0)


def _features(codes: np.ndarray) -> Counter:
    """Weights of the subsequences of one word: letters, with a word end at one side at most."""
    found: Counter = Counter()
    for index, weight in _subsequences(_apart(codes)):
        for code in index.tolist():
            a, b = divmod(code, PAIR)
            if a % LETTERS and b // LETTERS and (a // LETTERS or b % LETTERS):
                found[code] += weight
    return found


@lru_cache(maxsize=1)
def _norms() -> np.ndarray:
    """Kernel norm of a word of each length whose subsequences all differ."""
    squares = [
        sum(DECAY ** (2 * sum(steps)) * max(0, n + 2 - sum(steps)) for steps in STEPS) for n in range(LONGEST + 1)
    ]
    return np.sqrt(np.maximum(squares, squares[2]))


def word_scores(codes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each word of ``codes``, and its normalised kernel expansion ``table``."""
    ends = np.flatnonzero(codes == 0)
    if len(ends) < 2:
        return np.zeros(0, int), np.zeros(0)
    apart = _apart(codes)
    at = np.zeros(len(apart), np.float32)
    for index, weight in _subsequences(apart):
        at += np.float32(weight) * table[index]
    # subsequences that begin with the word's leading 0s count for the word
    sums = np.add.reduceat(at, ends[:-1] + np.arange(len(ends) - 1), dtype=np.float64)
    return ends[:-1] + 1, sums / _norms()[np.minimum(np.diff(ends) - 1, LONGEST)]


def _slices(codes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of about ``CHUNK`` places that share the 0 between them; a longer word stays whole."""
    begin = 0
    while begin < len(codes) - 1:
        stop = begin + CHUNK
        if stop < len(codes) - 1:
            gaps = np.flatnonzero(codes[stop:] == 0)
            stop += int(gaps[0])
        else:
            stop = len(codes) - 1
        yield begin, stop + 1
        begin = stop


@dataclass(frozen=True)
class ToxicityModel:
    """The machine, folded into one weight per subsequence, and the line from margin to log odds."""

    table: np.ndarray
    bias: float
    slope: float
    intercept: float

    def margins(self, texts: Sequence[str | None]) -> np.ndarray:
        """The largest margin of any word of each text; a text without words has that of no match."""
        out = np.full(len(texts), self.bias)
        start = 0
        while start < len(texts):
            end, size, parts = start, 0, []
            while end < len(texts) and size < CHUNK:
                parts.append(letters(texts[end] or ""))
                size += len(parts[-1])
                end += 1
            joined, owner_ends = np.concatenate(parts), np.cumsum([len(part) for part in parts])
            for begin, stop in _slices(joined):
                first, scores = word_scores(joined[begin:stop], self.table)
                if len(scores):
                    owner = start + np.searchsorted(owner_ends, first + begin, side="right")
                    np.maximum.at(out, owner, scores + self.bias)
            start = end
        return out

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        odds = np.clip(self.slope * self.margins(texts) + self.intercept, -50, 50)
        return 1 / (1 + np.exp(-odds))


def _telling(words: Counter, others: Counter, n: int, n_others: int, want: int) -> list[str]:
    """Words far more frequent, by documents, in the first class: by likelihood ratio, 16 at least."""
    gain = {}
    for word, count in words.items():
        rate, both = count / n, (count + others[word]) / (n + n_others)
        if rate > 4 * (others[word] + 0.5) / n_others:
            rest = others[word] * math.log(max(others[word], 1e-9) / n_others / both) if others[word] else 0.0
            gain[word] = 2 * (count * math.log(rate / both) + rest)
    return sorted((w for w in gain if gain[w] >= 16), key=lambda word: (-gain[word], word))[:want]


def disguised(word: np.ndarray) -> list[np.ndarray]:
    """The same word with a foreign letter after its second, and after its third letter."""
    return [np.insert(word, at, 27) for at in (3, 4) if len(word) > 5]


def _svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 3e-6, rounds: int = 40):
    """Squared-hinge linear machine with bias: Newton steps on the examples inside the margin."""
    data = np.concatenate([z, np.ones((len(z), 1))], 1)
    w = np.zeros(data.shape[1])
    pull = ridge * len(z) * np.eye(len(w))
    pull[-1, -1] = 1e-6
    for _ in range(rounds):
        inside = y * (data @ w) < 1
        a, c = data[inside], weight[inside]
        new = np.linalg.solve((a * c[:, None]).T @ a + pull, (a * c[:, None]).T @ y[inside])
        done = np.abs(new - w).max() < 1e-7
        w = 0.5 * w + 0.5 * new if not done else new
        if done:
            break
    return w[:-1], float(w[-1])


def train(examples: Sequence[tuple[str, int]], share: float | None = None) -> ToxicityModel:
    """A model from labelled texts, cut into sentences and words.

    Landmarks are the words that tell toxic texts from clean ones, and frequent
    clean words.  Only some words of a toxic text are toxic: its telling words
    stand for it, also in disguise.  Against them stand words of clean texts,
    first the frequent ones, then, in each round, those that the machine finds
    worst.  Every fourth text is kept from training to calibrate margins;
    ``share`` is the share of toxic texts that the calibration aims at.
    """
    labels = np.array([label for _, label in examples], float)
    prior = (labels.sum() + 1) / (len(labels) + 2) if share is None else share
    rest = np.zeros(len(labels), bool)
    for value in (0, 1):
        rest[np.flatnonzero(labels == value)[3::4]] = True
    counts, size = {0: Counter(), 1: Counter()}, {0: 1, 1: 1}
    for (text, label), out in zip(examples, rest, strict=True):
        if not out:
            codes = [letters(sentence).tobytes() for sentence in _SENTENCE.split(text)]
            counts[label].update({word for sentence in codes for word in sentence.split(b"\0") if len(word) > 1})
            size[label] += 1
    toxic = _telling(counts[1], counts[0], size[1], size[0], 3 * LANDMARKS // 4)
    if not toxic or not counts[0] or not (labels[rest] == 1).any() or not (labels[rest] == 0).any():
        return ToxicityModel(np.zeros(PAIR * PAIR, np.float32), 0.0, 0.0, math.log(prior / (1 - prior)))
    clean = [word for word, _ in sorted(counts[0].items(), key=lambda item: (-item[1], item[0]))]
    negative = [word for word in clean if word not in toxic]

    def coded(word: bytes) -> np.ndarray:
        return np.frombuffer(b"\0" + word + b"\0", np.uint8)

    landmarks = [_features(coded(word)) for word in toxic + negative[:LANDMARKS // 4]]
    landmarks = [found for found in landmarks if found]
    codes = np.array(sorted({code for found in landmarks for code in found}))
    place = {code: i for i, code in enumerate(codes.tolist())}
    phi = np.zeros((len(landmarks), len(codes)))
    for i, found in enumerate(landmarks):
        for code, weight in found.items():
            phi[i, place[code]] = weight
    phi /= np.linalg.norm(phi, axis=1, keepdims=True)
    values, vectors = np.linalg.eigh(phi @ phi.T)
    use = values > 1e-4 * values.max()
    root = vectors[:, use] / np.sqrt(values[use])  # Nyström: kernel values to coordinates

    def coordinates(words: list[np.ndarray]) -> np.ndarray:
        kernel = np.zeros((len(words), len(landmarks)))
        for i, word in enumerate(words):
            for code, weight in _features(word).items():
                if code in place:
                    kernel[i] += weight * phi[:, place[code]]
            kernel[i] /= _norms()[min(len(word) - 2, LONGEST)]
        return kernel @ root

    forms = [(form, counts[1][word]) for word in toxic for form in [coded(word), *disguised(coded(word))]]
    n_toxic, chosen = len(forms), set(negative[:HARD])
    z = np.concatenate([coordinates([f for f, _ in forms]), coordinates([coded(w) for w in negative[:HARD]])])
    seen = [n for _, n in forms] + [counts[0][word] for word in negative[:HARD]]
    everything = np.concatenate([np.frombuffer(b"\0" + b"\0".join(negative) + b"\0", np.uint8)])
    for last in range(ROUNDS + 1):
        y = np.where(np.arange(len(z)) < n_toxic, 1.0, -1.0)
        weight = np.sqrt(np.array(seen, float))  # words of many texts count for more
        weight *= np.where(y > 0, 0.5 / weight[:n_toxic].sum(), 0.5 / weight[n_toxic:].sum()) * len(y)
        w, bias = _svm(z, y, weight)
        table = np.zeros(PAIR * PAIR, np.float32)
        table[codes] = (root @ w) @ phi
        if last < ROUNDS:
            _, scores = word_scores(everything, table)
            hard = [negative[i] for i in np.argsort(-scores, kind="stable")[:HARD] if negative[i] not in chosen]
            chosen.update(hard)
            seen += [counts[0][word] for word in hard]
            z = np.concatenate([z, coordinates([coded(word) for word in hard])]) if hard else z
    model = ToxicityModel(table, bias, 1.0, 0.0)
    kept = np.flatnonzero(rest)
    margins, y = model.margins([examples[i][0] for i in kept]), labels[kept]
    weight = np.where(y > 0, prior / max(1, y.sum()), (1 - prior) / max(1, (1 - y).sum())) * len(y)
    return ToxicityModel(table, bias, *logistic(margins, y, weight))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS,
        max_chars: int = MAX_CHARS) -> ToxicityModel:
    """A model from at most ``per_class`` labelled texts of each class, held-out quarter excepted."""
    examples, share = labelled_sample(docs, labels, label, per_class, max_chars)
    return train(examples, share)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """Add ``out``: the chance, 0 to 1, that the whole text is toxic.

    Null, empty and letterless texts get the chance that belongs to no match.
    Other columns, repeated rows and rows without id stay as they are; a
    former column ``out`` is replaced.  Nothing is shuffled.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 28 ** 4 numbers, whatever the data
    names = [name for name in docs.columns if name != out]
    given = docs.select(*names, docs[text].alias("__input"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(shared.value.scores(batch.columns[-1].to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], scores], names=[*names, out])

    return given.mapInArrow(run, T.StructType([*given.schema.fields[:-1], T.StructField(out, T.DoubleType())]))
