"""Phrase collocation mining by prefix-free parsing.

Texts are lower-cased (A-Z only), cut into pieces at sentence marks and line
ends, and pieces into words at blanks and tabs, in one Arrow pass over the
documents.  Each piece, framed by ``W`` empty words at both ends, is parsed into chunks: a window of ``W`` words whose
hash is 0 modulo ``MODULUS`` triggers a cut, and each chunk runs from one
trigger window to the end of the next, so neighbours overlap by ``W`` words.
Equal content gives equal chunks wherever it stands, so a passage shared by
many documents becomes one dictionary entry with its parse frequency.

N-grams of up to ``W + 1`` words are counted inside the distinct chunks and
weighted by their frequency; an occurrence belongs to the chunk where it
starts before the trailing overlap, so each is counted once.  Frequent words
get numbers, and the chunks become arrays of them; level by level n-grams are
pairs of numbers of two words each, added up by whole arrays in the tasks and
by an aggregate after them.  Which n-grams of the level before are frequent is
sent to the tasks as bits of a fixed number at most, however many they are.
"""

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from articlelake.llm.common import bound_batches
from articlelake.llm.ngram_join import ngrams
from articlelake.session import settle

# Fixed values of the contract
PIECE_MARKS = b".,;:!?\x0A\x0B\x0C\x0D"  # words end at these, blanks and tabs
UNKNOWN_LANG = "und"
MIN_COUNT = 30
LONGEST = 4
SCALE = 2_000_000
COVER = (80, 100)  # a candidate inside a longer one with 100 f(longer) >= 80 f goes
TOP = 2000

W = 3  # words in a trigger window; n-grams up to W + 1 words never straddle a chunk
MODULUS = 16  # chunks are about this many words long
BROADCAST_ROWS = 6_000_000  # frequent words sent to the tasks, some 12 bytes each beside their text,
BROADCAST_BYTES = 96 * 1024 ** 2  # and the bytes of that; beyond either, shuffled joins on text
SPARSE = 32  # bits for each frequent n-gram of a level, so that few others share one
MOST_BITS = 28  # 2 ** 28 bits (32 MB) for a level at most; with more n-grams more others share a bit and are counted

ROW = 2048  # words in a row of numbered chunks, or one chunk
HELD = 2_000_000  # occurrences that a task adds up at once
HASHED = 65_536  # words held as Python objects at once

UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PLAIN = bytes.maketrans(UPPER + PIECE_MARKS, UPPER.lower() + b"\n" * len(PIECE_MARKS))


def _chunks(text: bytes) -> Iterator[bytes]:
    """Chunks of each piece: the words where occurrences start, joined by blanks, a tab,
    then the words of the overlap joined by tabs (framing words left out)."""
    plain = text.translate(_PLAIN)
    pieces = [words for piece in plain.split(b"\n") if (words := piece.split())]
    if not pieces:
        return
    words, ends = list(chain.from_iterable(pieces)), np.cumsum([len(piece) for piece in pieces])
    cuts = np.concatenate([[0], ends])
    if len(words) >= W:
        at = np.flatnonzero(ngrams(plain, W) % np.uint64(MODULUS) == 0)
        cuts = np.union1d(cuts, at[ends[np.searchsorted(ends, at, "right")] >= at + W])  # no window leaves its piece
    inside = ends[np.searchsorted(ends, cuts[1:])] != cuts[1:]
    places = cuts.tolist()
    for start, stop, overlaps in zip(places, places[1:], inside.tolist()):
        yield b" ".join(words[start:stop]) + b"\t" + (b"\t".join(words[stop:stop + W]) if overlaps else b"")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, chunk`` of all texts."""
    for batch in batches:
        langs, chunks = [], []
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            before = len(chunks)
            chunks.extend(_chunks(text or b""))
            langs += [UNKNOWN_LANG if lang is None else lang] * (len(chunks) - before)
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(chunks, pa.string())],
                                         names=["lang", "chunk"])


def chunk_dictionary(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, chunk, freq`` of every distinct chunk of the parse.

    A chunk is text: the words at which its occurrences start, joined by
    blanks, then a tab and the words it shares with the next chunk, joined by
    tabs.  Words hold neither blank nor tab.  Chunks of equal text count
    alike, so they are one entry.
    """
    bound_batches(docs.sparkSession)
    source = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").cast("binary").alias("text"))
    parsed = source.mapInArrow(_parse, "lang string, chunk string")
    return parsed.groupBy("lang", "chunk").agg(F.count("*").alias("freq"))


def _grams(dictionary: DataFrame, m: int) -> DataFrame:
    """``lang, freq, gram`` for each occurrence of an ``m``-word n-gram in each distinct chunk.

    A match starts at a word that follows the start or a blank, never a tab, so
    no occurrence that starts in the overlap is counted here: each is counted once.
    """
    pattern = "(?<![^ ])(?=([^ \\t]+(?:[ \\t][^ \\t]+){%d}))" % (m - 1)
    found = F.regexp_extract_all("chunk", F.lit(pattern), 1)
    exploded = dictionary.select("lang", "freq", F.explode(found).alias("gram"))
    return exploded.select("lang", "freq", F.translate("gram", "\t", " ").alias("gram"))


def _counted(rows: DataFrame, min_count: int, m: int) -> DataFrame:
    return settle(rows.groupBy("lang", "phrase").agg(F.sum("freq").alias("f"))
                  .where(F.col("f") >= min_count).withColumn("size", F.lit(m)))


def _places(batch: pa.RecordBatch):
    """All words of a batch of chunks in a row: number of the language and word among the distinct ones, those
    as two arrays, the frequency of the chunk where an occurrence may start, else 0, and the ends of chunks.

    A chunk without overlap ends in an empty word, one with overlap in ``W`` words where nothing starts: no
    n-gram of at most ``W + 1`` words that starts in a chunk leaves it, but for such with an empty word.
    """
    chunk = batch.column("chunk")
    lists = pc.split_pattern(pc.replace_substring(chunk, "\t", " "), " ")
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = pc.count_substring(chunk, " ").to_numpy(zero_copy_only=False).astype(np.int64) + 1
    words, langs = pc.list_flatten(lists).dictionary_encode(), batch.column("lang").dictionary_encode()
    ends = np.cumsum(sizes)
    within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
    freq = batch.column("freq").to_numpy(zero_copy_only=False).astype(np.int64)
    weights = np.where(within < np.repeat(starts, sizes), np.repeat(freq, sizes), 0)
    both = np.repeat(langs.indices.to_numpy(zero_copy_only=False).astype(np.int64), sizes) * len(words.dictionary)
    distinct, at = np.unique(both + words.indices.to_numpy(zero_copy_only=False), return_inverse=True)
    lang_of = langs.dictionary.take(pa.array(distinct // max(1, len(words.dictionary))))
    word_of = words.dictionary.take(pa.array(distinct % max(1, len(words.dictionary))))
    return at, lang_of, word_of, weights, ends


def _word_counts(dictionary: DataFrame) -> DataFrame:
    """``lang, phrase, freq``: counts of words, summed within each Arrow batch."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, langs, words, weights, _ = _places(batch)
            sums = np.zeros(len(words), np.int64)
            np.add.at(sums, at, weights)
            rows = pa.RecordBatch.from_arrays([langs, words, pa.array(sums)], names=["lang", "phrase", "freq"])
            yield rows.filter(pa.array(sums > 0))  # the empty words at ends of chunks go

    return dictionary.mapInArrow(emit, "lang string, phrase string, freq long")


def _hashes(langs: pa.Array, words: pa.Array, seed: int) -> np.ndarray:
    """A 64-bit hash for each word of a language."""
    of = {lang: xxhash.xxh3_64_intdigest(lang, seed=seed) for lang in langs.unique().to_pylist()}
    hashes = np.zeros(len(words), np.uint64)
    for at in range(0, len(words), HASHED):
        pairs = zip(langs[at:at + HASHED].to_pylist(), words[at:at + HASHED].to_pylist(), strict=True)
        hashes[at:at + HASHED] = [xxhash.xxh3_64_intdigest(word, seed=of[lang]) for lang, word in pairs]
    return hashes


class Words:
    """Frequent words of the languages, numbered in the order of their hashes; found by hash and compared as text."""

    def __init__(self, langs: pa.Array, words: pa.Array):
        self.seed = 0
        while True:  # two frequent words with one hash: another seed
            hashes = _hashes(langs, words, self.seed)
            order = np.argsort(hashes)
            self.hashes = hashes[order]
            if not (self.hashes[1:] == self.hashes[:-1]).any():
                break
            self.seed += 1
        self.langs, self.words = langs.take(pa.array(order)).dictionary_encode(), words.take(pa.array(order))

    def __len__(self) -> int:
        return len(self.words)

    def numbers(self, langs: pa.Array, words: pa.Array) -> np.ndarray:
        """The number of each word, or -1."""
        if not len(self) or not len(words):
            return np.full(len(words), -1, np.int32)
        hashes = _hashes(langs, words, self.seed)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self) - 1)
        near = np.flatnonzero(self.hashes[at] == hashes)
        found, rows = pa.array(at[near]), pa.array(near)
        equal = pc.and_(pc.equal(self.words.take(found), words.take(rows)),
                        pc.equal(self.langs.take(found).dictionary_decode(), langs.take(rows)))
        ids, near = np.full(len(words), -1, np.int32), near[equal.to_numpy(zero_copy_only=False).astype(bool)]
        ids[near] = at[near]
        return ids


def _numbers_of(numbers: Words | dict[str, dict[str, int]], langs: pa.Array, words: pa.Array) -> np.ndarray:
    if isinstance(numbers, Words):
        return numbers.numbers(langs, words)
    known = [numbers.get(lang, {}).get(word, -1) for lang, word in zip(langs.to_pylist(), words.to_pylist(), strict=True)]
    return np.array(known, np.int32)


def _numbered(dictionary: DataFrame, numbers) -> DataFrame:
    """``ids, weights``: the words of whole chunks as int32 numbers (-1: not frequent, or no word) and the frequency
    of the chunk where an occurrence may start, else 0, as int64; some ``ROW`` words a row.

    ``numbers`` is a broadcast of ``Words``, or of numbers by language and word."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, langs, words, weights, ends = _places(batch)
            ids = _numbers_of(numbers.value, langs, words)[at]
            cuts = np.unique(ends[np.minimum(np.searchsorted(ends, np.arange(ROW, len(ids) + ROW, ROW)), len(ends) - 1)])
            cuts = [0, *cuts.tolist()] if len(ids) else [0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()) for part in (ids, weights)],
                names=["ids", "weights"])

    return dictionary.mapInArrow(emit, "ids binary, weights binary")


def _mixed(keys: np.ndarray, last: np.ndarray | None) -> np.ndarray:
    """One 64-bit number for each pair, nearly always another one."""
    mixed = keys.astype(np.uint64)
    if last is not None:
        mixed = mixed + (last.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(29))


def _slots(keys: np.ndarray, last: np.ndarray | None, bits: int) -> np.ndarray:
    return (_mixed(keys, last) >> np.uint64(64 - bits)).astype(np.int64)


def _may_be_frequent(keys: np.ndarray, last: np.ndarray | None, where: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which n-grams have their bit among the ``known`` ones (2 ** n bits); all frequent ones have, and a few others."""
    found, some = np.zeros(len(keys), bool), np.flatnonzero(where)
    slots = _slots(keys[some], None if last is None else last[some], len(known).bit_length() + 2)
    found[some] = (known[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 > 0
    return found


def _summed(keys: list[np.ndarray], last: list[np.ndarray], weights: list[np.ndarray]) -> pa.RecordBatch:
    key, other, weight = np.concatenate(keys), np.concatenate(last) if last else None, np.concatenate(weights)
    order = np.argsort(key if other is None else _mixed(key, other), kind="stable")
    key = key[order]
    new = key[1:] != key[:-1]
    if other is not None:
        other = other[order]
        new |= other[1:] != other[:-1]
    first = np.flatnonzero(np.concatenate([[True], new]))
    sums = pa.array(np.add.reduceat(weight[order], first))
    parts = [pa.array(key[first]), *([] if other is None else [pa.array(other[first])]), sums]
    return pa.RecordBatch.from_arrays(parts, names=["key", "freq"] if other is None else ["key", "last", "freq"])


def _longer_counts(numbered: DataFrame, base: int, levels) -> DataFrame:
    """``key, freq`` of the n-grams two words longer than ``levels`` (a broadcast list of the bits of frequent n-grams
    of 2, 3, ... words) is long: partial counts where both their shorter parts may be frequent.

    ``key`` is the pair of the first two words (``first * base + second``); longer ones have ``last`` too, the third
    word or the pair of the third and fourth.  An n-gram of which a part only shares a bit with a frequent one has
    its whole count as well, which is too low.
    """
    m = len(levels.value) + 2

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, last, weights, held = [], [], [], 0
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), np.int32).astype(np.int64)
            starts = np.frombuffer(b"".join(batch.column("weights").to_pylist()), np.int64)
            if len(ids) < m:
                continue
            pairs, use = ids[:-1] * base + ids[1:], (ids[:-1] >= 0) & (ids[1:] >= 0)
            for size, known in enumerate(levels.value, 2):  # of n-grams of that size, and so of the longer ones
                length = len(ids) - size + 1
                use = _may_be_frequent(pairs[:length], _last(ids, pairs, size), use, known)
                use = use[:-1] & use[1:]
            use = np.flatnonzero(use & (starts[:len(use)] > 0))
            if len(use):
                keys.append(pairs[use])
                weights.append(starts[use])
                if m > 2:
                    last.append(_last(ids, pairs, m)[use])
                held += len(use)
            if held >= (HELD if m == 2 else HELD // 2):
                yield _summed(keys, last, weights)
                keys, last, weights, held = [], [], [], 0
        if held:
            yield _summed(keys, last, weights)

    return numbered.mapInArrow(emit, "key long, freq long" if m == 2 else "key long, last long, freq long")


def _last(ids: np.ndarray, pairs: np.ndarray, size: int) -> np.ndarray | None:
    """What follows the first two words of each n-gram of ``size`` words."""
    return None if size == 2 else ids[2:] if size == 3 else pairs[2:]


def _bits(counted: DataFrame, rows: int) -> np.ndarray:
    """The bits of the n-grams ``key`` or ``key, last``: ``SPARSE`` for each of the ``rows``, as far as they may go."""
    bits = min(MOST_BITS, max(16, (SPARSE * rows).bit_length()))
    columns = [c for c in ("key", "last") if c in counted.columns]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = _slots(*[batch.column(c).to_numpy() for c in columns], *[None] * (2 - len(columns)), bits)
            yield pa.RecordBatch.from_arrays([pa.array(slots + 1)], names=["slot"])  # bit 1 is the first of a part

    slots = counted.select(*columns).mapInArrow(emit, "slot long").withColumn("part", F.bitmap_bucket_number("slot"))
    # dealt out as numbers: bits of each task, 4 KB for a part, would be much more
    parts = slots.repartition("part").groupBy("part").agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    known = np.zeros((1 << bits) // 8, np.uint8)
    for part, found in zip(*[column.to_pylist() for column in parts.toArrow().columns], strict=True):
        known[(part - 1) * len(found):part * len(found)] = np.frombuffer(found, np.uint8)[:len(known)]
    return known


def _phrases(level: DataFrame, base: int, words, m: int) -> DataFrame:
    """``lang, phrase, f, size`` from ``key, f`` or ``key, last, f``; ``words`` is a broadcast of ``Words``."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, last = batch.column("key").to_numpy(), batch.column("last").to_numpy() if m > 2 else None
            ids = [pair // base, pair % base, *([] if m == 2 else [last] if m == 3 else [last // base, last % base])]
            known = words.value
            spelled = pc.binary_join_element_wise(*[known.words.take(pa.array(part)) for part in ids], " ")
            langs = known.langs.take(pa.array(ids[0])).dictionary_decode()
            yield pa.RecordBatch.from_arrays([langs, spelled, batch.column("f")], names=["lang", "phrase", "f"])

    return level.mapInArrow(emit, "lang string, phrase string, f long").withColumn("size", F.lit(m))


def frequent_ngrams(dictionary: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``lang, phrase, size, f`` of every n-gram of 1 to ``LONGEST`` words counted ``min_count`` times or more.

    Level by level: an n-gram of m words is counted only where both its
    (m - 1)-word parts are frequent, since it is never more frequent than they
    are.  Frequent words go to every task with their numbers, and the frequent
    n-grams of a level as bits (32 MB at most), so the test is made where the
    chunks are and counts are summed before the shuffle.  An n-gram that passes
    by a shared bit is counted too and goes by its count: bits only save work.
    Beyond ``BROADCAST_ROWS`` frequent words or ``BROADCAST_BYTES`` of them (both
    counted) the test is a shuffled semi join on phrase keys.
    """
    spark = dictionary.sparkSession
    bound_batches(spark)
    level = _counted(_word_counts(dictionary), min_count, 1)
    n_words, n_bytes = level.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("phrase")), F.lit(0))).first()
    found, small = [level], n_words <= BROADCAST_ROWS and n_bytes <= BROADCAST_BYTES
    if small:
        table = level.select("lang", "phrase").toArrow()  # bounded by the counts
        known = Words(*[pa.concat_arrays([pa.array([], pa.string()), *column.cast(pa.string()).chunks]) for column in table.columns])
        base, levels, words = max(1, len(known)), [], spark.sparkContext.broadcast(known)
        numbered = settle(_numbered(dictionary, words))
    for m in range(2, LONGEST + 1):
        if small:
            sent = spark.sparkContext.broadcast(levels)
            counts = _longer_counts(numbered, base, sent)
            counted = settle(counts.groupBy(*counts.columns[:-1]).agg(F.sum("freq").alias("f")).where(F.col("f") >= min_count))
            sent.destroy()
            level = settle(_phrases(counted, base, words, m))
            if m < LONGEST:
                levels = [*levels, _bits(counted, counted.count())]
        else:
            before = level.select("lang", "phrase")
            grams = _grams(dictionary, m).select(
                "lang", "freq", F.col("gram").alias("phrase"),
                F.substring_index("gram", " ", m - 1).alias("head"), F.substring_index("gram", " ", 1 - m).alias("tail"))
            grams = grams.join(before.withColumnRenamed("phrase", "head"), ["lang", "head"], "left_semi")
            grams = grams.join(before.withColumnRenamed("phrase", "tail"), ["lang", "tail"], "left_semi")
            level = _counted(grams, min_count, m)
        found.append(level)
    union = found[0]
    for part in found[1:]:
        union = union.unionByName(part)
    return union.select("lang", "phrase", "size", "f")


def ngram_counts(dictionary: DataFrame) -> DataFrame:
    """``lang, phrase, size, f`` of every n-gram of 1 to ``LONGEST`` words (all of them: for tests)."""
    parts = [_grams(dictionary, m).select("lang", "freq", F.col("gram").alias("phrase"), F.lit(m).alias("size"))
             for m in range(1, LONGEST + 1)]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.groupBy("lang", "phrase", "size").agg(F.sum("freq").alias("f"))


def _words_of(phrase: str = "phrase"):
    return F.split(F.col(phrase), " ")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> DataFrame:
    """Each language's ``top`` collocations: ``lang, rank, phrase, a, l, r, n, score`` (numbers long).

    ``n``: word occurrences of the language; ``a``: occurrences of the phrase
    (2 to ``LONGEST`` words, ``a >= MIN_COUNT``), overlapping ones too; a cut
    after the first k words scores ``floor(SCALE * a / (l + r))`` with ``l`` and
    ``r`` the counts of both parts; the lowest cut counts, ties to the smallest
    k.  Candidates inside a longer candidate counted at least 80 % as often are
    dropped.  Order: score, a descending, phrase ascending in UTF-8 bytes.
    Null texts are empty, null languages ``und``; empty tables give no rows;
    other columns of ``docs`` are not read.
    """
    dictionary = settle(chunk_dictionary(docs, text, lang))
    # word occurrences: words at the start positions of each chunk, weighted
    starts = F.size(F.split(F.substring_index("chunk", "\t", 1), " "))  # a chunk has one word at least
    totals = dictionary.groupBy("lang").agg(F.sum(starts * F.col("freq")).alias("n"))
    counts = frequent_ngrams(dictionary)  # the parts of a candidate are at least as frequent as it is
    candidates = counts.where(F.col("size") >= 2).select("lang", "phrase", "size", F.col("f").alias("a"))

    parts = counts.select("lang", F.col("phrase").alias("part"), F.col("f").alias("count"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "*", F.array_join(F.slice(_words_of(), 1, F.col("k")), " ").alias("first"),
        F.array_join(F.slice(_words_of(), F.col("k") + 1, F.col("size")), " ").alias("rest"))
    left = parts.withColumnRenamed("part", "first").withColumnRenamed("count", "l")
    right = parts.withColumnRenamed("part", "rest").withColumnRenamed("count", "r")
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn(
        "score", F.expr(f"cast(a as decimal(38, 0)) * {SCALE} div (l + r)"))
    best = F.min_by(F.struct("l", "r", "score"), F.struct("score", "k"))
    chosen = scored.groupBy("lang", "phrase", "a").agg(best.alias("_cut")).select(
        "lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")

    # every shorter contiguous phrase inside a longer candidate, with the largest count of those around it
    inner = F.expr("""flatten(transform(sequence(2, size - 1),
        m -> transform(sequence(1, size - m + 1), s -> array_join(slice(split(phrase, ' '), s, m), ' '))))""")
    covers = candidates.where(F.col("size") >= 3).select("lang", F.explode(inner).alias("phrase"), "a") \
        .groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    big, small = COVER[1], COVER[0]
    kept = chosen.join(covers, ["lang", "phrase"], "left").where(
        F.col("around").isNull()
        | (F.col("around").cast("decimal(38,0)") * big < F.col("a").cast("decimal(38,0)") * small))

    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", F.col("n").cast("long"),
        F.col("score").cast("long"))
