"""Exact Jaccard join of word n-gram sets, in prefix trees.

Two linked sets differ in few n-grams.  Dealt by hash into more parts than they can differ in, they
have a part in common; each set names the most telling of its parts, and only sets that share such a
name can be linked.  For shares so low that parts would hold next to nothing, sets are put in one
global order of their n-grams, rare ones first, and linked ones share a certain number among the first
few of each.  Sets that meet are gathered into clusters, and each cluster is joined in a prefix tree
that holds the common n-grams first: a walk shares the overlap of equal beginnings among all sets below
and leaves a branch as soon as the lengths that remain cannot give enough overlap.
"""

import zlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from articlelake.llm.common import bound_batches, connected_components
from articlelake.session import settle

# Two sets are linked when NUM / DEN of their union is common, if no other share is asked for: 9 / 10.
NUM, DEN = 9, 10
WORDS = 3
# The global order comes from counts of n-grams by bucket: 2 ** BITS numbers, however large the corpus.
# Any order gives the same links; a finer one only gives fewer candidates.
BITS = 19
_CHUNK = 1 << 12
# n-grams that a cluster joined in one task may hold
CLUSTER = 2_000_000
# from this share on, parts hold several n-grams and candidates come from equal parts
PARTS_FROM = (2, 3)
# how often the blocks of a cluster may copy a set
COPIES = 32
# ids that may be broadcast
SMALL = 500_000
_WORD_MEMO = 150_000
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORD_MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


@lru_cache(maxsize=1)
def _memo() -> _WordHashes:
    return _WordHashes()


def ngrams(text: str | bytes | None, n: int = WORDS) -> np.ndarray:
    """The ``n``-word sequences of the whole text, in order, as 64-bit hashes.

    Words are what stands between ASCII white space; only A-Z are lower-cased.
    A text of fewer than ``n`` words has its whole sequence as its one element,
    a text without words none.
    """
    raw = text.encode("utf-8", "replace") if isinstance(text, str) else text or b""
    words = raw.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    hashes = np.fromiter(map(_memo().__getitem__, words), np.uint64, len(words))
    mixed = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        mixed += hashes[i:len(words) - n + 1 + i] * np.uint64(_MULTIPLIERS[i % 5] + 2 * i)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(_MULTIPLIERS[0])
    mixed ^= mixed >> np.uint64(29)
    return mixed


def ngram_set(text: str | bytes | None, n: int = WORDS) -> np.ndarray:
    """The distinct ones of ``ngrams``, sorted."""
    return np.unique(ngrams(text, n))


def _bucket(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - BITS)).astype(np.int64)


def gram_counts(docs: DataFrame, text: str = "text", n: int = WORDS) -> np.ndarray:
    """For each of ``2 ** BITS`` buckets, how many n-grams of all texts fall into it.

    Tasks add up their own rows; what is shuffled and what reaches the driver
    is a fixed number of buckets, not n-grams.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            found = [ngrams(value.as_py(), n) for value in batch.column(0)]
            total += np.bincount(_bucket(np.concatenate([*found, np.zeros(0, np.uint64)])), minlength=1 << BITS)
        parts = total.reshape(-1, _CHUNK)
        used = np.flatnonzero(parts.any(axis=1))
        packed = [zlib.compress(parts[i].tobytes(), 1) for i in used]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(packed, pa.binary())], ["part", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(value.as_py()), np.int64) for value in table["counts"])
        return pa.table({"part": table["part"][:1], "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    schema = "part long, counts binary"
    parts = docs.select(F.col(text).cast("binary")).mapInArrow(count, schema)
    summed = parts.groupBy("part").applyInArrow(add, schema).collect()  # 2 ** BITS numbers at most
    counts = np.zeros((1 << BITS) // _CHUNK * _CHUNK, np.int64).reshape(-1, _CHUNK)
    for row in summed:
        counts[row.part] = np.frombuffer(zlib.decompress(row.counts), np.int64)
    return counts.reshape(-1)


def _ordered(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return grams[np.lexsort((grams, counts[_bucket(grams)]))]


def prefix_length(size: int, num: int = NUM, den: int = DEN) -> int:
    """How many first elements of a set are looked at.

    Linked sets of sizes a and b have at least ``num / den`` of the larger one in
    common; so of the first ``a - overlap + m`` and ``b - overlap + m`` elements
    in one order, they share m at least.  Here m is a twentieth of the set.
    """
    return min(size, size - -(-num * size // den) + size // 20 + 1)


def shared_at_least(size: int | Column, num: int = NUM, den: int = DEN) -> int | Column:
    """How many of its first elements a set shares with any set that it is linked with, which may be
    as small as ``num / den`` of it."""
    if isinstance(size, Column):
        return F.floor(size * num / (20 * den)) + 1
    return size * num // (20 * den) + 1


@lru_cache(maxsize=1)
def _class_starts() -> list[int]:
    """The smallest size of each class of sizes: a class ends a third above its start."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, starts[-1] * 4 // 3))
    return starts


def _class_of(size: int) -> int:
    return bisect_right(_class_starts(), size) - 1


def telling(counts: np.ndarray) -> np.ndarray:
    """How much an n-gram of each bucket tells, in sixteenths of a bit, from ``gram_counts``."""
    return np.rint(16 * (np.log2(counts.sum() + 1) - np.log2(counts + 1)) + 1)


def signatures(grams: np.ndarray, tells: np.ndarray, num: int = NUM, den: int = DEN) -> np.ndarray:
    """Names of parts of a set; any set that it is linked with shares one of them.

    Linked sets of sizes a <= b differ in at most ``a * (den - num) / num``
    n-grams, say d.  They meet in the class of the smaller one, where n-grams are
    dealt by hash into ``d + 1 + spare`` parts, so at least ``1 + spare`` parts
    are equal.  Each set names the ``d + 1`` parts that tell most (whole numbers,
    ties by the number of the part): what a part tells depends on its n-grams
    only, so of the equal parts the most telling one is named by both sets.
    """
    size, found = len(grams), [np.zeros(0, np.uint64)]
    weights = tells[_bucket(grams)]
    for at in range(_class_of(-(-num * size // den)), _class_of(size) + 1) if size else ():
        largest = _class_starts()[at + 1] - 1
        named = largest * (den - num) // num + 1
        parts = named + named // 2
        dealt = (grams % np.uint64(parts)).astype(np.intp)
        sums = np.zeros(parts, np.uint64)
        np.add.at(sums, dealt, grams)
        told = np.bincount(dealt, weights, parts)
        chosen = np.argsort(told, kind="stable")[parts - named:].astype(np.uint64)
        salt = np.uint64((at + 1) * _MULTIPLIERS[2] % (1 << 64))
        name = sums[chosen] + (chosen + np.uint64(1)) * np.uint64(_MULTIPLIERS[1]) + salt
        name ^= name >> np.uint64(31)
        found.append(name * np.uint64(_MULTIPLIERS[0]))
    return np.concatenate(found)


def _needed(a: int, b: int, num: int = NUM, den: int = DEN) -> int:
    """Smallest overlap of linked sets of these sizes."""
    return -(-num * (a + b) // (num + den))


def _sets(docs: DataFrame, n: int, make, kind: str) -> DataFrame:
    """``doc_id, n_shingles, set_key, grams`` of each row, ``grams`` made by ``make`` of the set and of whether
    it is the first such set with an id in its batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, grams, seen = [], [], [], set()
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = ngram_set(value.as_py(), n)
                key = xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63) if len(found) else None
                sizes.append(len(found))
                keys.append(key)
                grams.append(make(found, doc_id is not None and key not in seen))
                if doc_id is not None:
                    seen.add(key)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()),
                 pa.array(grams, pa.binary() if kind == "binary" else pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_key", "grams"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(run, f"doc_id long, n_shingles long, set_key long, grams {kind}")


def _whole_sets(docs: DataFrame, counts, n: int) -> DataFrame:
    """Whole sets in the global order, as bytes."""
    return _sets(docs, n, lambda found, first: _ordered(found, counts.value).tobytes(), "binary")


def _first_grams(docs: DataFrame, counts, n: int, num: int, den: int) -> DataFrame:
    """The first n-grams of each set in the global order."""
    def make(found: np.ndarray, first: bool) -> np.ndarray:
        return _ordered(found, counts.value)[:prefix_length(len(found), num, den)].view(np.int64) if len(found) else found.view(np.int64)

    return _sets(docs, n, make, "array<long>")


def _named_parts(docs: DataFrame, tells, n: int, num: int, den: int) -> DataFrame:
    """The signatures of each set; of copies in one batch, one has them."""
    def make(found: np.ndarray, first: bool) -> np.ndarray:
        return (signatures(found, tells.value, num, den) if first else found[:0]).view(np.int64)

    return _sets(docs, n, make, "array<long>")


# --- the join of one cluster -------------------------------------------------

class _Node:
    """An edge of the tree and what lies below it."""

    __slots__ = ("grams", "children", "ends", "least", "most")

    def __init__(self, grams: list[int], least: int, most: int):
        self.grams, self.children, self.ends = grams, {}, []
        self.least, self.most = least, most


def _insert(root: _Node, grams: list[int], row: int) -> None:
    size, at, node = len(grams), 0, root
    while True:
        node.least, node.most = min(node.least, size), max(node.most, size)
        if at == size:
            node.ends.append(row)
            return
        child = node.children.get(grams[at])
        if child is None:
            leaf = _Node(grams[at:], size, size)
            leaf.ends.append(row)
            node.children[grams[at]] = leaf
            return
        edge, same = child.grams, 0
        limit = min(len(edge), size - at)
        while same < limit and edge[same] == grams[at + same]:
            same += 1
        if same < len(edge):  # split the edge where the two part
            upper = _Node(edge[:same], child.least, child.most)
            child.grams = edge[same:]
            upper.children[child.grams[0]] = child
            node.children[grams[at]] = upper
            child = upper
        at += same
        node = child


class _Sets:
    """Union-find over the rows of a cluster."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, row: int) -> int:
        parent = self.parent
        while parent[row] != row:
            parent[row] = parent[parent[row]]
            row = parent[row]
        return row


def tree_links(sets: Sequence[np.ndarray], sides: Sequence[int] | None = None, num: int = NUM,
               den: int = DEN) -> list[tuple[int, int]]:
    """Links that connect exactly the rows which a chain of linked pairs connects.

    ``sets`` are in the global order; ``num / den`` of the union of a linked pair is common.  A pair that is known to be connected
    already is not looked at again, so the links are a forest.  With ``sides``,
    pairs of one side are left to others.
    """
    order = sorted(range(len(sets)), key=lambda row: (len(sets[row]), row))
    joined, links = _Sets(len(sets)), []
    roots = {side: _Node([], 1 << 60, 0) for side in set(sides or [0])}
    apart = 0  # components among the rows seen
    leaders: list[tuple[int, set[int]]] = []
    for row in order:
        grams = sets[row][::-1].tolist()  # common first
        own, size = set(grams), len(grams)
        least = -(-num * size // den)
        apart += 1
        if sides is None:
            for leader, other in leaders:
                if len(other) >= least and joined.find(leader) != joined.find(row) \
                        and len(own & other) >= _needed(size, len(other), num, den):
                    joined.parent[joined.find(row)] = joined.find(leader)
                    links.append((leader, row))
                    apart -= 1
        if apart > 1:
            for side, root in roots.items():
                if sides is None or side != sides[row]:
                    apart -= _walk(root, own, size, least, row, joined, links, num, den)
        _insert(roots[sides[row] if sides else 0], grams, row)
        if len(leaders) < 4 or row % 64 == 0:
            leaders = [*leaders[-3:], (row, own)]
    return links


def _walk(root, own, size, least, row, joined, links, num, den) -> int:
    found, stack = 0, [(root, 0, 0)]
    while stack:
        node, overlap, depth = stack.pop()
        if node.most < least:
            continue
        smallest = node.least if node.least > least else least
        needed = _needed(size, smallest, num, den)
        rest = node.most - depth
        if overlap + (rest if rest < size - overlap else size - overlap) < needed:
            continue
        if node.grams:
            overlap += len(own.intersection(node.grams))
            depth += len(node.grams)
            rest = node.most - depth
            if overlap + (rest if rest < size - overlap else size - overlap) < needed:
                continue
        if node.ends and depth >= least and overlap >= _needed(size, depth, num, den):
            for other in node.ends:
                a, b = joined.find(other), joined.find(row)
                if a != b:
                    joined.parent[b] = a
                    links.append((other, row))
                    found += 1
        for child in node.children.values():
            stack.append((child, overlap, depth))
    return found


def _join_cluster(table: pa.Table, num: int, den: int) -> pa.Table:
    nodes = table["node"].to_pylist()
    sets = [np.frombuffer(value.as_py(), np.uint64) for value in table["grams"]]
    first, second = table["i"][0].as_py(), table["j"][0].as_py()
    sides = None if first == second else [int(value.as_py() != first) for value in table["block"]]
    links = tree_links(sets, sides, num, den) if len(sets) > 1 else []
    return pa.table({"a": pa.array([nodes[a] for a, _ in links], pa.int64()),
                     "b": pa.array([nodes[b] for _, b in links], pa.int64())})


# --- the whole job -----------------------------------------------------------

def _clusters(postings: DataFrame, classes: DataFrame) -> DataFrame:
    """``cluster, kind, i, j, block, set_key, node`` from ``(gram, set_key)``: who meets whom.

    All sets that share n-grams, or names of parts, form a cluster.  One that is too
    large for a task is cut into blocks of which every two meet.  Where that
    would copy each set more than ``COPIES`` times, the sets of each n-gram meet
    instead, in blocks if need be.
    """
    # the smallest key of each n-gram, found where the sorted rows are: one shuffle of the postings
    smallest = F.first("set_key").over(
        Window.partitionBy("gram").orderBy("set_key").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    linked = postings.select(F.col("set_key").alias("a"), smallest.alias("b")).where("a <> b")
    near = connected_components(linked).select(F.col("node").alias("set_key"), F.col("component").alias("near"))
    sets = settle(classes.join(near, "set_key"))
    load = settle(_blocks(sets, "near"))
    cut = sets.join(load.where(F.col("blocks") <= COPIES), "near").select(
        F.col("near").alias("cluster"), F.lit(0).alias("kind"), "blocks", "set_key", "node")
    large = load.where(F.col("blocks") > COPIES).select("near")
    if not large.isEmpty():
        members = settle(postings.join(sets.join(large, "near", "left_semi"), "set_key").select(
            "gram", "set_key", "node", "n_shingles").distinct())
        # of n-grams with the same sets, one is enough
        by_gram = members.join(_one_of_each(members), "gram")
        cut = cut.union(by_gram.join(_blocks(by_gram, "gram"), "gram").select(
            F.col("gram").alias("cluster"), F.lit(1).alias("kind"), "blocks", "set_key", "node"))
    met = cut.withColumn("block", F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.select(
        "cluster", "kind", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block",
        "set_key", "node")


def _one_of_each(members: DataFrame) -> DataFrame:
    """One ``gram`` of all that have the same two or more sets."""
    mark = F.xxhash64("set_key", F.lit(7))
    distinct = members.groupBy("gram").agg(
        F.count("*").alias("sets"), F.bit_xor(mark).alias("x"), F.bit_xor(F.xxhash64(mark, F.lit(11))).alias("y"))
    return distinct.where("sets > 1").groupBy("sets", "x", "y").agg(F.min("gram").alias("gram")).select("gram")


def _blocks(sets: DataFrame, by: str) -> DataFrame:
    """Into how many blocks the sets of a group are cut, so that a task can hold any two."""
    load = F.sum("n_shingles")
    return sets.groupBy(by).agg(
        F.when(load <= CLUSTER, 1).otherwise(F.ceil(2 * load / CLUSTER)).cast("int").alias("blocks"))


def _with_enough(postings: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """``gram, set_key, node, n_shingles`` of the sets that have enough of these n-grams to be linked."""
    enough = (
        postings.groupBy("set_key").agg(F.count("*").alias("has")).join(classes, "set_key")
        .where(F.col("has") >= shared_at_least(F.col("n_shingles"), num, den)).select("set_key", "node", "n_shingles")
    )
    return postings.join(enough, "set_key").select("gram", "set_key", "node", "n_shingles")


def _with_partners(postings: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """``gram, set_key`` of first n-grams that several sets have, and of the sets that have enough of them; copies
    of a set still count at first, and fall away with the next round."""
    shared = postings.groupBy("gram").agg(F.count("*").alias("rows")).where("rows > 1").select("gram")
    members = settle(_with_enough(postings.join(shared, "gram").distinct(), classes, num, den))
    for _ in range(2):  # sets that went may have taken the only partners of others along
        again = members.groupBy("gram").count().where("count > 1").select("gram")
        members = settle(_with_enough(members.join(again, "gram").select("set_key", "gram"), classes, num, den))
    return settle(members.join(_one_of_each(members), "gram").select("gram", "set_key"))


def similar_documents(docs: DataFrame, n: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs`` (``doc_id, text`` and any other columns).

    Rows are linked when ``num / den`` of their ``n``-word sequences are common,
    a tenth at least.  ``component_id`` is the smallest id that links reach.  Equal sets are one
    class, joined once.  Rows without words link with nothing; rows without id
    link with nothing and have no component; repeated rows come out repeated.
    """
    if not 0 < num <= den <= 10 * num:
        raise ValueError(f"a share from 1/10 to 1 is needed, not {num}/{den}")
    spark: SparkSession = docs.sparkSession
    bound_batches(spark)
    docs = docs.select("doc_id", "text")
    counts = spark.sparkContext.broadcast(gram_counts(docs, n=n))
    by_parts = num * PARTS_FROM[1] >= den * PARTS_FROM[0]
    if by_parts:
        tells = spark.sparkContext.broadcast(telling(counts.value))
        sets = settle(_named_parts(docs, tells, n, num, den))
    else:
        sets = settle(_first_grams(docs, counts, n, num, den))
    known = sets.where("doc_id is not null and set_key is not null")
    classes = settle(known.groupBy("set_key").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles")))
    postings = known.select("set_key", F.explode("grams").alias("gram"))
    if not by_parts:
        postings = _with_partners(postings, classes, num, den)
    clusters = settle(_clusters(postings, classes))

    wanted = settle(clusters.select(F.col("node").alias("doc_id")).distinct())
    if wanted.count() <= SMALL:  # a checked size; beyond it, the join decides
        wanted = F.broadcast(wanted)
    texts = docs.where("doc_id is not null").join(wanted, "doc_id", "left_semi")
    full = _whole_sets(texts, counts, n).select("set_key", "grams").dropDuplicates(["set_key"])
    gathered = clusters.join(full, "set_key").select("cluster", "kind", "i", "j", "block", "node", "grams")
    links = gathered.groupBy("cluster", "kind", "i", "j").applyInArrow(
        lambda table: _join_cluster(table, num, den), "a long, b long")

    components = connected_components(links)
    named = settle(classes.join(components, "node", "left").select(
        "set_key", F.coalesce("component", "node").alias("component_id")))
    joined = sets.drop("grams").join(named, "set_key", "left")
    return joined.select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
