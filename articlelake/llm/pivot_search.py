"""Exact top-k search by inner product, with pivots that rule candidates out.

A candidate's distances to some pivots are kept with it.  The triangle inequality turns them into
a lower bound of its distance to a query, and with both lengths into an upper bound of their inner
product.  Candidates are evaluated in the order of that bound, until it falls below the k-th best.
"""

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from articlelake.llm.common import bound_batches
from articlelake.session import settle

PIVOTS = 32
# Pivots are chosen from this many vectors, by a hash; any choice gives the same answers.
PIVOT_SAMPLE = 2000
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 16_384
STEP = 256  # candidates evaluated between two looks at the bound


def whole_numbers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, q``: each component x as floor(scale * x).

    Vectors that are null, empty or hold null or non-finite components, and
    rows without id, take no part.  Rows that repeat both id and vector count once.
    A component whose whole number lies beyond a long (``|scale x| >= 2 ** 63``)
    cannot be held: its vector takes no part either.
    """
    wide = F.col("embedding").cast("array<double>")
    known = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), wide.alias("x")).where(
        "vec_id is not null and x is not null and size(x) > 0 and forall(x, v -> v is not null and v - v = 0"
        f" and abs(v * {float(scale)}) < {float(2 ** 63)})")
    return known.select("vec_id", F.transform("x", lambda v: F.floor(v * F.lit(float(scale))).cast("long")).alias("q")).distinct()


def _pivots(vectors: DataFrame, pivots: int) -> np.ndarray:
    """Vectors of a bounded sample, each as far as possible from those before it."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").select("q").limit(PIVOT_SAMPLE).collect()
    size = min((len(row.q) for row in rows), default=0)
    sample = np.array([row.q for row in rows if len(row.q) == size], float).reshape(-1, max(1, size))
    if not len(sample):
        return sample
    chosen = [0]
    far = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(pivots, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.stack([np.frombuffer(value.as_py(), np.int64) for value in column])


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    if vectors.shape[1] != pivots.shape[1]:
        return np.zeros((len(vectors), 1))  # another dimension: no bound from pivots
    square = (vectors.astype(float) ** 2).sum(1)[:, None] + (pivots ** 2).sum(1) - 2 * vectors @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def with_distances(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vec_id, size, q, far``: vector and pivot distances as bytes."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)  # PIVOTS vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = [np.array(value.as_py(), np.int64) for value in batch.column(1)]
            far = [_distances(q[None].astype(float), shared.value)[0] for q in arrays]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(q) for q in arrays], pa.int32()),
                 pa.array([q.tobytes() for q in arrays], pa.binary()),
                 pa.array([f.tobytes() for f in far], pa.binary())], ["vec_id", "size", "q", "far"])

    return vectors.select("vec_id", "q").mapInArrow(run, "vec_id long, size int, q binary, far binary")


def exact_products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of int64 rows with an int64 query as whole numbers: int64 where no sum can overflow,
    else Python integers."""
    if not len(rows):
        return np.zeros(0, np.int64)
    largest = float(np.abs(rows).max()) * float(np.abs(query).max()) * rows.shape[1]
    if largest < 2 ** 62:
        return rows @ query
    return np.array([sum(int(a) * int(b) for a, b in zip(row, query)) for row in rows], dtype=object)


def search_block(query_ids, queries, query_far, ids, vectors, far, k: int) -> list[tuple[int, int, int]]:
    """``(query, candidate, score)``: the best ``k`` of these candidates for each query, ties to smaller ids.

    Bounds are floating point with a margin for rounding; scores are exact whole numbers.
    """
    order = np.argsort(ids, kind="stable")
    ids, vectors, far = ids[order], vectors[order], far[order]
    exact = vectors.astype(np.float64)
    lengths, query_lengths = (exact ** 2).sum(1), (queries.astype(np.float64) ** 2).sum(1)
    made = []
    for at, query in enumerate(queries):
        nearest = np.zeros(len(ids))
        for pivot in range(far.shape[1]):
            np.maximum(nearest, np.abs(far[:, pivot] - query_far[at, pivot]), out=nearest)
        bound = (lengths + query_lengths[at] - nearest ** 2) / 2
        bound += 1e-9 * (lengths + query_lengths[at]) + 1e-6  # what rounding may have taken
        bound[ids == query_ids[at]] = -np.inf
        ahead = np.argsort(-bound, kind="stable")
        scores, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for start in range(0, len(ahead), STEP):
            rows = ahead[start:start + STEP]
            if len(scores) >= k and bound[rows[0]] < float(scores[k - 1]):
                break
            rows = rows[bound[rows] > -np.inf]
            made_here = exact_products(vectors[rows], query)
            scores = np.concatenate([scores.astype(object) if made_here.dtype == object else scores,
                                     made_here.astype(object) if scores.dtype == object else made_here])
            found = np.concatenate([found, ids[rows]])
            best = sorted(range(len(found)), key=lambda i: (-scores[i], found[i]))[:k] \
                if scores.dtype == object else np.lexsort((found, -scores))[:k]
            scores, found = scores[best], found[best]
        made += [(int(query_ids[at]), int(i), int(s)) for i, s in zip(found, scores, strict=True)]
    return made


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, pivots: int = PIVOTS) -> DataFrame:
    """``query_id, rank, vec_id, score, score_exact``: the ``k`` rows of ``vectors`` with the highest inner products.

    Scores are exact whole numbers: ``score`` where it fits a long, else null;
    ``score_exact`` always (a decimal, held within 38 digits).

    Both tables hold ``vec_id, q`` (see ``whole_numbers``).  A query's own id is
    no candidate; ties go to the smaller id; with fewer candidates all are
    returned.  Only vectors of the query's size are compared.  Blocks of
    queries meet blocks of candidates, both cut by a hash of the id, so no task
    holds more than one of each.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    chosen = _pivots(vectors, pivots)
    wide = settle(with_distances(vectors, chosen))
    asked = settle(with_distances(queries, chosen))
    left = max(1, -(-asked.count() // QUERY_BLOCK))
    right = max(1, -(-wide.count() // CANDIDATE_BLOCK))
    ask = asked.withColumn("i", F.pmod(F.xxhash64("vec_id"), F.lit(left)).cast("int")).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.lit(right - 1))))
    hold = wide.withColumn("j", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(right)).cast("int")).withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.lit(left - 1))))

    def meet(asking: pa.Table, holding: pa.Table) -> pa.Table:
        made = []
        if asking.num_rows and holding.num_rows:
            parts = []
            for table in (asking, holding):
                parts.append((table["vec_id"].to_numpy(), _matrix(table["q"]), np.stack(
                    [np.frombuffer(value.as_py()) for value in table["far"]])))
            made = search_block(*parts[0], *parts[1], k)
        columns = list(zip(*made, strict=True)) if made else [[], [], []]
        # scores travel as exact decimals, within 38 digits
        edge = 10 ** 38 - 1
        exact = [Decimal(max(-edge, min(edge, s))) for s in columns[2]]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()),
                         "score": pa.array(exact, pa.decimal128(38, 0))})

    keys = ["i", "j", "size"]
    best = ask.groupBy(*keys).cogroup(hold.groupBy(*keys)).applyInArrow(
        meet, "query_id long, vec_id long, score decimal(38,0)")
    # a rank limit, which Spark also applies before the shuffle; the order is by the exact score
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    in_long = F.col("score").between(F.lit(-(2 ** 63)).cast("decimal(38,0)"), F.lit(2 ** 63 - 1).cast("decimal(38,0)"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", F.when(in_long, F.col("score").cast("long")).alias("score"),
        F.col("score").alias("score_exact"))
