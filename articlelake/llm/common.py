"""What the operators of this package share: table access, folds, settled tables, connected components."""

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from articlelake.session import settle

# Arrow batches to Python workers are bounded by bytes, whatever the session says: documents are wide.
BATCH_BYTES = 4 * 1024 ** 2
MAX_ROUNDS = 60


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def bound(value: Column, use) -> Column:
    """``use`` applied to a value that is computed once, also where ``use`` loops over it."""
    return F.transform(F.array(value), use)[0]


def fold(doc_id: str = "doc_id") -> Column:
    """Quarter of a document: crc32 of its id as text, modulo 4.  Quarter 2 is held out of training."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def held_out(doc_id: str = "doc_id") -> Column:
    """A document without id belongs to no quarter and is not held out."""
    return F.coalesce(fold(doc_id) == 2, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int,
) -> tuple[list[tuple[str, int]], float]:
    """At most ``per_class`` training texts of each class, as (text, label), in a fixed order; and the
    share of label 1 among all labelled ids, smoothed.

    Rows of the held-out quarter, rows without a label of 0 or 1, and empty
    texts are left out; of an id with several labels the larger counts.  Ids
    are taken in the order of a hash, so the sample is the same on every run.
    Texts longer than ``max_chars`` do not serve as examples.  The sampled ids
    (``2 * per_class`` rows at most) are broadcast, so no text is shuffled.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max(label).alias("_label"))
    )
    n, ones = known.agg(F.count("*"), F.coalesce(F.sum("_label"), F.lit(0))).first()
    order = F.xxhash64("doc_id")
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("_label") == value).orderBy(order, "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.where((F.length("text") > 0) & (F.length("text") <= max_chars)).select("doc_id", "text")
    sample = texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    rows = sample.select("doc_id", "text", "_label").collect()  # bounded by per_class and max_chars
    examples = [(row.text, row._label) for row in sorted(rows, key=lambda row: (row.doc_id, row.text))]
    return examples, (ones + 1) / (n + 2)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a weighted logistic line, by Newton steps with a weak pull to 0."""
    scale = x.std() or 1.0
    z = np.stack([x / scale, np.ones_like(x)], 1)
    w = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (weight * (p - y)) + 1e-2 * w
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2), gradient)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``(a, b)``; the component is its smallest node.

    Alternates two steps that keep the components and pull every node towards the
    smallest one it knows, until all links are ``(node, smallest)``.  A step is an
    aggregate that combines before its shuffle and a join whose hot side adaptive
    execution can split; the links never outnumber those given.  Each round is a
    table in the shared folder, so a lost executor costs one round at most.
    """
    pairs = settle(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = None
    for _ in range(MAX_ROUNDS):
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        # each node tells its larger neighbours the smallest node it knows
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct()
        )
        large = settle(large)
        # each node and its smaller neighbours link to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        pairs = settle(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .union(least.select("u", F.col("m").alias("v"))).distinct()
        )
    else:
        raise RuntimeError(f"components still changed after {MAX_ROUNDS} rounds")
    members = pairs.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.union(roots)
