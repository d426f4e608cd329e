"""Session settings and the shared folder that durable intermediate tables go to."""

import re
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Settings this library relies on; a cluster's own values for sizes win.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a join may use a hash table when its small side fits in memory in every partition
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # documents are wide: Arrow batches for Python are bounded by bytes, not only by rows
    "spark.sql.execution.arrow.maxBytesPerBatch": "64MB",
}


def _bytes(text: str) -> int:
    """A size setting as Spark writes it: a number with k, m, g or t, and b, or neither."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgt]?)b?", text.strip().lower()).groups()
    return int(number) * 1024 ** " kmgt".index(unit or " ")


# Shuffle partitions of this size fit in memory beside their neighbours; smaller ones are merged.
SHUFFLE_PARTITION_BYTES = 256 * 1024 ** 2


def session(
    app_name: str = "articlelake", corpus_bytes: int | None = None, **settings: str
) -> SparkSession:
    """A session with the recommended settings.

    ``corpus_bytes``, the size of the largest table that will be shuffled, sets the
    number of shuffle partitions: adaptive execution merges partitions that turn
    out small, but only a skewed join splits those that turn out large.
    """
    if corpus_bytes is not None:
        partitions = max(200, -(-corpus_bytes // SHUFFLE_PARTITION_BYTES))
        settings = {"spark.sql.shuffle.partitions": str(partitions), **settings}
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_table(
    spark: SparkSession, schema: T.StructType, rows: Sequence[Sequence] = ()
) -> DataFrame:
    """A few given rows, or none, as a table whose size the optimizer knows."""
    records = [dict(zip(schema.names, row, strict=True)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, to_arrow_schema(schema)), schema)


def shared_folder(spark: SparkSession) -> str:
    """A new path in the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then takes a folder
    in the warehouse, which is shared as well, never a machine-local temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_articlelake_checkpoints"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/articlelake/{uuid.uuid4().hex}"


def settle(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back.

    The written table survives lost executors, cuts the lineage, and has a size
    the optimizer knows: it broadcasts the table in a join when, and only when,
    its files are below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = path or shared_folder(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Batches of documents to parse: a parse takes several times the memory of what it reads, in each Python worker.
DOCUMENT_BATCH = "4MB"


def bound_batches(spark: SparkSession, limit: str | None = None) -> None:
    """Arrow batches to Python are bounded by bytes in any session, not only in one made by ``session``."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    limit = limit or RECOMMENDED[key]
    now = _bytes(spark.conf.get(key))  # a known setting: a given default would be validated, and "0" is refused
    if not 0 < now <= _bytes(limit):
        spark.conf.set(key, limit)


# What opening a small file costs, in bytes that are parsed in the same time (about 0.3 ms).
OPEN_COST = "16KB"


def pack_small_files(spark: SparkSession) -> None:
    """Tasks get article files by their bytes.

    Spark counts each file as 4 MB more than it holds, which is a task for every
    few article files; millions of them are then mostly the start of tasks.
    """
    key = "spark.sql.files.openCostInBytes"
    if _bytes(spark.conf.get(key)) > _bytes(OPEN_COST):
        spark.conf.set(key, OPEN_COST)


def require_utc(spark: SparkSession) -> None:
    """Dates are read in the session's time zone; the tables of this library are in UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone is {zone!r}; set it to UTC")
