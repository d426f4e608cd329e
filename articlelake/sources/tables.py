"""Stored tables: typed reads, CSV exchange, optional inputs and reusable stages."""

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articlelake.session import local_table, settle


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with quoted line breaks. JSON text fills array and struct columns."""
    def complex_type(kind):
        return isinstance(kind, (T.ArrayType, T.StructType, T.MapType))

    on_disk = T.StructType(
        [T.StructField(f.name, T.StringType() if complex_type(f.dataType) else f.dataType)
         for f in schema]
    )
    rows = (
        spark.read.schema(on_disk)
        .options(header=True, multiLine=True, escape='"', enforceSchema=False)
        .csv(path)
    )
    return rows.select(
        *[F.from_json(f.name, f.dataType).alias(f.name) if complex_type(f.dataType) else F.col(f.name)
          for f in schema]
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV, overwritten; array and struct columns as JSON text.

    Null and empty text are told apart by quotes in the file, but read back as null alike.
    """
    flat = df.select(
        *[F.to_json(f.name).alias(f.name)
          if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(f.name)
          for f in df.schema]
    )
    flat.write.mode("overwrite").options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def read_optional(spark: SparkSession, path: str | None, schema: T.StructType) -> DataFrame:
    """The Parquet table at ``path``, or an empty table of the same type."""
    if path and path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return local_table(spark, schema)


def read_optional_csv(spark: SparkSession, path: str | None, schema: T.StructType) -> DataFrame:
    if path and path_exists(spark, path):
        return read_csv(spark, path, schema)
    return local_table(spark, schema)


def stage_is_finished(spark: SparkSession, path: str) -> bool:
    """A job that died half-way left no ``_SUCCESS`` marker."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def input_fingerprint(spark: SparkSession, inputs: Sequence[str], params: Mapping[str, object]) -> str:
    """A digest of the files under ``inputs`` (path, length, time) and of ``params``.

    The files are listed and hashed on the executors, without being opened; one
    row of count and hash sum per input comes to the driver.
    """
    parts = [json.dumps(sorted((str(k), repr(v)) for k, v in params.items()))]
    for place in inputs:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(place)
                 .select("path", "length", "modificationTime"))
        count, total = files.agg(F.count("*"), F.sum(F.xxhash64("path", "length", "modificationTime")
                                                     .cast("decimal(38,0)"))).first()
        parts.append(f"{place}={count}:{total}")
    return hashlib.sha256("|".join(parts).encode()).hexdigest()[:32]


def _touch(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop_path, True).close()


def stage(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], rebuild: bool = False,
    inputs: Sequence[str] = (), params: Mapping[str, object] | None = None,
) -> DataFrame:
    """The stored result at ``path``; built and written when absent, unfinished, stale or asked for.

    With ``inputs`` (paths of files or folders the build reads) or ``params``,
    the stage keeps a fingerprint of both beside its files; a stage whose
    fingerprint differs from the present one is stale and built again.  The
    fingerprint is written after the table, so a build cut short is built again.
    """
    mark = None
    if inputs or params:
        mark = f"{path.rstrip('/')}/_FINGERPRINT_{input_fingerprint(spark, inputs, params or {})}"
    if not rebuild and stage_is_finished(spark, path) and (mark is None or path_exists(spark, mark)):
        return spark.read.parquet(path)
    built = settle(build(), path)
    if mark:
        _touch(spark, mark)
    return built
