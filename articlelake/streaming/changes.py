"""Incremental ingest with its own state: a manifest per run, the change set against it, touched buckets rewritten.

Layout of a run's state folder::

    {state}/manifest/v={n}/   path, modificationTime, length of every file seen by run n;
                              run n is committed when its _SUCCESS file is there
    {table}/bucket={b}/       parsed documents whose path hashes to bucket b

A run lists the folder once, compares the listing with the last committed
manifest by a join (added, changed: other time or length, removed), opens the
added and changed files by their exact paths, and rewrites only the buckets
that a change touches.  Its manifest is written last.  A run that is stopped
anywhere before that commit leaves the last manifest in force, and the next
run finds the same changes again: every touched bucket is rebuilt from its
old rows without the changed paths plus the new parse, so nothing is lost and
nothing is repeated.  No file name is ever read as a pattern.
"""

from collections.abc import Sequence

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from articlelake.operators.tei import extract_articles
from articlelake.session import settle
from articlelake.sources.xml_files import client_for, list_xml_files, read_files

# Buckets of the table; a run rewrites those its changes touch.  A rebalance
# splits a large bucket among tasks, so the number bounds files, not task size.
BUCKETS = 256
LISTING = ["path", "modificationTime", "length"]


def bucket_of(path, buckets: int = BUCKETS):
    return F.pmod(F.xxhash64(path), F.lit(buckets)).cast("int")


def committed_version(state: str) -> int | None:
    """The number of the last run whose manifest was committed, or None before the first."""
    client, place = client_for(f"{state}/manifest")
    found = client.get_file_info(fs.FileSelector(place, allow_not_found=True))
    versions = [int(info.base_name[2:]) for info in found
                if info.type == fs.FileType.Directory and info.base_name.startswith("v=")]
    return max((v for v in versions
                if client.get_file_info(f"{place}/v={v}/_SUCCESS").type == fs.FileType.File), default=None)


def _exists(path: str) -> bool:
    client, place = client_for(path)
    return client.get_file_info(place).type != fs.FileType.NotFound


def change_set(listing: DataFrame, before: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``path, change, modificationTime, length, bucket`` for each path added, changed or removed.

    ``change`` is ``added``, ``changed`` (time or length differ) or ``removed``;
    time and length are the new ones, null for removed paths.
    """
    new, old = listing.alias("new"), before.alias("old")
    change = (
        F.when(F.col("old.path").isNull(), "added")
        .when(F.col("new.path").isNull(), "removed")
        .when(~F.col("new.modificationTime").eqNullSafe(F.col("old.modificationTime"))
              | ~F.col("new.length").eqNullSafe(F.col("old.length")), "changed")
    )
    path = F.coalesce("new.path", "old.path")
    return (
        new.join(old, F.col("new.path") == F.col("old.path"), "full_outer")
        .select(path.alias("path"), change.alias("change"), "new.modificationTime", "new.length")
        .where(F.col("change").isNotNull())
        .withColumn("bucket", bucket_of("path", buckets))
    )


def ingest_changes(
    spark: SparkSession, directory: str, table: str, state: str,
    fields: Sequence[str] | None = None, buckets: int = BUCKETS,
) -> DataFrame:
    """Bring ``table`` up to date with the article files under ``directory``; return the applied change set.

    After the run ``table`` holds one parsed row per article file now present,
    equal to a parse of the whole folder: new files are added, changed ones
    read again, removed ones dropped.  A change of content that keeps both time
    and length is not seen (as in ``refresh_manifest`` with trusted times).
    ``buckets`` must stay the same for a table.  Driver-side state is a list of
    at most ``buckets`` touched bucket numbers.
    """
    version = committed_version(state)
    listing = settle(list_xml_files(spark, directory).select(*LISTING))  # one listing, used twice
    before = (spark.read.parquet(f"{state}/manifest/v={version}") if version is not None
              else spark.createDataFrame([], listing.schema))
    changes = settle(change_set(listing, before, buckets))

    touched = [row.bucket for row in changes.select("bucket").distinct().collect()]
    if touched:
        wanted = changes.where(F.col("change") != "removed").select(*LISTING)
        parsed = extract_articles(read_files(wanted), fields=fields).withColumn(
            "bucket", bucket_of("file_name", buckets))
        merged = parsed
        if _exists(table):
            gone = changes.select(F.col("path").alias("file_name"))
            old = spark.read.parquet(table).where(F.col("bucket").isin(touched))
            merged = old.join(gone, "file_name", "left_anti").unionByName(parsed)
        merged = settle(merged)  # the old rows are read before their folder is overwritten
        (merged.hint("rebalance", "bucket").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(table))
        filled = {row.bucket for row in merged.select("bucket").distinct().collect()}
        client, place = client_for(table)
        for bucket in set(touched) - filled:  # every row of the bucket is gone: so is its folder
            client.delete_dir_contents(f"{place}/bucket={bucket}", missing_dir_ok=True)
    number = 0 if version is None else version + 1
    listing.write.mode("overwrite").parquet(f"{state}/manifest/v={number}")  # the commit
    return changes


def read_ingested(spark: SparkSession, table: str) -> DataFrame:
    """The table that ``ingest_changes`` keeps, without its bucket column."""
    return spark.read.parquet(table).drop("bucket")
