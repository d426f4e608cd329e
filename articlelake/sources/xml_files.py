"""Recursive scan of article files."""

import os
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from articlelake import fixed_values as fixed
from articlelake.schemas import BINARY_FILE, FOUND
from articlelake.session import bound_batches, local_table, pack_small_files, settle, shared_folder

# files that one task reads
READ_BYTES = 64 * 1024 ** 2
# what opening a file counts when they are dealt out, as ``session.OPEN_COST``
OPEN_BYTES = 16 * 1024
# entries that a task lists before it leaves the other folders to the next round
LISTED = 50_000
# entries that go on in one batch
SEND_ENTRIES = 10_000
# contents that go on in one batch
SEND_BYTES = 4 * 1024 ** 2


def is_article_file(name: Column) -> Column:
    """Does this base name belong to an article? Case-sensitive; directories do not count."""
    keep = name.endswith(fixed.FILE_SUFFIX) & ~name.contains(fixed.EXCLUDED_NAME_CHARACTER)
    for part in fixed.EXCLUDED_NAME_PARTS:
        keep &= ~name.contains(part)
    for start in fixed.EXCLUDED_NAME_STARTS:
        keep &= ~name.startswith(start)
    return keep


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def _binary(reader):
    return (
        reader.format("binaryFile")
        .schema(BINARY_FILE)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*" + fixed.FILE_SUFFIX)
    )


def _scan_by_spark(spark: SparkSession, directories: tuple[str, ...]) -> DataFrame:
    """The scan with the listing of Spark, which the driver holds."""
    pack_small_files(spark)
    files = _binary(spark.read).load(list(directories))
    return files.where(is_article_file(F.col("_metadata.file_name")))


def _root(spark: SparkSession, directory: str) -> str | None:
    """The whole path of a folder that tasks can list; None for patterns, single files, missing paths and other stores."""
    if set(directory) & set("{}[]*?\\"):
        return None
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    try:
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not store.getFileStatus(path).isDirectory():
            return None
        root = store.makeQualified(path).toString()
        client, place = client_for(root)
        return root if client.get_file_info(place).type == fs.FileType.Directory else None
    except (Py4JJavaError, pa.ArrowException, OSError):  # Spark's reader says what is wrong, or can read it
        return None


def _hidden(name: str) -> bool:
    """Names that Spark's listing leaves out."""
    hidden = name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_")
    return hidden and not name.startswith(("_common_metadata", "_metadata"))


def _entries(folder: str) -> Iterator[tuple[str, int | None, int | None]]:
    """Name, time (ms) and length of each file of a folder that may be an article; folders have no length.

    A folder of local files is read entry by entry, however many it has.
    """
    client, place = client_for(folder)
    if not isinstance(client, fs.LocalFileSystem):
        for info in client.get_file_info(fs.FileSelector(place, allow_not_found=True)):
            if info.type == fs.FileType.Directory:
                yield info.base_name, None, None
            elif info.base_name.endswith(fixed.FILE_SUFFIX):
                yield info.base_name, (info.mtime_ns or 0) // 1_000_000, info.size or 0
        return
    try:
        found = os.scandir(place)
    except FileNotFoundError:
        return
    with found:
        for entry in found:
            try:
                entry.name.encode()
                if entry.is_dir():
                    yield entry.name, None, None
                elif entry.name.endswith(fixed.FILE_SUFFIX):
                    info = entry.stat()
                    yield entry.name, info.st_mtime_ns // 1_000_000, info.st_size
            except (OSError, UnicodeEncodeError):  # a broken link, a file that is gone, a name that is no text
                continue


def _walk(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The files below the folders ``path``; folders left after ``most`` entries go on without length."""
    def sent():
        kinds = pa.string(), pa.string(), pa.int64(), pa.int64()
        columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=FOUND.names)

    rows, listed = [], 0
    for batch in batches:
        folders = batch.column("path").to_pylist()
        while folders:
            folder = folders.pop()
            if listed >= most:
                rows.append((folder, "", None, None))
                continue
            for name, time, length in _entries(folder):
                listed += 1
                path = f"{folder.rstrip('/')}/{name}"
                if _hidden(name):
                    continue
                if length is None:
                    folders.append(path)
                elif length:  # Spark's scan leaves empty files out
                    rows.append((path, name, time, length))
                if len(rows) >= SEND_ENTRIES:
                    yield sent()
                    rows = []
    if rows:
        yield sent()


def _article_listing(spark: SparkSession, roots: list[str]) -> DataFrame:
    """``path, modificationTime, length`` of the article files below ``roots``, listed by tasks.

    Each round lists the folders that the one before left over; the driver
    holds their number only.
    """
    bound_batches(spark)
    at, rounds, most = shared_folder(spark), [], LISTED
    folders, left = local_table(spark, FOUND, [(root, "", None, None) for root in dict.fromkeys(roots)]), len(roots)
    while left:
        rounds.append(f"{at}/{len(rounds)}")
        dealt = folders.select("path").repartition(min(left, 4 * spark.sparkContext.defaultParallelism))
        folders = settle(dealt.mapInArrow(lambda batches: _walk(batches, most), FOUND), rounds[-1]).where("length is null")
        left = folders.count()
    found = spark.read.schema(FOUND).parquet(*rounds).where("length is not null")
    if len(roots) > 1:  # one may lie in another
        found = found.dropDuplicates(["path"])
    return found.where(is_article_file(F.col("file_name"))).select(
        "path", F.timestamp_millis("modified").alias("modificationTime"), "length")


def list_xml_files(spark: SparkSession, *directories: str) -> DataFrame:
    """``path, modificationTime, length`` of the article files under ``directories``; no file is opened.

    Folders are listed by tasks, and the listing is a table in the shared
    folder.  Only for path patterns, and for stores that pyarrow does not
    open, Spark lists, which takes memory of the driver for each file.
    """
    roots = [_root(spark, directory) for directory in directories]
    if None in roots or not roots:
        return _scan_by_spark(spark, directories).select("path", "modificationTime", "length")
    return _article_listing(spark, roots)


def scan_xml_files(spark: SparkSession, *directories: str) -> DataFrame:
    """Article files under ``directories`` as ``path, modificationTime, length, content``.

    The files are listed when this is called (as in ``list_xml_files``), and
    the name filter is on the listing, so excluded files are never opened.
    Tasks get files by their bytes, a file counting ``OPEN_BYTES`` more.  To
    have no contents read, take ``list_xml_files``.
    """
    roots = [_root(spark, directory) for directory in directories]
    if None in roots or not roots:
        return _scan_by_spark(spark, directories)
    listing = _article_listing(spark, roots)
    count, total = listing.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    cost = total + count * OPEN_BYTES
    share = min(READ_BYTES, max(OPEN_BYTES, -(-cost // spark.sparkContext.defaultParallelism)))
    bound_batches(spark)
    return _opened(listing.repartition(max(1, -(-cost // share))))


def stream_xml_files(spark: SparkSession, directory: str, max_files: int = 100_000) -> DataFrame:
    """The same scan as a stream: each new file is delivered once, however old it is when it arrives.

    The source therefore forgets no file: its checkpoint holds an entry for each one ever seen.
    """
    pack_small_files(spark)
    source = _binary(spark.readStream).option("maxFilesPerTrigger", max_files)
    files = source.option("maxFileAge", "36500d").load(directory)
    return files.where(is_article_file(F.col("_metadata.file_name")))


def manifest(files: DataFrame) -> DataFrame:
    """Path, time, length and content hash of each file, for ``snapshot_diff``."""
    return files.select(
        "path",
        F.col("modificationTime").alias("modification_time"),
        "length",
        F.sha2("content", 256).alias("sha256"),
    )


@cache
def _client(scheme: str, authority: str) -> fs.FileSystem:
    return fs.FileSystem.from_uri(f"{scheme}://{authority}/")[0]


def client_for(path: str) -> tuple[fs.FileSystem, str]:
    """The file system that the scheme of a path names, and the path in it; names are taken as they are."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    authority = rest[2:].split("/", 1)[0] if rest.startswith("//") else ""
    return _client(scheme, authority), rest.removeprefix(f"//{authority}")


def read_files(listing: DataFrame) -> DataFrame:
    """The files of a listing ``path, modificationTime, length``, with their ``content``.

    The listing stays a table of any size: it is dealt out by a hash of the
    path, in shares of about ``READ_BYTES``, and each file is opened by its exact
    path where its row is.  A file that is gone by then has no row.
    """
    bound_batches(listing.sparkSession)
    total = listing.agg(F.sum("length")).first()[0] or 0
    return _opened(listing.select("path", "modificationTime", "length").repartition(int(total // READ_BYTES) + 1, "path"))


def _opened(rows: DataFrame) -> DataFrame:
    """``rows`` of a listing with the ``content`` of each file, opened where its row is."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, contents, held = [], [], 0

            def part():
                columns = [batch.column(name).take(pa.array(found, pa.int64())) for name in ("path", "modificationTime")]
                return pa.RecordBatch.from_arrays(
                    [*columns, pa.array([len(c) for c in contents], pa.int64()), pa.array(contents, pa.binary())],
                    names=BINARY_FILE.names)

            for row, path in enumerate(batch.column("path").to_pylist()):
                try:
                    client, place = client_for(path)
                    with client.open_input_stream(place) as file:
                        content = file.read()
                except FileNotFoundError:
                    continue
                found.append(row)
                contents.append(content)
                held += len(content)
                if held >= SEND_BYTES:
                    yield part()
                    found, contents, held = [], [], 0
            if found:
                yield part()

    return rows.mapInArrow(read, BINARY_FILE)


def scan_new_xml_files(spark: SparkSession, directory: str, existing: DataFrame) -> DataFrame:
    """Files under ``directory`` whose path is not yet in ``existing.file_name``.

    Only the listing is compared; then the new files are opened, and no others.
    """
    known = existing.select(F.col("file_name").alias("path"))
    return read_files(settle(list_xml_files(spark, directory).join(known, "path", "left_anti")))


def refresh_manifest(
    spark: SparkSession, directory: str, old: DataFrame, trust_times: bool = False
) -> DataFrame:
    """The manifest of ``directory`` now, given the one of an earlier time.

    Every file is hashed.  With ``trust_times`` a file whose time and length are
    as before keeps its hash, and only new and touched files are opened: a
    change that keeps both is then not seen.
    """
    if not trust_times:
        return manifest(scan_xml_files(spark, directory))
    same = ["path", "modification_time", "length"]
    known = old.groupBy(*same).agg(F.max("sha256").alias("sha256"))
    listing = list_xml_files(spark, directory).withColumnRenamed("modificationTime", "modification_time")
    matched = settle(listing.join(known, same, "left"))
    unread = matched.where(F.col("sha256").isNull()).withColumnRenamed("modification_time", "modificationTime")
    return matched.where(F.col("sha256").isNotNull()).unionByName(manifest(read_files(unread)))
