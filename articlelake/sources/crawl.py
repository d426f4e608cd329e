"""Crawled pages ``(url, status, html)`` stand for the responses of the journal's site."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articlelake import fixed_values as fixed
from articlelake.session import settle

# addresses that may be broadcast
SMALL = 500_000
# bitmaps that may be broadcast, of 4 KB for 32,768 rows of a file each
BITMAPS = 16_384


def fetched(crawl: DataFrame) -> DataFrame:
    """Pages that were delivered."""
    return crawl.where(F.col("status") == 200)


def with_link_exists(crawl: DataFrame) -> DataFrame:
    """Adds ``link_exists``: delivered, and not the site's own error page."""
    not_found = F.coalesce(F.col("html"), F.lit("")).contains(fixed.NOT_FOUND_TEXT)
    return crawl.withColumn(
        "link_exists", F.coalesce((F.col("status") == 200) & ~not_found, F.lit(False))
    )


def reachable_urls(crawl: DataFrame) -> DataFrame:
    """URLs known to exist, once for each time they were crawled: made for semi-joins."""
    return with_link_exists(crawl).where("link_exists").select("url")


def with_place(rows: DataFrame, *columns: str) -> DataFrame | None:
    """``columns`` and each row's place ``_file, _row``, for a table read straight from Parquet files."""
    try:
        return rows.select(*columns, F.xxhash64("_metadata.file_path").alias("_file"),
                           F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:  # a table of another kind
        return None


def rows_at_places(placed: DataFrame, places: DataFrame) -> DataFrame | None:
    """The rows of ``placed`` at ``places`` (``_file, _row``), not shuffled: each is a bit of its file.

    None when that takes more than ``BITMAPS`` bitmaps, which is counted.
    """
    marks = settle(places.groupBy("_file", F.bitmap_bucket_number("_row").alias("_part"))
                   .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_row")).alias("_bits")))
    if marks.count() > BITMAPS:
        return None
    at = F.bitmap_bit_position("_row")
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    near = placed.withColumn("_part", F.bitmap_bucket_number("_row")).join(F.broadcast(marks), ["_file", "_part"])
    return near.where(F.getbit(byte, (at % 8).cast("int")) == 1).drop("_file", "_row", "_part", "_bits")


def pages_at(crawl: DataFrame, wanted: DataFrame) -> DataFrame:
    """``url, html`` of the delivered pages at the ``url`` values of ``wanted``, one for each address.

    Which rows are wanted is found on addresses and hashes; html is read once,
    for them only.  Of several pages at one address the one with the smallest
    content hash stands.  When the crawl is read straight from Parquet files, the
    chosen rows are marked by their place in the file, one bit for each row, and
    html is not shuffled while that takes at most ``BITMAPS`` bitmaps (which is
    counted).  Otherwise it is not shuffled while there are at most ``SMALL`` of them.
    """
    placed = with_place(fetched(crawl), "url", "html")
    if placed is not None:
        narrow = placed.select("url", F.struct(F.xxhash64("html").alias("version"), "_file", "_row").alias("_page"))
        first = narrow.join(wanted.select("url"), "url", "left_semi").groupBy("url").agg(F.min("_page").alias("_page"))
        pages = rows_at_places(placed, first.select("_page._file", "_page._row"))
        if pages is not None:
            return pages
    version = F.xxhash64("html").alias("_version")
    narrow = fetched(crawl).select("url", version)
    chosen = settle(
        narrow.join(wanted.select("url"), "url", "left_semi").groupBy("url", "_version").agg(F.count("*").alias("_rows"))
        .groupBy("url").agg(F.min(F.struct("_version", "_rows")).alias("_first")).select("url", "_first.*"))
    if chosen.count() <= SMALL:
        chosen = F.broadcast(chosen)
    pages = fetched(crawl).select("url", "html", version).join(chosen, ["url", "_version"])
    repeated = pages.where("_rows > 1").dropDuplicates(["url"])
    return pages.where("_rows = 1").union(repeated).select("url", "html")
