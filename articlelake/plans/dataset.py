"""From article files and a link catalog to the finished article table.

Cleaning, joining and filling work on a few narrow columns; texts are written
once by the parse and meet the finished rows in one join at the end.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from articlelake.functions.text import as_key, pad_article_id, pad_volume, parse_date, replace_all
from articlelake.operators.joins import join_links
from articlelake.operators.repair import (
    apply_overrides,
    default_overrides,
    default_unassigned,
    fill_from_group,
    fill_links,
    latest_per_key,
    share_in_group,
)
from articlelake.operators.tei import extract_articles, good_articles
from articlelake.operators.unions import append_rows, not_yet_processed
from articlelake.schemas import ARTICLE_LINKS
from articlelake.session import local_table, require_utc, settle
from articlelake.sources.tables import stage, stage_is_finished, write_csv
from articlelake.sources.xml_files import scan_new_xml_files, scan_xml_files

KEY_COLUMNS = ("file_name", "article_id", "volume", "issue", "date_when")


def article_keys(articles: DataFrame) -> DataFrame:
    """The narrow columns that cleaning needs; ids as padded text."""
    return articles.select(*KEY_COLUMNS).withColumn("article_id", pad_article_id(F.col("article_id")))


def clean_keys(keys: DataFrame, overrides: DataFrame, dedupe_by: str = "date_when") -> DataFrame:
    """Dates read, newest version per article, corrections applied, gaps filled."""
    require_utc(keys.sparkSession)
    date_when = replace_all(F.col("date_when"))
    dated = keys.withColumns({"date_when": date_when, "date_processed": parse_date(date_when)})
    corrected = default_unassigned(apply_overrides(latest_per_key(dated, by=dedupe_by), overrides))
    return fill_from_group(settle(corrected))  # written once, as the fill reads it twice


def catalog_keys(links: DataFrame) -> DataFrame:
    """Link columns with keys padded to the width that article files use."""
    return links.withColumns({
        "volume": pad_volume(F.col("volume")), "article_id": pad_article_id(F.col("article_id")),
    })


def build_dataset(
    articles: DataFrame, links: DataFrame | None = None, backfill: DataFrame | None = None,
    overrides: DataFrame | None = None, dedupe_by: str = "date_when",
) -> DataFrame:
    """Narrow rows of the dataset: cleaned keys and dates next to their catalog entry."""
    spark = articles.sparkSession
    overrides = default_overrides(spark) if overrides is None else overrides
    links = local_table(spark, ARTICLE_LINKS) if links is None else links
    rows = clean_keys(article_keys(articles), overrides, dedupe_by)
    if backfill is not None:
        rows = append_rows(rows, article_keys(backfill))
    return join_links(rows, catalog_keys(links))


def finalize(dataset: DataFrame, crawl: DataFrame, base: str) -> DataFrame:
    """Known addresses filled in, issue attributes shared by all articles of an issue."""
    padded = dataset.withColumn("article_id", pad_article_id(as_key(F.col("article_id"))))
    return share_in_group(settle(fill_links(padded, crawl, base)))


def with_contents(rows: DataFrame, articles: DataFrame) -> DataFrame:
    """Put the columns that cleaning left behind back next to the finished rows.

    When ``rows`` is a settled table that is small enough, the texts are not shuffled.
    A file name that stands for several articles is an error: each would get the contents of all.
    """
    repeated = articles.groupBy("file_name").count().where("count > 1").select("file_name").take(3)
    if repeated:
        raise ValueError(f"file names of several articles: {[row.file_name for row in repeated]}")
    contents = articles.drop(*[c for c in KEY_COLUMNS if c != "file_name"])
    return rows.join(contents, "file_name")


def _parsed(spark: SparkSession, corpus: str | DataFrame, path: str, mode: str) -> DataFrame:
    """All documents of the corpus as parsed so far; ``append`` adds those not parsed yet."""
    def everything():
        return extract_articles(scan_xml_files(spark, corpus) if isinstance(corpus, str) else corpus)

    finished = stage_is_finished(spark, path)
    parsed = stage(spark, path, everything, rebuild=mode == "rebuild")
    if mode == "append" and finished:
        new = (scan_new_xml_files(spark, corpus, parsed) if isinstance(corpus, str)
               else not_yet_processed(corpus, parsed.withColumnRenamed("file_name", "path"), "path"))
        extract_articles(new).write.mode("append").parquet(path)
        parsed = spark.read.schema(parsed.schema).parquet(path)
    return parsed


def build_articles(
    spark: SparkSession, corpus: str | DataFrame, folder: str, crawl: DataFrame, base: str,
    links: DataFrame | None = None, backfill: DataFrame | None = None,
    overrides: DataFrame | None = None, mode: str = "reuse", csv: bool = False,
) -> DataFrame:
    """The whole way from files to the stored table ``folder/articles``.

    ``corpus`` is a directory of XML files, or a table ``path, content`` in which they were landed.

    ``mode="reuse"`` returns a finished table as it is, ``"append"`` parses only files
    that are new and builds the table from all of them, ``"rebuild"`` starts over.
    """
    if mode not in ("reuse", "append", "rebuild"):
        raise ValueError(f"unknown mode {mode!r}")

    def at(name):
        return f"{folder.rstrip('/')}/{name}"

    def finished():
        articles = good_articles(_parsed(spark, corpus, at("parsed"), mode))
        dataset = build_dataset(articles, links, backfill, overrides)
        everything = articles if backfill is None else append_rows(articles, backfill)
        return with_contents(settle(finalize(dataset, crawl, base)), everything)

    table = stage(spark, at("articles"), finished, rebuild=mode != "reuse")
    if csv:
        write_csv(table, at("articles_csv"))
    return table
