"""From crawled pages to the link catalog, the missing articles and their backfill."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articlelake.functions.text import absolute_url, pad_article_id
from articlelake.operators.html import article_links, issue_links, page_hrefs, xml_links
from articlelake.operators.joins import missing_articles
from articlelake.operators.tei import extract_articles, good_articles
from articlelake.plans.dataset import catalog_keys
from articlelake.session import settle
from articlelake.sources.crawl import fetched, pages_at, rows_at_places, with_place
from articlelake.sources.xml_files import base_name, is_article_file


@dataclass(frozen=True)
class LinkCatalog:
    issue_links: DataFrame
    article_links: DataFrame
    missing: DataFrame
    xml_links: DataFrame
    backfill: DataFrame


def catalog_articles(crawl: DataFrame, issues: DataFrame, base: str) -> DataFrame:
    """The articles of every issue whose page was delivered."""
    pages = pages_at(crawl, issues.select(F.col("issue_link").alias("url")))
    found = article_links(pages.withColumnRenamed("url", "issue_link"), base, carry=["issue_link"])
    columns = [name for name in found.columns if name != "issue_link"]
    columns[columns.index("abstract") + 1:columns.index("abstract") + 1] = ["issue_text", "issue_link"]
    return catalog_keys(found.join(issues, "issue_link").select(*columns))


def catalog_missing(links: DataFrame, articles: DataFrame) -> DataFrame:
    """Catalog entries that the corpus ``articles`` lacks."""
    known = articles.select(pad_article_id(F.col("article_id")).alias("article_id"))
    return missing_articles(links, known)


def missing_xml_links(crawl: DataFrame, missing: DataFrame, xml_base: str) -> DataFrame:
    """Links to delivered XML on the pages of missing articles: ``url`` and the XML link columns."""
    pages = pages_at(crawl, missing.select(F.col("article_link").alias("url")))
    # a page with neither of these holds no such link, plain or escaped
    pages = pages.where(F.col("html").contains("xml") | F.col("html").contains("&"))
    found = xml_links(page_hrefs(pages))
    with_url = found.withColumn("url", absolute_url(xml_base, F.col("xml_link")))
    return with_url.join(fetched(crawl).select("url"), "url", "left_semi")


def backfill_articles(crawl: DataFrame, links: DataFrame) -> DataFrame:
    """The crawled XML behind ``links``, named and read like the files of the corpus.

    Of several addresses with one article id the last one stands.
    """
    files = pages_at(crawl, links.select("url").where(is_article_file(base_name(F.col("url")))))
    parsed = settle(good_articles(extract_articles(files, path="url", content="html")))
    placed = with_place(parsed, *parsed.columns)  # an address is one row: texts are picked where they are
    last = placed.where("article_id is not null").groupBy("article_id").agg(
        F.max(F.struct("file_name", "_file", "_row")).alias("_last"))
    named = rows_at_places(placed, last.select("_last._file", "_last._row"))
    if named is None:
        named = parsed.join(last.select("_last.file_name"), "file_name", "left_semi")
    return named.union(parsed.where("article_id is null"))


def link_catalog(
    crawl: DataFrame, home_pages: DataFrame, base: str, articles: DataFrame,
    xml_base: str | None = None,
) -> LinkCatalog:
    """The catalog, what the corpus lacks of it, and the lacking articles read from the crawl.

    ``home_pages`` are the crawl's rows for the home page (of one or of many journals);
    ``base`` and ``xml_base`` are the site addresses that page and XML links are relative to.
    Link tables are settled: they are narrow, used several times, and then have a known size.
    Of the missing articles only the addresses are used here, so their entries, which hold the
    abstracts, are picked out of the settled links when they are read.
    """
    issues = settle(issue_links(home_pages, base))
    links = settle(catalog_articles(crawl, issues, base))
    missing = catalog_missing(links, articles)
    delivered = settle(missing_xml_links(crawl, missing, xml_base or base))
    return LinkCatalog(
        issues, links, missing, delivered.drop("url"), backfill_articles(crawl, delivered)
    )
