"""Article pages next to their catalog entry."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articlelake.functions.html_fields import Pick
from articlelake.operators.html import ARTICLE_PAGE, article_pages
from articlelake.session import settle
from articlelake.sources.crawl import SMALL, pages_at


def article_page_table(
    links: DataFrame, crawl: DataFrame, page: Mapping[str, Pick] = ARTICLE_PAGE
) -> DataFrame:
    """Every link whose page was delivered, with all link columns and the page's parts.

    Links meet the pages before these are parsed; up to ``SMALL`` of them, which
    is counted, are brought to the pages.
    """
    links = settle(links)
    pages = pages_at(crawl, links.select(F.col("article_link").alias("url"))).withColumnRenamed("url", "article_link")
    near = F.broadcast(links) if links.count() <= SMALL else links
    return article_pages(pages.join(near, "article_link"), page, carry=links.columns)
