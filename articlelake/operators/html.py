"""Journal pages to rows: issue links, issue contents, article pages, XML links."""

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from articlelake import fixed_values as fixed
from articlelake.functions.html_fields import Pick, read_page
from articlelake.functions.text import absolute_url, article_key, join_texts, xml_key
from articlelake.session import DOCUMENT_BATCH, bound_batches

# --- Fixed values: where the journal's pages hold their parts -----------------
NAV_LINKS = Pick(("div#leftsidenav", "a"), "rows", many=True,
                 fields={"href": Pick((), "@href"), "text": Pick((), "text")})
ISSUE_PAGE = {
    "issue_title": Pick(("div#toc", "h2")),
    "editors": Pick(("div#toc", "h3"), default=""),
    "articles": Pick(("div#toc", "div.articleInfo"), "rows", many=True, fields={
        "authors": Pick(("div",)),
        "href": Pick(("a",), "@href"),
        "article_title": Pick(("a",)),
        "abstract": Pick(("span.viewAbstract",), default=""),
    }),
}
PAGE_LINKS = Pick(("a",), "rows", many=True, fields={"href": Pick((), "@href")})
ARTICLE_PAGE = {
    "pubinfo": Pick(("div.DHQarticle", "div#pubInfo")),
    "header_lang": Pick(("div.DHQarticle", "div.DHQheader", "h1"), "@class", default=""),
    "header_title": Pick(("div.DHQarticle", "div.DHQheader", "h1")),
    "page_authors": Pick(("div.DHQarticle", "div.DHQheader", "div.author"), many=True),
    "article_abstract": Pick(("div.DHQarticle", "div#DHQtext", "div#abstract"), default=""),
    "article_text": Pick(("div.DHQarticle", "div#DHQtext", "div[class=div div0]"), many=True),
    "notes": Pick(("div.DHQarticle", "div#notes", "div.endnote"), many=True),
    "works_cited": Pick(("div.DHQarticle", "div#worksCited", "div.bibl"), many=True),
}


def _type(pick: Pick) -> T.DataType:
    one = T.StringType()
    if pick.take == "rows":
        inner = [T.StructField(name, _type(p)) for name, p in pick.fields.items()]
        one = T.StructType([T.StructField("pos", T.IntegerType()), *inner])
    return T.ArrayType(one) if pick.many else one


def extract_html(
    pages: DataFrame, picks: Mapping[str, Pick], html: str = "html", carry: Sequence[str] = ("url",)
) -> DataFrame:
    """The picked fields of each page next to the carried columns; one parse per page."""
    picks, carry = dict(picks), list(carry)
    source = pages.select(F.col(html).alias("_html"), *carry)
    result = T.StructType(
        [source.schema[name] for name in carry]
        + [T.StructField(name, _type(pick)) for name, pick in picks.items()]
    )
    arrow = to_arrow_schema(result)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [read_page(value.as_py(), picks) for value in batch.column("_html")]
            arrays = [batch.column(name) for name in carry] + [
                pa.array([row[name] for row in rows], arrow.field(name).type) for name in picks
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=arrow.names)

    bound_batches(source.sparkSession, DOCUMENT_BATCH)
    return source.mapInArrow(parse, result)


def link_rows(
    pages: DataFrame, links: Pick = NAV_LINKS, html: str = "html", carry: Sequence[str] = ("url",)
) -> DataFrame:
    """One row per link of the picked part of each page: carried columns, ``pos, href, text``."""
    found = extract_html(pages, {"_links": links}, html, carry)
    return found.select(*carry, F.inline("_links"))


def is_issue_link(href):
    """Links to issues and to the preview of the coming one."""
    keep = F.lit(False)
    for part in fixed.ISSUE_LINK_PARTS:
        keep |= href.contains(part)
    return keep


def issue_links(home_pages: DataFrame, base: str, links: Pick = NAV_LINKS) -> DataFrame:
    """``issue_link, issue_text`` of the navigation part of the home page."""
    nav = link_rows(home_pages, links).where(is_issue_link(F.col("href")))
    return nav.select(absolute_url(base, F.col("href")).alias("issue_link"),
                      F.col("text").alias("issue_text"))


def article_links(
    issue_pages: DataFrame, base: str, page: Mapping[str, Pick] = ISSUE_PAGE,
    carry: Sequence[str] = ("issue_text", "issue_link"),
) -> DataFrame:
    """One row per article of each issue page, with the issue's columns and the keys in the link."""
    found = extract_html(issue_pages, page, carry=carry)
    rows = found.select("issue_title", "editors", *carry, F.inline("articles"))
    linked = rows.withColumn("article_link", absolute_url(base, F.col("href")))
    return linked.select(
        "issue_title", "editors", "authors", "article_link", "article_title", "abstract", *carry,
        *article_key(F.col("article_link")),
    )


def page_hrefs(pages: DataFrame, html: str = "html", carry: Sequence[str] = ("url",)) -> DataFrame:
    """Every link target of each page."""
    return link_rows(pages, PAGE_LINKS, html, carry).where(F.col("href").isNotNull())


def xml_links(hrefs: DataFrame, href: str = "href") -> DataFrame:
    """Links to article XML: ``xml_link, volume, issue, article_id``."""
    link = F.col(href)
    candidates = hrefs.where(link.contains(fixed.XML_LINK_PART))
    return candidates.select(link.alias("xml_link"), *xml_key(link)).dropna(subset=["article_id"])


def article_pages(
    pages: DataFrame, page: Mapping[str, Pick] = ARTICLE_PAGE, carry: Sequence[str] = ("url",)
) -> DataFrame:
    """Header, abstract, text parts, notes and bibliography of each article page.

    ``page`` may hold only some of the parts: nothing else is then read and sent back.
    """
    found = extract_html(pages, page, carry=carry)
    if "header_lang" in page:
        found = found.withColumn("header_lang", F.regexp_extract("header_lang", r"(\S+)", 1))
    if "article_text" in page:
        found = found.withColumn("extracted_text", join_texts(F.col("article_text")))
    return found


def note_rows(pages: DataFrame, column: str = "notes", *keep: str) -> DataFrame:
    """One row per note (or citation) in order."""
    return pages.select(*keep, F.posexplode(column).alias("position", "text"))
