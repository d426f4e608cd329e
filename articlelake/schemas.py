"""One explicit schema per table; nothing is inferred from the data."""

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


AUTHOR = T.StructType(_strings("author_name", "affiliation", "email", "bio"))

# What the XML job reads out of one document, next to its path and its status.
ARTICLE_FIELDS = T.StructType(
    _strings("article_id", "volume", "issue", "article_type", "date_when", "keywords",
             "language_ident", "abstract", "title")
    + [T.StructField("authors", T.ArrayType(AUTHOR))]
    + _strings("body_text")
)

ARTICLES_RAW = T.StructType(_strings("file_name") + ARTICLE_FIELDS.fields)
PARSED = T.StructType(ARTICLES_RAW.fields + _strings("status", "parse_error"))
ARTICLES_CLEAN = T.StructType(
    ARTICLES_RAW.fields + [T.StructField("date_processed", T.TimestampType())]
)

ISSUE_LINKS = T.StructType(_strings("issue_link", "issue_text"))
ARTICLE_LINKS = T.StructType(
    _strings("issue_title", "editors", "authors", "article_link", "article_title", "abstract",
             "issue_text", "issue_link", "volume", "issue", "article_id")
)
XML_LINKS = T.StructType(_strings("xml_link", "volume", "issue", "article_id"))
LINK_COLUMNS = _strings("issue_title", "scraped_editors", "scraped_authors", "article_link",
                        "article_title", "abstract_link", "issue_text", "issue_link")
PROCESSED = T.StructType(ARTICLES_CLEAN.fields + LINK_COLUMNS)

OVERRIDES = T.StructType(_strings("base_name", "volume", "issue"))
CRAWL = T.StructType(
    [T.StructField("url", T.StringType()),
     T.StructField("status", T.IntegerType()),
     T.StructField("html", T.StringType())]
)
MANIFEST = T.StructType(
    [T.StructField("path", T.StringType()),
     T.StructField("modification_time", T.TimestampType()),
     T.StructField("length", T.LongType()),
     T.StructField("sha256", T.StringType())]
)
BINARY_FILE = T.StructType(
    [T.StructField("path", T.StringType()),
     T.StructField("modificationTime", T.TimestampType()),
     T.StructField("length", T.LongType()),
     T.StructField("content", T.BinaryType())]
)
# A file found below a folder; a folder still to be listed has no length.
FOUND = T.StructType(
    _strings("path", "file_name") + [T.StructField("modified", T.LongType()), T.StructField("length", T.LongType())]
)
