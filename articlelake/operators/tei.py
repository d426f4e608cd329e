"""Article documents to rows: one parse per document, broken documents set aside."""

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from articlelake.functions.tei_fields import OK, read_tei
from articlelake.schemas import ARTICLE_FIELDS
from articlelake.session import DOCUMENT_BATCH, bound_batches


def extract_articles(
    files: DataFrame, path: str = "path", content: str = "content",
    fields: Sequence[str] | None = None, carry: Sequence[str] = (),
) -> DataFrame:
    """``file_name``, the fields of each document, ``status`` and ``parse_error``.

    ``content`` is bytes or text.  ``fields`` limits what is read and sent back;
    ``carry`` copies input columns along.  A document that is only an XML
    declaration, or is not well formed, gives a row with null fields and its
    status, so the good rows and the quarantine come from one pass.
    """
    wanted = [f.name for f in ARTICLE_FIELDS if fields is None or f.name in fields]
    source = files.select(F.col(path).alias("file_name"), F.col(content).alias("_content"), *carry)
    parsed = T.StructType(
        [source.schema["file_name"]]
        + [ARTICLE_FIELDS[name] for name in wanted]
        + [T.StructField("status", T.StringType()), T.StructField("parse_error", T.StringType())]
        + [source.schema[name] for name in carry]
    )
    arrow = to_arrow_schema(parsed)
    carried = list(carry)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: [] for name in [*wanted, "status", "parse_error"]}
            for value in batch.column("_content"):
                status, error, record = read_tei(value.as_py(), wanted)
                columns["status"].append(status)
                columns["parse_error"].append(error)
                for name in wanted:
                    columns[name].append(record.get(name))
            arrays = [
                batch.column(name) if name == "file_name" or name in carried
                else pa.array(columns[name], arrow.field(name).type)
                for name in arrow.names
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=arrow.names)

    bound_batches(source.sparkSession, DOCUMENT_BATCH)
    return source.mapInArrow(parse, parsed)


def good_articles(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("status") == OK).drop("status", "parse_error")


def quarantine(parsed: DataFrame) -> DataFrame:
    """Documents that gave no article, with the reason."""
    return parsed.where(F.col("status") != OK).select("file_name", "status", "parse_error")


def author_rows(articles: DataFrame, *keep: str) -> DataFrame:
    """One row per author in order; an article without authors keeps one row of nulls."""
    authors = articles.select(*keep, F.posexplode_outer("authors").alias("position", "_author"))
    return authors.select(*keep, "position", "_author.*")
