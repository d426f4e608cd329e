"""Counts for reports. Partial aggregation keeps hot groups small."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("articles"))


def counts_by_type(df: DataFrame) -> DataFrame:
    return count_by(df, "date_processed", "article_type")


def counts_by_language(df: DataFrame) -> DataFrame:
    return count_by(df, "date_processed", "language_ident")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def null_split(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows that lack ``column`` and rows that have it."""
    return df.where(F.col(column).isNull()), df.where(F.col(column).isNotNull())


def top_rows(df: DataFrame, by: str, k: int, *tie_breakers: str) -> DataFrame:
    """The ``k`` rows with the greatest ``by``, nulls last."""
    return df.orderBy(F.col(by).desc_nulls_last(), *tie_breakers).limit(k)
