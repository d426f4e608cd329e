"""Counts over time."""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articlelake.functions.text import parse_date
from articlelake.operators.counts import counts_by_language, counts_by_type


class Report(NamedTuple):
    by_type: DataFrame
    by_language: DataFrame


def report(articles: DataFrame) -> Report:
    """Articles per date and type, and per date and language. Text dates are read first."""
    if isinstance(articles.schema["date_processed"].dataType, T.StringType):
        articles = articles.withColumn("date_processed", parse_date(F.col("date_processed")))
    return Report(counts_by_type(articles), counts_by_language(articles))
