"""Clean an article table: newest version per article, corrections, fills from siblings."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from articlelake import fixed_values as fixed
from articlelake.functions.text import article_url
from articlelake.operators.joins import keyed_left_join, keyed_mark, lookup_join
from articlelake.schemas import OVERRIDES
from articlelake.session import local_table, settle
from articlelake.sources.crawl import with_link_exists
from articlelake.sources.xml_files import base_name

ISSUE_KEYS = ("volume", "issue")
ISSUE_ATTRIBUTES = ("issue_title", "scraped_editors", "issue_text", "issue_link")


def latest_per_key(
    df: DataFrame, key: str = "article_id", by: str = "date_when",
    tie_breakers: Sequence[str] = ("file_name",),
) -> DataFrame:
    """One row per non-null key: the greatest ``by`` (nulls last), then the first tie-breaker.

    Spark applies the rank limit before the shuffle as well, so each task sends
    at most one row per key and a key with very many versions stays small.
    The rows are sorted: pass narrow columns and bring the rest back by a join.
    """
    order = Window.partitionBy(key).orderBy(F.col(by).desc_nulls_last(), *tie_breakers)
    ranked = df.where(F.col(key).isNotNull()).withColumn("_rank", F.row_number().over(order))
    return ranked.where("_rank = 1").drop("_rank")


def default_overrides(spark) -> DataFrame:
    return local_table(spark, OVERRIDES, fixed.OVERRIDES)


def apply_overrides(
    df: DataFrame, overrides: DataFrame, columns: Sequence[str] = ISSUE_KEYS, path: str = "file_name"
) -> DataFrame:
    """Set ``columns`` for the files named in ``overrides`` (by base name).

    Of several corrections of one file the greatest counts, as one row.  They
    are settled, so that Spark knows their size.
    """
    last = settle(overrides.groupBy("base_name").agg(F.max(F.struct(*columns)).alias("_last")))
    fixes = last.select("base_name", *[F.col(f"_last.{c}").alias(f"_fixed_{c}") for c in columns])
    fixed_rows = keyed_left_join(
        df.withColumn("base_name", base_name(F.col(path))), fixes, ["base_name"], [path]
    )
    return fixed_rows.select(
        *[F.coalesce(f"_fixed_{c}", c).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def default_unassigned(df: DataFrame, columns: Sequence[str] = ISSUE_KEYS) -> DataFrame:
    return df.fillna({column: fixed.UNASSIGNED for column in columns})


def _with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def fill_from_group(
    df: DataFrame, value: str = "date_processed", keys: Sequence[str] = ISSUE_KEYS,
    spread_by: Sequence[str] = ("file_name",),
) -> DataFrame:
    """A missing ``value`` becomes the greatest one of its group; present values stay.

    Partial aggregation reduces each group before the shuffle; the small result
    is joined back, so a group of any size is never brought together.
    Rows with a null key belong to no group and stay as they are.
    ``df`` is read twice: settle it first when it is costly to compute.
    """
    groups = settle(
        _with_keys(df, keys).groupBy(*keys)
        .agg(F.max(value).alias("_greatest"), F.count(F.lit(1)).alias("_rows"))
    )
    filled = lookup_join(df, groups, keys, ["_greatest"], "_rows", spread_by)
    return filled.withColumn(value, F.coalesce(value, "_greatest")).drop("_greatest")


def share_in_group(
    df: DataFrame, columns: Sequence[str] = ISSUE_ATTRIBUTES, keys: Sequence[str] = ISSUE_KEYS,
    order_by: Sequence[str] = ("article_id", "file_name"), mode: str = "overwrite",
    spread_by: Sequence[str] = ("file_name",),
) -> DataFrame:
    """Give every row of a group the group's first non-null value of each column.

    ``mode="overwrite"`` replaces differing values too; ``mode="fill"`` keeps them.
    ``order_by`` says which row is first; the value itself decides what is left open.
    Rows with a null key stay as they are.  ``df`` is read twice, as in ``fill_from_group``.
    """
    if mode not in ("overwrite", "fill"):
        raise ValueError(f"unknown mode {mode!r}")
    firsts = [
        F.min_by(column, F.when(F.col(column).isNotNull(), F.struct(*order_by, column)))
        .alias(f"_first_{column}")
        for column in columns
    ]
    groups = settle(
        _with_keys(df, keys).groupBy(*keys).agg(*firsts, F.count(F.lit(1)).alias("_rows"))
    )
    shared = lookup_join(df, groups, keys, [f"_first_{c}" for c in columns], "_rows", spread_by)

    def value(column):
        if mode == "fill":
            return F.coalesce(column, f"_first_{column}")
        in_no_group = F.lit(False)
        for key in keys:
            in_no_group |= F.col(key).isNull()
        return F.when(in_no_group, F.col(column)).otherwise(F.col(f"_first_{column}"))

    return shared.select(*[value(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def fill_links(
    df: DataFrame, crawl: DataFrame, base: str,
    columns: Mapping[str, str] = {"link": "article_link", "volume": "volume", "issue": "issue",
                                  "article_id": "article_id"},
    spread_by: Sequence[str] = ("file_name",),
) -> DataFrame:
    """Fill a missing link with the address built from the keys, if that page is known to exist."""
    link = F.col(columns["link"])
    built = article_url(base, *[F.col(columns[c]) for c in ("volume", "issue", "article_id")])
    pages = with_link_exists(crawl).where("link_exists").select(F.col("url").alias("_built"))
    # rows that have a link ask for nothing: their key is null
    asked = df.withColumn("_built", F.when(link.isNull(), built))
    checked = keyed_mark(asked, pages, "_built", "_exists", spread_by)
    filled = F.when(F.col("_exists"), F.col("_built")).otherwise(link)
    return checked.withColumn(columns["link"], filled).select(*df.columns)
