"""Joins that keep their balance when one key, or the null key, holds a large share of rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articlelake.functions.text import as_key
from articlelake.session import settle

# Broadcast bound for hot keys: a key below this rank holds at most 1/1024 of the rows.
HOT_KEYS = 1024
_SPREAD = "_spread"


def _any_null(keys: Sequence[str]) -> Column:
    missing = F.lit(False)
    for key in keys:
        missing |= F.col(key).isNull()
    return missing


def _spread_rows(rows: DataFrame, away: Column, spread_by: Sequence[str]) -> DataFrame:
    """Rows flagged ``away`` cannot match, so they go anywhere: by a hash of their own columns.

    The hash is a function of the row, not of chance, so a task that is run
    again after a lost executor sends each row to the same place.
    """
    return rows.withColumn(
        _SPREAD, F.when(away, F.xxhash64(*spread_by)).otherwise(F.lit(0).cast("long"))
    )


def _settled(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    # Always 0, but not a literal: the optimizer would take a literal out of the join key.
    return rows.withColumn(_SPREAD, F.pmod(F.xxhash64(*keys), F.lit(1).cast("long")))


def keyed_left_join(
    rows: DataFrame, other: DataFrame, keys: Sequence[str], spread_by: Sequence[str]
) -> DataFrame:
    """``rows`` left join ``other`` on equal keys; several matches give several rows.

    Rows with a null key match nothing and are spread over all partitions
    instead of meeting in one.  A hot non-null key is split at run time by
    adaptive execution, which can divide the left side of this join.
    """
    keys = list(keys)
    spread = _spread_rows(rows, _any_null(keys), spread_by)
    return spread.join(_settled(other, keys), keys + [_SPREAD], "left").drop(_SPREAD)


def keyed_anti_join(
    rows: DataFrame, other: DataFrame, key: str, spread_by: Sequence[str]
) -> DataFrame:
    """Rows whose key does not occur in ``other``; rows with a null key are kept.

    ``other`` may repeat keys: nothing stands between its shuffle and the join,
    so that adaptive execution can split a hot key.
    """
    spread = _spread_rows(rows, _any_null([key]), spread_by)
    known = _settled(other.select(key).where(F.col(key).isNotNull()), [key])
    return spread.join(known, [key, _SPREAD], "left_anti").drop(_SPREAD)


def keyed_mark(
    rows: DataFrame, other: DataFrame, key: str, mark: str, spread_by: Sequence[str]
) -> DataFrame:
    """All rows, with the column ``mark``: does the key occur in ``other``?

    The distinct keys are settled first, so the join has a shuffle of its own and
    a hot key is split as in ``keyed_left_join``.
    """
    known = settle(other.select(key).where(F.col(key).isNotNull()).distinct())
    joined = keyed_left_join(rows, known.withColumn(mark, F.lit(True)), [key], spread_by)
    return joined.withColumn(mark, F.col(mark).isNotNull())


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    weight: str,
    spread_by: Sequence[str],
) -> DataFrame:
    """Add ``values`` from ``lookup`` (one row per non-null key) to each row; no match gives null.

    ``weight`` counts the rows of each key.  The ``HOT_KEYS`` heaviest keys are
    broadcast, a bound that no amount of data moves; their rows are answered
    where they are and then spread like null-key rows.  The other keys meet
    in an ordinary join, in which no key holds more than ``1/HOT_KEYS`` of the rows.
    When ``lookup`` is a settled table of small size, that join is a broadcast
    too, and ``rows`` is not shuffled at all.
    """
    keys, values = list(keys), list(values)
    hot = (
        lookup.orderBy(F.desc(weight), *keys).limit(HOT_KEYS)
        .select(*keys, F.struct(*values).alias("_hot"), F.lit(True).alias("_is_hot"))
    )
    rest = _settled(lookup.select(*keys, F.struct(*values).alias("_rest")), keys)
    near = rows.join(F.broadcast(hot), keys, "left")
    far = _spread_rows(near, _any_null(keys) | F.col("_is_hot").isNotNull(), spread_by)
    joined = far.join(rest, keys + [_SPREAD], "left")
    found = [F.coalesce(f"_hot.{value}", f"_rest.{value}").alias(value) for value in values]
    return joined.select(*rows.columns, *found)


def join_links(
    articles: DataFrame, links: DataFrame, keys: Sequence[str] = ("article_id", "volume", "issue"),
    spread_by: Sequence[str] = ("file_name",), renames: dict[str, str] | None = None,
) -> DataFrame:
    """Articles with their catalog entries; an article in several entries appears once for each."""
    renames = renames or {
        "authors": "scraped_authors", "editors": "scraped_editors", "abstract": "abstract_link",
    }
    text_keys = {key: as_key(F.col(key)) for key in keys}
    return keyed_left_join(
        articles.withColumns(text_keys),
        links.withColumnsRenamed(renames).withColumns(text_keys),
        keys,
        spread_by,
    )


def missing_articles(
    links: DataFrame, articles: DataFrame, key: str = "article_id",
    spread_by: Sequence[str] = ("article_link",),
) -> DataFrame:
    """Catalog entries whose article is not in the corpus."""
    return keyed_anti_join(links, articles, key, spread_by)


def existing_links(links: DataFrame, reachable: DataFrame, link: str = "article_link") -> DataFrame:
    """Rows whose link is known to exist."""
    return links.join(reachable.select(F.col("url").alias(link)), link, "left_semi")
