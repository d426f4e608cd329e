"""Append, backfill and resume."""

from pyspark.sql import DataFrame

from articlelake.operators.joins import keyed_anti_join
from articlelake.session import settle


def append_rows(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Both tables by column name; a column one of them lacks is null there."""
    return existing.unionByName(new, allowMissingColumns=True)


def not_yet_processed(files: DataFrame, existing: DataFrame, key: str = "file_name") -> DataFrame:
    """Files that have no row in ``existing``. Use it before parsing, so only new files are parsed.

    Only keys are compared with what exists.  The new ones are settled, so a small
    increment is picked out by a broadcast and contents are not shuffled.
    """
    if existing.isEmpty():
        return files
    new = settle(keyed_anti_join(files.select(key), existing, key, [key]))
    return files.join(new, files[key].eqNullSafe(new[key]), "left_semi")
