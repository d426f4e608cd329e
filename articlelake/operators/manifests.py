"""What changed between two versions of the input."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _newness():
    return F.struct("modification_time", "sha256")


def latest_version(manifest: DataFrame) -> DataFrame:
    """The newest entry of each path; equal times are decided by the content hash."""
    others = [name for name in manifest.columns if name != "path"]
    newest = manifest.groupBy("path").agg(F.max_by(F.struct(*others), _newness()).alias("_newest"))
    return newest.select("path", "_newest.*").select(*manifest.columns)


def _latest_hash(manifest: DataFrame, name: str) -> DataFrame:
    return manifest.groupBy("path").agg(F.max_by("sha256", _newness()).alias(name))


def snapshot_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """``path, change`` with change one of added, removed, changed, unchanged.

    Contents are compared by hash: a file that was only touched is unchanged.
    """
    change = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when(F.col("_old") != F.col("_new"), "changed")
        .otherwise("unchanged")
    )
    both = _latest_hash(old, "_old").join(_latest_hash(new, "_new"), "path", "full_outer")
    return both.select("path", change.alias("change"))


def has_changed(diff: DataFrame) -> bool:
    """Is there anything to do?"""
    return not diff.where("change <> 'unchanged'").isEmpty()
