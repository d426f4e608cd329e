"""Runs of lines that repeat across documents: later copies are deleted.

Every document is a sequence of line ids.  Prefix doubling names the runs of 1, 2, 4, ... lines that
start at every line: the name of a run of ``2 ** k`` lines comes from the names of its two halves.
From these names each suffix gets the name of its shortest prefix with enough words, and suffixes of
one name are an interval of the suffix array whose common prefix is that long.  The first suffix of
an interval stays; the prefixes of the others are later copies.  The same from the end backwards, so
that the deleted runs reach to the last common line on both sides: together they are the maximal
repeated runs.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from articlelake.llm.common import bound

MIN_WORDS = 50
_BLANKS = r"[ \t\r\f\x0B]+"


def _lines(text: Column) -> Column:
    """The lines with words: place in the text, id, number of words."""
    split = F.transform(F.split(text, "\n"), lambda line, at: F.struct(
        at.alias("at"), F.xxhash64(line).alias("id"),
        F.size(F.filter(F.split(line, _BLANKS), lambda word: word != "")).alias("words")))
    return F.filter(split, lambda line: line["words"] > 0)


def _doubled(lines: Column, levels: int) -> Column:
    """Level ``k``: name and words of the run of ``2 ** k`` lines at each line; null beyond the end."""
    def next_level(known: Column, k: Column) -> Column:
        half = F.shiftleft(F.lit(1), k) if isinstance(k, int) else F.pow(F.lit(2), k).cast("int")
        return bound(F.element_at(known, -1), lambda last: F.concat(known, F.array(F.transform(
            last, lambda run, at: F.struct(
                F.when(at + half < F.size(last), F.xxhash64(run["id"], F.get(last, at + half)["id"])).alias("id"),
                (run["words"] + F.get(last, at + half)["words"]).alias("words"))))))

    first = F.array(F.transform(lines, lambda line: F.struct(line["id"].alias("id"), line["words"].alias("words"))))
    return F.aggregate(F.sequence(F.lit(0), F.lit(levels - 2)), first, next_level) if levels > 1 else first


def _shortest_runs(lines: Column, min_words: int) -> Column:
    """For each line the shortest run that starts there with at least ``min_words`` words: first and
    last place in the text, and name; runs that the text is too short for are left out."""
    levels = max(1, (min_words - 1).bit_length())  # every line has a word, so a run has min_words lines at most

    def descend(known: Column, at: Column) -> Column:
        start = F.struct(F.lit(0).alias("length"), F.lit(0).alias("words"), F.lit(0).cast("long").alias("id"))

        def step(state: Column, k: Column) -> Column:
            run = F.get(F.get(known, k), at + state["length"])
            longer = F.struct(
                (state["length"] + F.pow(F.lit(2), k).cast("int")).alias("length"),
                (state["words"] + run["words"]).alias("words"), F.xxhash64(state["id"], run["id"]).alias("id"))
            return F.when(run["id"].isNotNull() & (state["words"] + run["words"] < min_words), longer).otherwise(state)

        return F.aggregate(F.sequence(F.lit(levels - 1), F.lit(0)), start, step)

    def runs(given: Column) -> Column:
        return bound(_doubled(given, levels), lambda known: F.transform(given, lambda line, at: bound(
            descend(known, at), lambda state: F.struct(
                line["at"].alias("first"), F.get(given, at + state["length"])["at"].alias("last"),
                F.xxhash64(state["id"], F.get(F.get(known, F.lit(0)), at + state["length"])["id"],
                           state["length"]).alias("name")))))

    return bound(lines, lambda given: F.filter(runs(given), lambda run: run["last"].isNotNull()))


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc, version, first, last``: the runs of lines, counted from 0, that repeat an earlier text.

    ``doc`` is the id and ``version`` a hash of the text.  Earlier means a
    smaller id, or an earlier line of the same text.  Rows without id come
    after all others.  Runs that meet or overlap are given as one.
    """
    rows = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("version"), _lines(F.col("text")).alias("lines"))
    ways = rows.select("doc_id", "version", F.explode(F.array(
        F.struct(F.lit(0).alias("back"), F.col("lines").alias("lines")),
        F.struct(F.lit(1).alias("back"), F.reverse("lines").alias("lines")))).alias("way"))
    found = ways.select(
        "doc_id", "version", F.col("way.back").alias("back"),
        F.explode(_shortest_runs(F.col("way.lines"), min_words)).alias("run"))
    place = F.coalesce(F.col("doc_id"), F.lit(2 ** 63 - 1)).cast("decimal(20,0)") * F.lit(2 ** 31).cast("decimal(10,0)")
    runs = found.select(
        "doc_id", "version", F.least("run.first", "run.last").alias("first"), F.greatest("run.first", "run.last").alias("last"),
        F.xxhash64("back", "run.name").alias("name"),
        (place + F.least("run.first", "run.last").cast("decimal(10,0)")).cast("decimal(32,0)").alias("place"))
    earliest = runs.groupBy("name").agg(F.min("place").alias("earliest"), F.max("place").alias("latest"))
    earliest = earliest.where("earliest < latest").select("name", "earliest")
    later = runs.join(earliest, "name").where("place > earliest").select("doc_id", "version", "first", "last")

    key = [F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), F.col("version")]
    ordered = Window.partitionBy(*key).orderBy("first", "last")
    reach = F.max("last").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    islands = later.distinct().withColumn("new", F.when(F.col("first") <= reach + 1, 0).otherwise(1)).withColumn(
        "island", F.sum("new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy("doc_id", "version", "island").agg(
        F.min("first").alias("first"), F.max("last").alias("last")).drop("island")


def delete_repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies of line runs of ``min_words`` words or more taken out of ``text``.

    Adds ``n_lines`` and ``n_deleted``, the numbers of lines before, and of
    those taken out.  All other columns stay.  Null texts stay null with no
    lines; empty texts have one line.  Rows that repeat both id and text get the
    same result; blank lines do not break a run, and go with it when they lie in it.
    """
    ranges = (
        repeated_runs(docs, min_words)
        .groupBy("doc_id", "version").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("__run_runs"))
        .select(F.coalesce("doc_id", F.lit(0)).alias("__run_doc"), F.col("doc_id").isNull().alias("__run_none"),
                F.col("version").alias("__run_version"), "__run_runs")
    )
    keyed = docs.drop("n_lines", "n_deleted").withColumns({
        "__run_doc": F.coalesce(F.col("doc_id"), F.lit(0)), "__run_none": F.col("doc_id").isNull(), "__run_version": F.xxhash64("text")})
    joined = keyed.join(ranges, ["__run_doc", "__run_none", "__run_version"], "left")
    runs, lines = F.col("__run_runs"), F.split("text", "\n")

    def kept(all_lines: Column) -> Column:
        between = F.transform(runs, lambda run, at: bound(
            F.when(at == 0, 0).otherwise(F.get(runs, at - 1)["last"] + 1),
            lambda start: F.slice(all_lines, start + 1, F.greatest(F.lit(0), run["first"] - start))))
        end = F.element_at(runs, -1)["last"] + 1
        tail = F.slice(all_lines, end + 1, F.greatest(F.lit(0), F.size(all_lines) - end))
        return F.array_join(F.flatten(F.concat(between, F.array(tail))), "\n")

    deleted = F.aggregate(runs, F.lit(0), lambda total, run: total + run["last"] - run["first"] + 1)
    return joined.withColumns({
        "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)),
        "n_deleted": F.coalesce(deleted, F.lit(0)),
        "text": F.when(runs.isNull(), F.col("text")).otherwise(bound(lines, kept)),
    }).drop("__run_runs", "__run_doc", "__run_none", "__run_version")
