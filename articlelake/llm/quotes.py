"""Quotation linking: quoted passages lead from a reply to the message that it answers.

Lines that start with ``>`` are quoted, as deep as they have such marks.  A message without its
quotes and attribution lines is what its author wrote.  Its paragraphs, its lines and the whole of it
are normalised and hashed, so line breaks do not matter; a quoted passage is joined to the earliest
message that wrote it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articlelake.llm.common import MAX_ROUNDS, bound
from articlelake.session import settle

# Character classes only: a repeated group would recurse once for each mark of a long row of them.
_QUOTED = r"^[ \t]{0,3}>"
_MARKS = r"^[ \t]{0,3}>[ \t>]*"
_BLANK = r"\r?\n[ \t]*\r?\n"  # between paragraphs
_ATTRIBUTION = r"(?i)^[ \t>]*(on .{1,200} wrote:|.{1,120} (wrote|said|schrieb|a écrit|escribió):)[ \t]*$"


def quote_level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 0), "[^>]", ""))


def _parsed(text: Column) -> Column:
    """The lines as ``level, body, attribution``."""
    return F.transform(F.split(text, r"\r?\n"), lambda line: F.struct(
        quote_level(line).alias("level"), F.regexp_replace(line, _MARKS, "").alias("body"),
        line.rlike(_ATTRIBUTION).alias("attribution")))


def _has_marks() -> Column:
    return F.coalesce(F.col("text").rlike(r"(?m)^[ \t]{0,3}>"), F.lit(False))


def without_quotes(text: str = "text") -> Column:
    """What the author wrote: unquoted lines; attribution lines go if a quote follows somewhere."""
    lines = _parsed(F.col(text))
    own = F.filter(lines, lambda line: (line["level"] == 0) & ~line["attribution"])
    joined = F.array_join(F.transform(own, lambda line: line["body"]), "\n")
    return F.when(_has_marks(), F.regexp_replace(F.regexp_replace(joined, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")).otherwise(F.col(text))


def normalised(passage: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(passage), r"[^\p{L}\p{N}]+", " "))


def _passages(text: Column) -> Column:
    """Normalised paragraphs and lines of a text, and the whole of it."""
    parts = F.concat(F.array(text), F.split(text, _BLANK), F.split(text, r"\n"))
    return F.array_distinct(F.filter(F.transform(parts, normalised), lambda p: p != ""))


def quoted_passages() -> Column:
    """``level, passage`` of the quoted runs of lines of one level: each line, each paragraph, and the run as a whole."""
    # lines without marks part the runs; inside a run, lines of one level belong together
    gap = "\x00"
    marked = F.transform(F.split("text", r"\r?\n"), lambda line: F.when(line.rlike(_QUOTED), line).otherwise(gap))
    runs = F.filter(F.split(F.array_join(marked, "\n"), gap), lambda run: run.contains(">"))

    def parts(lines: Column) -> Column:
        levels = F.array_distinct(F.transform(lines, lambda line: line["level"]))
        whole = F.transform(levels, lambda level: F.struct(level.alias("level"), F.array_join(F.transform(
            F.filter(lines, lambda line: line["level"] == level), lambda line: line["body"]), "\n").alias("passage")))
        # empty lines and lines of other levels part paragraphs
        paragraphs = F.flatten(F.transform(levels, lambda level: F.transform(F.split(F.array_join(F.transform(
            lines, lambda line: F.when(line["level"] == level, line["body"]).otherwise("")), "\n"), _BLANK),
            lambda passage: F.struct(level.alias("level"), passage.alias("passage")))))
        each = F.transform(lines, lambda line: F.struct(line["level"].alias("level"), line["body"].alias("passage")))
        return F.transform(F.concat(whole, paragraphs, each), lambda part: F.struct(
            part["level"].alias("level"), normalised(part["passage"]).alias("passage")))

    def of_run(run: Column) -> Column:
        marked = F.filter(_parsed(run), lambda line: (line["level"] > 0) & ~line["attribution"])
        return bound(marked, parts)

    return F.filter(F.flatten(F.transform(runs, of_run)), lambda part: part["passage"] != "")


def linked_messages(messages: DataFrame) -> DataFrame:
    """Each message with its own words, its quote depth and the message that it answers.

    ``messages`` holds ``conv_id, turn, role, text``.  Adds ``body`` (the text
    without quotes), ``n_levels``, ``reply_conv`` and ``reply_turn`` (null
    without a quote whose author is found), and ``reply_path``, the turns from the
    first message of the thread to this one: rows in the order of
    ``conv_id, reply_path`` are a conversation in which answers follow what they
    answer.  A passage is taken from an earlier turn of the same conversation
    if one wrote it, else from the earliest message of a conversation with a
    smaller id.  The outermost level decides, then the longer passage.  Null
    texts quote nothing; rows without ``conv_id`` or ``turn`` are linked with
    nothing; rows that repeat both are one message with each of its texts.
    """
    messages = messages.select("conv_id", "turn", "role", "text")
    known = messages.where("conv_id is not null and turn is not null and text is not null")
    quoting = known.where(_has_marks()).select("conv_id", "turn", F.explode(quoted_passages()).alias("q")).select(
        "conv_id", "turn", F.col("q.level").alias("level"), F.length("q.passage").alias("length"),
        F.xxhash64("q.passage").alias("hash")).distinct()
    quoting = settle(quoting)
    written = known.select("conv_id", "turn", F.explode(_passages(without_quotes())).alias("passage")).select(
        "conv_id", "turn", F.xxhash64("passage").alias("hash"))
    # only passages that someone quotes; one row for each passage and conversation, combined before the shuffle
    asked = quoting.select("hash").distinct()
    first = settle(written.join(asked, "hash", "left_semi").groupBy("hash", "conv_id").agg(F.min("turn").alias("source_turn")))
    anywhere = first.groupBy("hash").agg(F.min(F.struct("conv_id", "source_turn")).alias("other"))
    here = first.select("hash", "conv_id", F.col("source_turn").alias("here"))
    found = quoting.join(here, ["hash", "conv_id"], "left").join(anywhere, "hash", "left")
    target = (
        F.when(F.col("here") < F.col("turn"), F.struct(F.col("conv_id").alias("conv_id"), F.col("here").alias("source_turn")))
        .when(F.col("other.conv_id") < F.col("conv_id"), F.col("other"))
    )
    links = settle(
        found.withColumn("target", target).where("target is not null").groupBy("conv_id", "turn")
        .agg(F.max(F.struct(-F.col("level"), F.col("length"), (-F.col("target.conv_id")).alias("c"),
                            F.col("target.source_turn").alias("t"))).alias("best"))
        .select("conv_id", "turn", (-F.col("best.c")).alias("reply_conv"), F.col("best.t").alias("reply_turn")))
    depth = quoting.groupBy("conv_id", "turn").agg(F.max("level").alias("n_levels"))
    paths = _paths(links)
    keys = ["conv_id", "turn"]
    out = messages.withColumn("body", without_quotes())
    out = out.join(depth, keys, "left").join(links, keys, "left").join(paths, keys, "left")
    return out.select(
        "conv_id", "turn", "role", "body", F.coalesce("n_levels", F.lit(0)).alias("n_levels"), "reply_conv", "reply_turn",
        F.coalesce("reply_path", F.array("turn")).alias("reply_path"))


def _paths(links: DataFrame) -> DataFrame:
    """``conv_id, turn, reply_path`` of the messages that answer one of their own conversation.

    Each round joins every path to the path of its first message, so paths of
    any length take a number of rounds that is the logarithm of it.
    """
    inside = links.where("reply_conv = conv_id")
    paths = settle(inside.select("conv_id", "turn", F.array("reply_turn", "turn").alias("reply_path")))
    for _ in range(MAX_ROUNDS):
        head = paths.select("conv_id", F.col("turn").alias("_head"), F.slice(
            "reply_path", 1, F.size("reply_path") - 1).alias("_before"))
        joined = paths.withColumn("_head", F.col("reply_path")[0]).join(head, ["conv_id", "_head"], "left")
        longer = settle(joined.select(
            "conv_id", "turn", F.when(F.col("_before").isNotNull(), F.concat("_before", "reply_path"))
            .otherwise(F.col("reply_path")).alias("reply_path"), F.col("_before").isNotNull().alias("_grew")))
        paths = longer.drop("_grew")
        if longer.where("_grew").isEmpty():
            return paths
    raise RuntimeError(f"paths still grew after {MAX_ROUNDS} rounds")


def chat(messages: DataFrame) -> DataFrame:
    """``linked_messages`` with ``formatted``: role and body in one text, null bodies as empty ones."""
    role = F.coalesce("role", F.lit("user"))
    return linked_messages(messages).withColumn(
        "formatted", F.concat(F.lit("<|"), role, F.lit("|>\n"), F.coalesce("body", F.lit("")), F.lit("\n")))
