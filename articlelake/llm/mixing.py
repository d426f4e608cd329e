"""Mixing sources to target weights: raked token weights and a sample with calibrated chances.

Documents are counted into cells of source, language and topic, and only the cells are raked:
iterative proportional fitting scales them to one marginal after the other until all are met.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articlelake.session import settle

NONE = "(none)"  # a null value of a marginal
TEMPER = 0.85
TOLERANCE = 1e-6
SWEEPS = 60
SEED = 17
# cells that may be broadcast
SMALL = 200_000


def n_words(text: str = "text") -> Column:
    """Words between white space, as the measure of tokens; 0 for null."""
    trimmed = F.trim(F.regexp_replace(F.col(text), r"\s+", " "))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", 0).otherwise(F.size(F.split(trimmed, " "))).cast("long")


def topic_of(text: str = "text") -> Column:
    """A coarse topic by what the text holds: licence terms, contact data, tables, or else prose."""
    lower = F.lower(F.coalesce(F.col(text), F.lit("")))
    return (
        F.when(lower.contains("licen") | lower.contains("copyright"), "licence")
        .when(lower.contains("@") | lower.contains("password"), "contact")
        .when(lower.contains(" | "), "table").otherwise("prose")
    )


def tempered(cells: DataFrame, name: str, temper: float) -> DataFrame:
    """Target shares of a marginal: its observed token shares to the power ``temper``, made to add to 1.

    1 keeps the marginal, 0 evens it out.  Values without tokens get none.
    """
    seen = cells.groupBy(name).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    power = F.pow(F.col("tokens").cast("double"), F.lit(float(temper)))
    total = seen.agg(F.sum(power)).first()[0]  # one number
    return seen.select(name, (power / F.lit(float(total or 1.0))).alias("target"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], tolerance: float = TOLERANCE, sweeps: int = SWEEPS) -> DataFrame:
    """Add ``ratio`` to ``cells``: by how much the tokens of a cell count, so that all marginals are met.

    ``targets`` has a table ``(name, target)`` for each marginal; a value that it
    does not name has target 0, and values without tokens are left alone.
    Sweeps end when every marginal is met up to ``tolerance`` or after
    ``sweeps``; marginals that contradict each other are met as far as they can
    be.  Each sweep is a small table in the shared folder.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0.0)
    state = settle(cells.withColumn("ratio", F.lit(1.0)))
    if not total:
        return state
    for _ in range(sweeps):
        off = None
        for name, target in targets.items():
            now = state.groupBy(name).agg(F.sum(F.col("tokens") * F.col("ratio")).alias("_now"))
            factor = now.join(target, name, "left").select(
                name, F.when(F.col("_now") > 0, F.coalesce("target", F.lit(0.0)) * total / F.col("_now"))
                .otherwise(1.0).alias("_factor"))
            state = state.join(factor, name).withColumn("ratio", F.col("ratio") * F.col("_factor"))
            worst = F.abs(F.col("_factor") - 1)
            off = worst if off is None else F.greatest(off, worst)
            state = state.withColumn("_off", off).drop("_factor")
            off = F.col("_off")
        state = settle(state)
        done = state.agg(F.max("_off")).first()[0] <= tolerance
        state = state.drop("_off")
        if done:
            break
    return state


def mixed(
    docs: DataFrame, dims: Mapping[str, Column], tokens: Column, temper: Mapping[str, float] | None = None,
    targets: Mapping[str, DataFrame] | None = None, seed: int = SEED,
) -> DataFrame:
    """Every row of ``docs`` with ``n_tokens, weight, probability, kept``.

    ``dims`` names the marginals and how to read them from a row.  Targets are
    given, or tempered from what is observed (``TEMPER`` where nothing is said).
    ``weight`` is the raked weight of a token; ``probability`` is the weight over
    the largest one, so that the expected tokens of the kept rows have the
    target marginals; ``kept`` follows from a hash of id and text, the same on
    every run and for repeated rows.  Null values of a marginal are a value of
    their own; a row without tokens has the weight of its cell.
    """
    inner = {name: f"__mix_{name}" for name in dims}
    names = list(inner.values())
    keyed = docs.drop("n_tokens", "weight", "probability", "kept").withColumns(
        {inner[name]: F.coalesce(column.cast("string"), F.lit(NONE)) for name, column in dims.items()})
    keyed = keyed.withColumn("n_tokens", tokens)
    cells = settle(keyed.groupBy(*names).agg(F.sum("n_tokens").alias("tokens")))
    wanted = dict(targets or {})
    for name in dims:
        if name not in wanted:
            wanted[name] = tempered(cells, inner[name], (temper or {}).get(name, TEMPER))
        else:
            wanted[name] = wanted[name].withColumnRenamed(name, inner[name])
    raked = rake(cells, {inner[name]: settle(target) for name, target in wanted.items()})
    most = raked.where("tokens > 0").agg(F.max("ratio")).first()[0] or 1.0
    ratios = raked.select(*names, F.col("ratio").alias("weight"))
    if ratios.count() <= SMALL:  # a checked size; beyond it, the join decides
        ratios = F.broadcast(ratios)
    chance = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.xxhash64("text"), F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    return (
        keyed.join(ratios, names).withColumn("probability", F.least(F.lit(1.0), F.col("weight") / F.lit(float(most))))
        .withColumn("kept", chance < F.col("probability")).drop(*names)
    )


def by_source_language_topic(docs: DataFrame, temper: Mapping[str, float] | None = None, measure: Sequence[str] = ("text",)) -> DataFrame:
    """``mixed`` for the marginals source, language and topic of a document table; topics keep their shares."""
    dims = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic_of(measure[0])}
    return mixed(docs, dims, n_words(measure[0]), {"topic": 1.0, **(temper or {})})
