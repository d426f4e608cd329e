import numpy as np
from pyspark.sql import functions as F

from articlelake.llm import mixing

SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, weight string, kept int"


def table(spark, n=3000):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(n):
        source = "hot" if i % 3 else f"s{i % 7}"
        text = "w " * int(rng.integers(0, 40)) + ("licence" if i % 11 == 0 else "a | b" if i % 13 == 0 else "")
        rows.append((i, text, source if i % 50 else None, ["en", "en", "de", None][i % 4], 1, "x", 5))
    rows += [(None, "no id here", "s1", "en", 1, "x", 5), (7, None, "s2", "de", None, None, None), rows[5], rows[5]]
    return spark.createDataFrame(rows, SCHEMA)


def rake(cells, targets, sweeps=300):
    """Iterative proportional fitting on a dictionary of cells."""
    weight = {cell: float(tokens) for cell, tokens in cells.items()}
    total = sum(weight.values())
    for _ in range(sweeps):
        for dim, target in enumerate(targets):
            now = {}
            for cell, w in weight.items():
                now[cell[dim]] = now.get(cell[dim], 0) + w
            weight = {c: w * target.get(c[dim], 0) * total / now[c[dim]] if now[c[dim]] else w for c, w in weight.items()}
    return {c: w / cells[c] if cells[c] else None for c, w in weight.items()}


def test_equals_brute_force(spark):
    out = mixing.by_source_language_topic(table(spark)).withColumn("topic", mixing.topic_of()).collect()
    assert len(out) == 3004
    cells = {}
    for r in out:
        cell = (r.source or mixing.NONE, r.lang or mixing.NONE, r.topic)
        assert r.n_tokens == len((r.text or "").split())
        cells[cell] = cells.get(cell, 0) + r.n_tokens
    total, targets = sum(cells.values()), []
    for dim, temper in enumerate((mixing.TEMPER, mixing.TEMPER, 1.0)):
        seen = {}
        for cell, tokens in cells.items():
            seen[cell[dim]] = seen.get(cell[dim], 0) + tokens
        power = {v: t ** temper for v, t in seen.items() if t}
        targets.append({v: p / sum(power.values()) for v, p in power.items()})
    want = rake(cells, targets)
    most = max(r for c, r in want.items() if r is not None)
    for r in out:
        ratio = want[(r.source or mixing.NONE, r.lang or mixing.NONE, r.topic)]
        if ratio is not None:
            assert abs(r.weight - ratio) < 1e-4 and abs(r.probability - ratio / most) < 1e-4
    for dim, name in enumerate(("source", "lang")):  # the marginals are met
        got = {}
        for r in out:
            got[getattr(r, name) or mixing.NONE] = got.get(getattr(r, name) or mixing.NONE, 0) + r.weight * r.n_tokens
        assert all(abs(got[v] / total - share) < 1e-5 for v, share in targets[dim].items())
    # the sample has the calibrated size, up to chance
    expected, spread = sum(r.probability for r in out), sum(r.probability * (1 - r.probability) for r in out) ** 0.5
    assert abs(sum(r.kept for r in out) - expected) < 5 * spread


def test_sample_is_the_same_on_every_run(spark):
    kept = [sorted(str(r) for r in mixing.by_source_language_topic(table(spark, 300)).where("kept").select(
        "doc_id", "text").collect()) for _ in range(2)]
    assert kept[0] == kept[1] and kept[0]


def test_given_targets(spark):
    docs = spark.createDataFrame([(i, "w w", "a" if i < 90 else "b", "en") for i in range(100)], "doc_id long, text string, source string, lang string")
    target = spark.createDataFrame([("a", 0.5), ("b", 0.5)], "source string, target double")
    out = mixing.mixed(docs, {"source": F.col("source")}, mixing.n_words(), targets={"source": target})
    got = {r.source: (r.weight, r.probability) for r in out.collect()}
    assert np.allclose(got["a"], (5 / 9, 1 / 9)) and np.allclose(got["b"], (5, 1))
    only = spark.createDataFrame([("b", 1.0)], "source string, target double")
    out = mixing.mixed(docs, {"source": F.col("source")}, mixing.n_words(), targets={"source": only})
    assert {r.source for r in out.where("kept").collect()} == {"b"}


def test_empty_tables(spark):
    assert mixing.by_source_language_topic(table(spark).where("false")).count() == 0
    blank = mixing.by_source_language_topic(table(spark).withColumn("text", F.lit(""))).collect()
    assert all(r.kept and r.n_tokens == 0 for r in blank)
