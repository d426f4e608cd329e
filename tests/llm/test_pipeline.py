import inspect
import random

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from articlelake.checks.compare import compare, oracle
from articlelake.llm import line_runs, mixing, ngram_join, toxicity
from articlelake.llm.common import read
from articlelake.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.test_ngram_join import scattered


def test_every_operator_has_one_query():
    assert [sum(name.startswith(f"op{n}_") for name in QUERIES) for n in range(1, 14)] == [1] * 13
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", [name for name in contract.oracle_sql() if name in QUERIES])
def test_query_equals_sql(spark, name):
    assert compare(spark, oracle(SMALL), SMALL, name, contract.queries(), contract.oracle_sql()) is None


def test_stages(spark):
    """Each stage keeps what it should of what the stage before it kept."""
    docs = read(spark, SMALL, "documents")
    rows = {None: docs.collect()}
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]
        docs = spark.createDataFrame(stage(spark, docs, SMALL).toPandas(), None if name == "byte-level BPE" else read(spark, SMALL, "documents").schema)
        frames[name], rows[name] = docs, docs.collect()
        if name != "byte-level BPE":
            assert docs.columns == corpus_pipeline.COLUMNS
    names = [None, *frames]
    for before, after in zip(names, names[1:], strict=False):
        assert {r.doc_id for r in rows[after]} <= {r.doc_id for r in rows[before]}
    model = toxicity.fit(read(spark, SMALL, "documents"), read(spark, SMALL, "labels"))
    assert all(score < 0.3 for score in model.scores([r.text for r in rows["toxicity"]]))
    assert line_runs.repeated_runs(frames["line dedup"]).count() == 0
    similar = ngram_join.similar_documents(frames["n-gram Jaccard join"])
    assert similar.where("component_id <> doc_id").count() == 0
    assert all(r.n_chars == len(r.text) for r in rows["line dedup"])
    mix = mixing.by_source_language_topic(frames["n-gram Jaccard join"]).where("kept")
    assert {r.doc_id for r in mix.collect()} == {r.doc_id for r in rows["mixing sources to target weights"]}
    assert len(rows["byte-level BPE"]) == len(rows["mixing sources to target weights"])


def test_awkward_documents(spark):
    schema = read(spark, SMALL, "documents").schema
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, text, None, None, None), (3, None, "en", "a", None),
            (4, "", "en", "a", 0), (None, "no id", "en", "a", 5), (None, None, None, None, None), (5, "short", "de", "b", 5)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        if name == "line dedup":
            assert 2 not in [r.doc_id for r in docs.collect()]
        if name == "n-gram Jaccard join":
            assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "3", "4", "5", "None", "None"]
    assert docs.count() <= 6
    empty = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SMALL)
    assert empty.count() == 0


def test_near_copies_from_a_five_word_share_of_08(spark):
    """46 to 56 words for each changed one: a three-word share below 0.9, a five-word one above 0.8."""
    rng = random.Random(5)
    kept, gone = scattered(rng, 9)
    apart = scattered(rng, 12)
    rows = [(1, kept, "en", "a", 1), (2, gone, "en", "a", 1), (3, apart[0], "en", "a", 1), (4, apart[1], "en", "a", 1)]
    docs = spark.createDataFrame(rows, read(spark, SMALL, "documents").schema)
    stage = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"]
    assert sorted(r.doc_id for r in stage(spark, docs, SMALL).collect()) == [1, 3, 4]
