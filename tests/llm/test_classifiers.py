import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from articlelake.llm import compression_quality, toxicity
from articlelake.llm.common import held_out, labelled_sample, read
from tests.llm.fixtures import documents, sentence

SF = "/root/testdata/sf0.1"
MODELS = (toxicity, compression_quality)


def scores(spark, module, model, texts):
    rows = module.score(documents(spark, enumerate(texts), "score", "predicted"), model).orderBy("doc_id").collect()
    assert all(row.predicted == 7 for row in rows)
    return [row.score for row in rows]


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    return {module: module.fit(docs, labels) for module in MODELS}


@pytest.mark.parametrize(("module", "label", "accuracy"), [(toxicity, "toxic", 0.9), (compression_quality, "quality", 0.95)])
def test_held_out_accuracy(spark, trained, module, label, accuracy):
    threshold = 0.3 if label == "toxic" else 0.7
    labelled = read(spark, SF, "documents").join(read(spark, SF, "labels"), "doc_id").where(held_out())
    rows = module.score(labelled, trained[module]).select(label, "score").collect()
    right = np.mean([(row.score >= threshold) == row[label] for row in rows])
    assert len(rows) > 500 and right >= accuracy
    assert all(0 <= row.score <= 1 for row in rows)


@pytest.mark.parametrize("module", MODELS)
def test_awkward_texts(spark, trained, module):
    texts = [None, "", " \n", "x", "word " * 100_000, "a" * 300_000, "%&/()", "日本語 " * 20, "퟿\U0001f600"]
    found = scores(spark, module, trained[module], texts)
    assert all(0 <= score <= 1 for score in found) and found[0] == found[1]
    assert scores(spark, module, trained[module], []) == []


def test_long_texts_are_read_to_the_end(spark, trained):
    rng = random.Random(1)
    long = " ".join(sentence(rng, 20) for _ in range(20_000))
    worst = trained[toxicity].margins([long, long + " you idiot, you moron", "you idiot, you moron"])
    assert worst[1] == worst[2] > worst[0]


def test_disguised_words_stay_close(trained):
    plain, spaced, inserted, clean = trained[toxicity].margins(["you moron", "you m.o.r.o.n", "you mor-on morxon", "a nice day"])
    assert plain == spaced and plain > inserted > clean


def test_text_is_all_that_counts(spark, trained):
    for module in MODELS:
        a, b = (module.score(documents(spark, [(i, "the same text")], "lang", "source"), trained[module]).first() for i in (1, 2))
        assert a.score == b.score


def test_sample_keeps_out_the_held_out_quarter(spark):
    docs = documents(spark, [(i, f"text {i}") for i in range(400)] + [(1, "again"), (None, "none"), (2, None), (3, "")])
    labels = spark.createDataFrame(
        [(i, i % 3 % 2, 9) for i in range(400)] + [(5, 1, 9), (5, 0, 9), (None, 1, 9), (6, None, 9), (7, 4, 9)], "doc_id long, toxic int, text int")
    sample, share = labelled_sample(docs, labels, "toxic", 50, 100)
    assert 0 < share < 1 and len(sample) == 100 and sum(label for _, label in sample) == 50
    ids = [int(text.split()[1]) for text, _ in sample if text != "again"]
    assert all(zlib.crc32(str(i).encode()) % 4 != 2 for i in ids)
    assert labelled_sample(docs, labels, "toxic", 50, 100) == (sample, share)
    flags = docs.select("doc_id", held_out().alias("out")).where("doc_id is not null").distinct().collect()
    assert all(row.out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2) for row in flags)


@pytest.mark.parametrize("module", MODELS)
def test_without_labels_every_score_is_the_share(spark, module):
    docs = documents(spark, [(1, "a text"), (2, None)])
    for rows in ([], [(1, 1, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int, quality int")
        label = "toxic" if module is toxicity else "quality"
        found = {row.score for row in module.score(docs, module.fit(docs, labels, label)).collect()}
        assert len(found) == 1 and 0 < found.pop() < 1
    assert docs.where(F.lit(False)).count() == 0
