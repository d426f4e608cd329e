"""Column rules, against Python's own and against hand-made cases."""

import datetime as dt
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from articlelake import fixed_values as fixed
from articlelake.functions import text as tx


def values(spark, texts, column):
    frame = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, x string")
    return [r.y for r in frame.select("n", column.alias("y")).orderBy("n").collect()]


TEXTS = st.lists(st.one_of(st.none(), st.text(max_size=9), st.from_regex(r"\A\d{1,9}\Z")), min_size=30, max_size=60)
FEW = settings(max_examples=8, deadline=None)


@FEW
@given(TEXTS)
def test_zero_pad_is_never_shorter(spark, texts):
    texts = [t if t is None else re.sub(r"[\ud800-\udfff]", "", t) for t in texts]
    found = values(spark, texts, tx.zero_pad(F.col("x"), 6))
    assert found == [t if t is None else t.rjust(6, "0") for t in texts]


@FEW
@given(TEXTS)
def test_strip_like_python(spark, texts):
    texts = [t if t is None else " \n\t  " + re.sub(r"[\ud800-\udfff]", "", t) + "\r\x1c " for t in texts]
    assert values(spark, texts, tx.strip(F.col("x"))) == [t if t is None else t.strip() for t in texts]


@pytest.mark.parametrize("link, key", [
    ("http://h/dhq/vol/17/2/000664/000664.html", ("17", "2", "000664")),
    ("http://h/dhq/vol/17/2/000664/000664.html?x=1", ("17", "2", "000664")),
    ("http://h/dhq/vol/17/2/000664/000665.html", (None, None, None)),
    ("http://h/dhq/vol/17/2/664/6640.html", (None, None, None)),
    ("http://h/dhq/preview/000664.html", (None, None, None)),
    ("http://h/vol/1/1/5/5.html/vol/2/3/6/6.html", ("2", "3", "6")),
    ("http://h/dhq/vol///7/7.html", ("", "", "7")),
    ("", (None, None, None)), (None, (None, None, None)),
])
def test_article_key(spark, link, key):
    frame = spark.createDataFrame([(link,)], "link string")
    assert tuple(frame.select(*tx.article_key(F.col("link"))).first()) == key


@pytest.mark.parametrize("text, day", [
    ("3 May 2010", "2010-05-03"), ("03 May 2010", "2010-05-03"), ("3 February 2022", "2022-02-03"),
    ("12 Sep 2009", "2009-09-12"), ("May 2010", "2010-05-01"), ("May 3, 2010", "2010-05-03"),
    ("2010-05-03", "2010-05-03"),
    ("May 3 2010", "2010-05-03"), ("3-May-2010", "2010-05-03"), ("2010/5/3", "2010-05-03"), ("5/3/2010", "2010-05-03"),
    ("2010-05", "2010-05-01"), ("2010", "2010-01-01"), (" 3 May 2010 ", "2010-05-03"),
    ("2010-05-03 10:11:12", "2010-05-03"), ("2010-05-03T10:11:12", "2010-05-03"),
    ("Winter 2022", None), ("31 February 2010", None), ("", None), (None, None), ("3 Feburary 2022", None),
])
def test_parse_date(spark, text, day):
    assert values(spark, [text], F.date_format(tx.parse_date(F.col("x")), "yyyy-MM-dd")) == [day]


def test_date_shapes_turn_away_no_date(spark):
    days = [dt.datetime(1999, 1, 1) + dt.timedelta(days=37 * n, seconds=7919 * n) for n in range(300)]
    frame = spark.createDataFrame([(d,) for d in days], "day timestamp")
    for date_format in fixed.DATE_FORMATS:
        written = frame.select(F.date_format("day", date_format).alias("x"))
        both = written.select(
            tx.parse_date(F.col("x"), [date_format]).alias("ours"),
            F.try_to_timestamp("x", F.lit(date_format)).alias("plain"))
        assert both.where("plain is null or not (ours <=> plain)").isEmpty(), date_format


def test_typo_then_date(spark):
    repaired = tx.replace_all(F.col("x"))
    assert values(spark, ["3 Feburary 2022", None], repaired) == ["3 February 2022", None]


def test_article_url(spark):
    frame = spark.createDataFrame([("017", "2", "000664"), ("017", None, "000664")], "v string, i string, a string")
    urls = [r.u for r in frame.select(
        tx.article_url("http://h", F.col("v"), F.col("i"), F.col("a")).alias("u")).collect()]
    assert urls == ["http://h/dhq/vol/017/2/000664/000664.html", None]


def test_json(spark):
    assert values(spark, ['[{"sha":"a"},{"sha":"b"}]', "[]", "oops", None], tx.json_first(F.col("x"), "sha")) == [
        "a", None, None, None]


def test_arrays(spark):
    frame = spark.createDataFrame([(["a", None, "b"],), ([],), (None,)], "x array<string>")
    found = frame.select(tx.join_texts(F.col("x")), tx.first_or(F.col("x"))).collect()
    assert [tuple(r) for r in found] == [("ab", "a"), ("", ""), (None, "")]
