"""Every registered query equals its SQL answer on the smallest tables."""

import pytest

import __spark_entry__ as contract
from articlelake.operators import html
from articlelake.operators.html import extract_html
from articlelake.operators.tei import extract_articles
from articlelake.session import _bytes, bound_batches, require_utc, session, shared_folder
from articlelake.checks.compare import compare, oracle
from articlelake.checks.duckdb_sql import ORACLES
from articlelake.checks.spark_queries import QUERIES
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def connection():
    return oracle(SMALL)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    assert compare(spark, connection, SMALL, name) is None


def test_every_query_has_an_answer():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    first, second = contract.entry(spark), contract.entry(spark)
    assert first.schema == second.schema and first.count() > 0


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark), shared_folder(spark)
    assert first.startswith(base.rstrip("/") + "/") and first != second


def test_batches_are_bounded_in_any_session(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    for before, after in (("1g", "64MB"), ("128m", "64MB"), ("1000", "1000"), ("8mb", "8mb")):
        spark.conf.set(key, before)
        bound_batches(spark)
        assert spark.conf.get(key) == after
    spark.conf.set(key, "64MB")


def test_documents_come_to_the_parse_in_small_batches(spark):
    """A parse holds several times what it reads, in each worker: its batches are smaller than those of other steps."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    for parse in (lambda t: extract_articles(t), lambda t: extract_html(t, {"link": html.PAGE_LINKS}, "content", ["path"])):
        spark.conf.set(key, "64MB")
        found = parse(spark.createDataFrame([("1.xml", "<a>x</a>")], "path string, content string"))
        assert _bytes(spark.conf.get(key)) <= 8 * 1024 ** 2 and found.count() == 1
    spark.conf.set(key, "64MB")


def test_entry_in_a_session_without_the_batch_setting(spark):
    """A plain session has no value of its own: Spark's default is read, never a given one."""
    import __spark_entry__

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    try:
        bound_batches(spark)
        assert __spark_entry__.entry(spark).count() >= 0
    finally:
        spark.conf.set(key, "64MB")


def test_time_zone_is_checked(spark):
    require_utc(spark)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_session_settings(spark):
    assert session().conf.get("spark.sql.session.timeZone") == "UTC"
    try:
        assert session(corpus_bytes=2 ** 40).conf.get("spark.sql.shuffle.partitions") == "4096"
        assert session(corpus_bytes=5).conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
