"""Cleaning operators against brute force, with hot and null keys, on large- and small-table plans."""

import random

import pytest
from pyspark.sql import functions as F

from articlelake.operators import joins, repair
from articlelake.session import settle
from tests.conftest import plan, rows


@pytest.fixture(scope="module")
def articles(spark):
    """Versions of articles: one id and one issue hold a third of the rows, some keys are null."""
    pick = random.Random(5)
    data = []
    for n in range(600):
        hot = pick.random() < 1 / 3
        data.append((
            f"d/{n:04d}.xml", None if n % 50 == 0 else "hot" if hot else f"a{pick.randrange(150)}",
            None if n % 23 == 0 else "hot" if hot else str(pick.randrange(12)),
            None if n % 29 == 0 else "hot" if hot else str(pick.randrange(4)),
            pick.choice([None, "9 May 2020", "10 May 2021", "1 June 2019"]),
            pick.choice([None, None, "2020-01-01", "2021-05-05"]),
            pick.choice([None, "t1", "t2", "t3"]),
        ))
    schema = "file_name string, article_id string, volume string, issue string, date_when string, day string, title string"
    frame = spark.createDataFrame(data, schema).repartition(7)
    return data, frame.withColumn("date_processed", F.to_timestamp("day"))


def newest(data, by):
    best = {}
    for row in sorted(data, key=lambda r: r[0]):
        key, date = row[1], row[by] or ""
        if key is not None and (key not in best or date > (best[key][by] or "")):
            best[key] = row
    return sorted(r[0] for r in best.values())


@pytest.mark.parametrize("by, at", [("date_when", 4), ("day", 5)])
def test_latest_per_key(articles, by, at):
    data, frame = articles
    found = repair.latest_per_key(frame, by=by)
    assert sorted(r.file_name for r in found.collect()) == newest(data, at)
    assert rows(repair.latest_per_key(found, by=by)) == rows(found)


def test_latest_by_text_is_not_latest_by_date(spark):
    frame = spark.createDataFrame(
        [("1", "x", "9 May 2020", "2020-05-09"), ("2", "x", "10 May 2021", "2021-05-10")],
        "file_name string, article_id string, date_when string, day string")
    assert repair.latest_per_key(frame).first().file_name == "1"
    assert repair.latest_per_key(frame, by="day").first().file_name == "2"


def test_latest_limits_each_task_before_the_shuffle(articles):
    text = plan(repair.latest_per_key(articles[1]))
    before, after = text.rindex("WindowGroupLimit"), text.index("WindowGroupLimit")
    assert after < text.index("Exchange") < before


def groups(data):
    found = {}
    for row in data:
        found.setdefault(row[2:4], []).append(row)
    return found


def fill_expected(data):
    expected = {}
    for key, members in groups(data).items():
        latest = max((r[5] for r in members if r[5]), default=None)
        for row in members:
            expected[row[0]] = row[5] or (None if None in key else latest)
    return expected


@pytest.mark.parametrize("hot_keys", [1, 1024])
@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_fill_from_group(spark, articles, monkeypatch, hot_keys, broadcast):
    monkeypatch.setattr(joins, "HOT_KEYS", hot_keys)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        data, frame = articles
        filled = repair.fill_from_group(frame).select("*", F.date_format("date_processed", "yyyy-MM-dd").alias("d"))
        found = filled.collect()
        assert filled.drop("d").columns == frame.columns
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r.file_name: r.d for r in found} == fill_expected(data) and len(found) == len(data)


def share_expected(data, mode):
    expected = {}
    for key, members in groups(data).items():
        titles = [r[6] for r in sorted(members, key=lambda r: (r[1] is not None, r[1], r[0])) if r[6]]
        for row in members:
            first = titles[0] if titles else None
            if None in key:
                expected[row[0]] = row[6]
            else:
                expected[row[0]] = first if mode == "overwrite" else row[6] or first
    return expected


@pytest.mark.parametrize("hot_keys", [1, 1024])
@pytest.mark.parametrize("mode", ["overwrite", "fill"])
def test_share_in_group(articles, monkeypatch, no_broadcast, hot_keys, mode):
    monkeypatch.setattr(joins, "HOT_KEYS", hot_keys)
    data, frame = articles
    found = repair.share_in_group(frame, ["title"], mode=mode).collect()
    assert {r.file_name: r.title for r in found} == share_expected(data, mode) and len(found) == len(data)


def test_share_makes_groups_constant_and_ignores_row_order(articles):
    _, frame = articles
    once = repair.share_in_group(frame, ["title"])
    distinct = once.dropna(subset=["volume", "issue"]).groupBy("volume", "issue").agg(F.countDistinct("title").alias("n"))
    assert distinct.where("n > 1").isEmpty()
    assert rows(repair.share_in_group(frame.repartition(3, "title"), ["title"])) == rows(once)


def test_share_rejects_unknown_mode(articles):
    with pytest.raises(ValueError):
        repair.share_in_group(articles[1], ["title"], mode="other")


def test_overrides_and_defaults(spark):
    frame = spark.createDataFrame(
        [("x/000664.xml", "001", None), ("000664.xml/other.xml", None, "2"), ("other.xml", "3", "4")],
        "file_name string, volume string, issue string")
    fixed = repair.default_unassigned(repair.apply_overrides(frame, repair.default_overrides(spark)))
    assert fixed.columns == frame.columns
    assert rows(fixed) == [("000664.xml/other.xml", "yet to be assigned", "2"), ("other.xml", "3", "4"),
                           ("x/000664.xml", "016", "4")]


def test_default_overrides_are_small_enough_to_broadcast(spark, articles):
    text = plan(repair.apply_overrides(settle(articles[1]), repair.default_overrides(spark)))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_fill_links(spark, no_broadcast):
    base = "http://h"
    url = base + "/dhq/vol/001/2/{0}/{0}.html"
    frame = spark.createDataFrame(
        [("1", "001", "2", "a", None), ("2", "001", "2", "b", None), ("3", "001", "2", "c", None),
         ("4", "001", "2", "d", None), ("5", "001", "2", "a", "own"), ("6", None, "2", "a", None),
         ("7", "001", "2", "a", None)],
        "file_name string, volume string, issue string, article_id string, article_link string")
    crawl = spark.createDataFrame(
        [(url.format("a"), 200, "ok"), (url.format("a"), 200, None), (url.format("b"), 404, "ok"),
         (url.format("c"), 200, "x Resource Not Found y"), ("other", 200, "ok")],
        "url string, status int, html string")
    filled = {r.file_name: r.article_link for r in repair.fill_links(frame, crawl, base).collect()}
    assert filled == {"1": url.format("a"), "2": None, "3": None, "4": None, "5": "own", "6": None, "7": url.format("a")}


# --- joins ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def links(spark):
    data = [(f"l{n}", None if n % 7 == 0 else f"a{n % 160}", str(n % 12), str(n % 4), f"by {n}") for n in range(500)]
    return data, spark.createDataFrame(
        data, "article_link string, article_id string, volume string, issue string, authors string")


def test_join_links(articles, links, no_broadcast):
    data, frame = articles
    link_data, link_frame = links
    found = joins.join_links(frame, link_frame)
    expected = []
    for row in data:
        hits = [r for r in link_data if None not in row[1:4] and r[1:4] == row[1:4]]
        expected += [(row[0], r[0], r[4]) for r in hits] or [(row[0], None, None)]
    assert rows(found.select("file_name", "article_link", "scraped_authors")) == sorted(expected, key=repr)


def test_missing_and_present_make_up_the_input(articles, links, no_broadcast):
    _, frame = articles
    link_data, link_frame = links
    missing = joins.missing_articles(link_frame, frame)
    present = link_frame.join(frame.dropna(subset=["article_id"]), "article_id", "left_semi")
    assert rows(missing.select("article_link").union(present.select("article_link"))) == sorted((r[0],) for r in link_data)
    assert missing.where("article_id is null").count() == sum(r[1] is None for r in link_data)


def test_null_and_hot_keys_are_spread(articles, links, no_broadcast):
    """The rows that cannot match do not meet in one partition."""
    _, frame = articles
    text = plan(joins.keyed_left_join(frame, links[1], ["article_id"], ["file_name"]))
    exchanges = [line for line in text.splitlines() if "hashpartitioning" in line]
    assert len(exchanges) == 2 and all("_spread" in line for line in exchanges)


def test_hot_key_is_split_at_run_time(spark, no_broadcast):
    rows_ = settle(spark.range(60000).selectExpr(
        "concat('f', id) as file_name", "if(id % 3 = 0, 'hot', concat('a', id)) as article_id", "'1' as volume",
        "'1' as issue", "repeat('x', 50) as pad"))
    links_ = settle(spark.range(0, 60000, 7).selectExpr("concat('a', id) as article_id", "'1' as volume",
                                                        "'1' as issue", "concat('l', id) as article_link"))
    limits = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
              "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
              "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0"}
    before = {key: spark.conf.get(key) for key in limits}
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        joined = joins.join_links(rows_, links_)
        assert len(joined.collect()) == 60000
        assert "skew=true" in plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_hot_keys_of_other_joins_are_split(spark, no_broadcast):
    """Anti, mark and semi joins, with keys that may be null and keys that may not."""
    hot = settle(spark.range(60000).selectExpr(
        "concat('f', id) as file_name", "if(id % 5 > 0, 'hot', concat('a', id)) as k", "repeat('x', 50) as pad"))
    hot = hot.withColumn("k", F.when(F.col("k") != "", F.col("k")))
    sure = hot.withColumn("k", F.coalesce("k", F.lit("none")))
    others = settle(spark.range(0, 60000, 7).selectExpr("concat('a', id) as k").union(spark.range(3).selectExpr("'a0' as k")))
    limits = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
              "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
              "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0"}
    before = {key: spark.conf.get(key) for key in limits}
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        for frame in (hot, sure):
            for joined in (joins.keyed_anti_join(frame, others, "k", ["file_name"]),
                           joins.keyed_mark(frame, others, "k", "known", ["file_name"]),
                           joins.existing_links(frame, others.withColumnRenamed("k", "url"), "k")):
                joined.collect()
                assert "skew=true" in plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_repeated_corrections_give_one_row(spark):
    files = spark.createDataFrame([("c/1.xml", "1", "1"), ("c/2.xml", "1", "1")], "file_name string, volume string, issue string")
    fixes = spark.createDataFrame([("1.xml", "2", "3"), ("1.xml", "2", "4"), ("1.xml", "1", "9")], "base_name string, volume string, issue string")
    assert rows(repair.apply_overrides(files, fixes)) == [("c/1.xml", "2", "4"), ("c/2.xml", "1", "1")]


def test_small_lookup_needs_no_shuffle(articles):
    text = plan(repair.fill_from_group(articles[1].coalesce(1)))
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text


def test_only_the_bounded_hot_list_is_always_broadcast(articles, no_broadcast):
    tree = plan(repair.fill_from_group(articles[1]))
    assert tree.count("BroadcastHashJoin") == 1 and tree.count("SortMergeJoin") == 1
    assert "TakeOrderedAndProject" in tree


def test_no_cross_join_and_no_python(articles, links, no_broadcast):
    frame = settle(articles[1])
    for frame in (repair.latest_per_key(frame), repair.fill_from_group(frame), joins.join_links(frame, settle(links[1])),
                  joins.missing_articles(settle(links[1]), frame)):
        text = plan(frame)
        for unwanted in ("CartesianProduct", "NestedLoop", "Python", "MapInArrow"):
            assert unwanted not in text
