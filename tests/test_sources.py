"""Files and tables in temporary folders."""

import os
import time
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from articlelake import schemas
from articlelake.operators import manifests, unions
from articlelake.operators.tei import extract_articles, good_articles
from articlelake.session import settle
from articlelake.sources import crawl, tables, xml_files
from articlelake.streaming.ingest import ingest_stream
from tests.conftest import plan, rows
from tests.documents import BROKEN, DECLARATION, tei

KEPT = ["000664.xml", "000664/000665.xml", "old/000700.xml", "Old.xml", "deep/er/1.xml"]
LEFT_OUT = ["old1.xml", "000664_v1.xml", "sample.xml", "recovered.xml", "dhqx.xml", "converted.xml", "test1.xml",
            "walsh.xml", "999001.xml", "000000.xml", "note.txt", "A.XML", "deep/old.xml"]


def write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


@pytest.fixture
def folder(tmp_path):
    for n, name in enumerate(KEPT + LEFT_OUT):
        write(tmp_path / "in", name, tei(article_id=f"{n:06d}"))
    return tmp_path / "in"


def names(df, root, column="path"):
    return sorted(r[0].split(f"{root}/")[1] for r in df.select(column).collect())


def test_scan(spark, folder):
    files = xml_files.scan_xml_files(spark, str(folder))
    assert names(files, folder) == sorted(KEPT)
    assert files.columns == ["path", "modificationTime", "length", "content"]


def test_scan_to_articles(spark, folder):
    write(folder, "5.xml", BROKEN)
    write(folder, "6.xml", DECLARATION)
    parsed = extract_articles(xml_files.scan_xml_files(spark, str(folder)))
    assert {(r.status, r["count"]) for r in parsed.groupBy("status").count().collect()} == {
        ("ok", 5), ("malformed", 1), ("declaration_only", 1)}


def test_excluded_files_are_never_opened(spark, folder):
    unreadable = folder / "old1.xml"
    unreadable.unlink()
    os.symlink(Path("/nowhere"), folder / "old2.xml")
    text = plan(xml_files.scan_xml_files(spark, str(folder)))
    assert "file_name" in text and names(xml_files.scan_xml_files(spark, str(folder)), folder) == sorted(KEPT)


def test_new_files_only(spark, folder):
    everything = xml_files.scan_xml_files(spark, str(folder)).select(F.col("path").alias("file_name"))
    known = everything.where("file_name like '%000664.xml' or file_name like '%deep%'")
    new = xml_files.scan_new_xml_files(spark, str(folder), known)
    assert names(new, folder) == ["000664/000665.xml", "Old.xml", "old/000700.xml"]
    assert new.where("length <> octet_length(content)").isEmpty()
    assert xml_files.scan_new_xml_files(spark, str(folder), everything).isEmpty()


def test_anti_join_before_the_parse(spark, folder):
    files = xml_files.scan_xml_files(spark, str(folder))
    known = files.select("path").where("path like '%deep%'")
    new = unions.not_yet_processed(files, known, "path")
    assert names(new, folder) == sorted(n for n in KEPT if "deep" not in n)
    text = plan(extract_articles(new))
    assert text.index("MapInArrow") < text.index("BroadcastHashJoin") and "Exchange hashpartitioning" not in text


def test_files_without_a_name_are_new(spark):
    files = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "file_name string, n int")
    assert rows(unions.not_yet_processed(files, files.where("n <> 3")).select("n")) == [(2,), (3,)]


def test_stream_reads_each_file_once(spark, folder, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        ingest_stream(xml_files.stream_xml_files(spark, str(folder)), out, state)
        return spark.read.parquet(out)

    first = run()
    assert names(good_articles(first), folder, "file_name") == sorted(KEPT)
    batch = extract_articles(xml_files.scan_xml_files(spark, str(folder)))
    assert rows(first) == rows(batch)
    assert rows(run()) == rows(batch)
    write(folder, "new.xml", tei())
    write(folder, "sample2.xml", tei())
    assert names(run(), folder, "file_name") == sorted(KEPT + ["new.xml"])


def test_manifest_and_diff(spark, folder):
    def snapshot():
        return spark.createDataFrame(xml_files.manifest(xml_files.scan_xml_files(spark, str(folder))).collect(),
                                     schemas.MANIFEST)

    old = snapshot()
    assert {r.change for r in manifests.snapshot_diff(old, old).collect()} == {"unchanged"}
    assert not manifests.has_changed(manifests.snapshot_diff(old, old))
    (folder / "Old.xml").unlink()
    write(folder, "new.xml", tei())
    write(folder, "deep/er/1.xml", tei(title="changed"))
    (folder / "000664.xml").touch()
    diff = manifests.snapshot_diff(old, snapshot())
    changes = {r.path.split(f"{folder}/")[1]: r.change for r in diff.collect()}
    assert changes == {"Old.xml": "removed", "new.xml": "added", "deep/er/1.xml": "changed",
                       "000664.xml": "unchanged", "000664/000665.xml": "unchanged", "old/000700.xml": "unchanged"}
    assert manifests.has_changed(diff)
    changed = diff.where("change in ('added', 'changed')").select("path")
    listing = xml_files.scan_xml_files(spark, str(folder)).drop("content").join(changed, "path", "left_semi")
    again = extract_articles(xml_files.read_files(listing))
    assert {r.file_name.split("/")[-1]: r.title for r in again.collect()} == {"1.xml": "changed", "new.xml": "A title"}


ODD_NAMES = ["a[1].xml", "a{1,2}.xml", "a*.xml", "a?.xml", "a 1.xml", "a#1.xml", "a%20b.xml", "ä+&.xml"]


def test_names_are_no_patterns(spark, tmp_path):
    """Every file is read under its own name, also where the name could be read as a pattern."""
    for name in ["a1.xml", "a2.xml", *ODD_NAMES]:
        (tmp_path / name).write_text(name)
    everything = xml_files.scan_xml_files(spark, str(tmp_path))
    known = everything.where("path like '%/a1.xml' or path like '%/a2.xml'").select(F.col("path").alias("file_name"))
    new = {r.path.rsplit("/", 1)[1]: r.content.decode() for r in xml_files.scan_new_xml_files(spark, str(tmp_path), known).collect()}
    assert new == {name: name for name in ODD_NAMES}


def test_small_files_share_tasks(spark, tmp_path):
    """A task for every few small files would be mostly the start of tasks."""
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "4MB")
    try:
        for n in range(400):
            (tmp_path / f"{n}.xml").write_text("<TEI/>")
        files = xml_files.scan_xml_files(spark, str(tmp_path))
        assert files.rdd.getNumPartitions() <= 10 and files.count() == 400
    finally:
        spark.conf.set(key, before)


def test_contents_keep_their_rows_in_shared_batches(spark, tmp_path):
    for n in range(300):
        (tmp_path / f"{n}.xml").write_text(f"<TEI>{n}</TEI>")
    read = xml_files.read_files(settle(xml_files.scan_xml_files(spark, str(tmp_path)).drop("content")))
    (tmp_path / "7.xml").unlink()

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    assert sum(r.n for r in read.mapInArrow(sizes, "n long").collect()) == 299
    assert sorted(r.content.decode() for r in read.collect()) == sorted(f"<TEI>{n}</TEI>" for n in range(300) if n != 7)
    assert all(r.length == len(r.content) for r in read.collect())


def test_a_file_that_is_gone_has_no_row(spark, folder):
    listing = settle(xml_files.scan_xml_files(spark, str(folder)).drop("content"))
    (folder / "Old.xml").unlink()
    assert names(xml_files.read_files(listing), folder) == sorted(n for n in KEPT if n != "Old.xml")


def test_stream_takes_files_of_any_age(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()
    now = time.time()
    for run, (name, days) in enumerate([("1.xml", 0), ("2.xml", 30), ("3.xml", 4000), ("4.xml", -1)], 1):
        write(folder, name, tei())
        os.utime(folder / name, (now - 86400 * days,) * 2)
        ingest_stream(xml_files.stream_xml_files(spark, str(folder)), out, state)
        assert spark.read.parquet(out).count() == run


def test_exact_manifest_sees_changes_that_keep_time_and_length(spark, folder):
    def now(**how):
        return xml_files.refresh_manifest(spark, str(folder), old, **how)

    old = settle(xml_files.manifest(xml_files.scan_xml_files(spark, str(folder))))
    path = folder / "Old.xml"
    kept = path.stat()
    path.write_bytes(path.read_bytes()[::-1])
    os.utime(path, ns=(kept.st_atime_ns, kept.st_mtime_ns))
    assert rows(manifests.snapshot_diff(old, now()).where("change = 'changed'").select(F.substring_index("path", "/", -1))) == [("Old.xml",)]
    assert not manifests.has_changed(manifests.snapshot_diff(old, now(trust_times=True)))


def test_one_page_for_each_address(spark):
    pages = spark.createDataFrame(
        [("a", 200, "x"), ("a", 200, "x"), ("a", 200, "y"), ("a", 404, "z"), ("b", 404, "x"), ("c", 200, None), ("d", 200, "d")],
        schemas.CRAWL)
    wanted = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "url string")
    found = rows(crawl.pages_at(pages, wanted))
    assert [url for url, _ in found] == ["a", "c"] and found[0][1] in ("x", "y") and found[1][1] is None


def test_html_is_not_shuffled(spark, no_broadcast):
    pages = settle(spark.createDataFrame([("a", 200, "x")], schemas.CRAWL))
    text = plan(crawl.pages_at(pages, settle(pages.select("url"))).where("html <> ''"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_chosen_pages_are_marked_in_their_files(spark, no_broadcast, monkeypatch):
    """However many addresses are wanted, html is not shuffled; the pages are those that the join finds."""
    pages = spark.range(40_000).selectExpr(
        "concat('u', id % 30000) as url", "case when id % 13 = 0 then 404 else 200 end as status",
        "case when id % 7 <> 0 then concat('h', id div 3) end as html").repartition(3)
    pages = settle(pages.union(pages.where("url like 'u7%'")).coalesce(3))
    wanted = settle(spark.range(0, 35_000, 3).selectExpr("concat('u', id) as url"))
    monkeypatch.setattr(crawl, "SMALL", 10)
    marked = crawl.pages_at(pages, wanted)
    text = plan(marked.where("html <> ''"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    monkeypatch.setattr(crawl, "BITMAPS", -1)
    assert rows(marked) == rows(crawl.pages_at(pages, wanted)) and marked.count() > 9_000


def test_refreshed_manifest_reads_only_touched_files(spark, folder):
    def everything():
        return xml_files.manifest(xml_files.scan_xml_files(spark, str(folder)))

    old = settle(everything().withColumn("sha256", F.concat(F.lit("known "), "path")))
    os.utime(folder / "000664.xml", (1, 1))
    write(folder, "new.xml", tei())
    (folder / "Old.xml").unlink()
    found = xml_files.refresh_manifest(spark, str(folder), old, trust_times=True)
    assert rows(found.drop("sha256")) == rows(everything().drop("sha256"))
    hashed = found.where("sha256 not like 'known %'")
    assert names(hashed, folder) == ["000664.xml", "new.xml"]
    assert hashed.join(everything(), found.columns, "left_anti").isEmpty()


def test_latest_version_wins(spark):
    log = spark.createDataFrame(
        [("p", 1, "a"), ("p", 3, "c"), ("p", 2, "b"), ("q", 1, "x"), ("q", 1, "y")], "path string, t int, sha256 string"
    ).selectExpr("path", "timestamp_seconds(t) as modification_time", "0L as length", "sha256")
    assert [(r.path, r.sha256) for r in manifests.latest_version(log).orderBy("path").collect()] == [("p", "c"), ("q", "y")]


def test_diff_shuffles_each_side_once(spark):
    log = settle(spark.createDataFrame([], schemas.MANIFEST))
    assert plan(manifests.snapshot_diff(log, log.where("length > 0"))).count("Exchange hashpartitioning") == 2


def test_csv_there_and_back(spark, tmp_path):
    path = str(tmp_path / "csv")
    data = [("1", 'a "quoted", b\nnew line\\ back', [("A", None, "e", None)]), ("2", None, []), ("000003", "é ", None)]
    schema = f"id string, text string, authors array<{schemas.AUTHOR.simpleString()}>"
    frame = spark.createDataFrame(data, schema)
    tables.write_csv(frame, path)
    assert rows(tables.read_csv(spark, path, frame.schema)) == rows(frame)
    tables.write_csv(frame.limit(1), path)
    assert tables.read_csv(spark, path, frame.schema).count() == 1


def test_issue_links_csv(spark, tmp_path):
    write(tmp_path, "links.csv", "issue_link,issue_text\nhttp://h/vol/17/2/index.html,2023: 17.2\nhttp://h/preview/index.html,next\n")
    found = tables.read_csv(spark, str(tmp_path / "links.csv"), schemas.ISSUE_LINKS)
    assert rows(found) == [("http://h/preview/index.html", "next"), ("http://h/vol/17/2/index.html", "2023: 17.2")]


def test_optional_tables(spark, tmp_path):
    path = str(tmp_path / "none")
    for empty in (tables.read_optional(spark, path, schemas.XML_LINKS), tables.read_optional(spark, None, schemas.XML_LINKS),
                  tables.read_optional_csv(spark, path, schemas.XML_LINKS)):
        assert empty.isEmpty() and empty.schema == schemas.XML_LINKS
    spark.createDataFrame([("l", "1", "2", "3")], schemas.XML_LINKS).write.parquet(path)
    assert rows(tables.read_optional(spark, path, schemas.XML_LINKS)) == [("l", "1", "2", "3")]


def test_stage_reuses_or_rebuilds(spark, tmp_path):
    path, built = str(tmp_path / "stage"), []

    def build():
        built.append(1)
        return spark.range(len(built))

    assert tables.stage(spark, path, build).count() == 1
    assert tables.stage(spark, path, build).count() == 1
    assert tables.stage(spark, path, build, rebuild=True).count() == 2
    (tmp_path / "stage" / "_SUCCESS").unlink()
    assert tables.stage(spark, path, build).count() == 3


def test_append_fills_lacking_columns(spark):
    left = spark.createDataFrame([("1", "x")], "id string, date_processed string")
    right = spark.createDataFrame([("t", "2")], "title string, id string")
    found = unions.append_rows(left, right)
    assert found.columns == ["id", "date_processed", "title"]
    assert rows(found) == [("1", "x", None), ("2", None, "t")]


def test_link_exists(spark):
    pages = spark.createDataFrame(
        [("a", 200, "ok"), ("b", 404, "ok"), ("c", 200, "Resource Not Found"), ("d", 200, None), ("e", None, "ok")],
        schemas.CRAWL)
    assert {r.url: r.link_exists for r in crawl.with_link_exists(pages).collect()} == {
        "a": True, "b": False, "c": False, "d": True, "e": False}
    assert rows(crawl.reachable_urls(pages)) == [("a",), ("d",)]
    assert rows(crawl.fetched(pages).select("url")) == [("a",), ("c",), ("d",)]


def test_stage_knows_its_input_and_parameters(spark, tmp_path):
    given, path, built = str(tmp_path / "given"), str(tmp_path / "stage"), []
    spark.range(5).write.parquet(given)

    def build():
        built.append(1)
        return spark.read.parquet(given)

    assert tables.stage(spark, path, build, inputs=[given], params={"n": 1}).count() == 5
    assert tables.stage(spark, path, build, inputs=[given], params={"n": 1}).count() == 5
    assert len(built) == 1  # same input, same parameters: reused
    tables.stage(spark, path, build, inputs=[given], params={"n": 2})
    assert len(built) == 2  # another parameter
    spark.range(5, 8).write.mode("append").parquet(given)
    assert tables.stage(spark, path, build, inputs=[given], params={"n": 2}).count() == 8
    assert len(built) == 3  # another input
    tables.stage(spark, path, build, inputs=[given], params={"n": 2})
    assert len(built) == 3


def odd_tree(root):
    for n, name in enumerate(KEPT + LEFT_OUT + ODD_NAMES):
        write(root, name, "x" * (n + 1))
    for name in ["empty.xml", ".hidden.xml", ".git/1.xml", "_temporary/2.xml", "k=v/3.xml", "_k=v/4.xml", "_metadata/5.xml",
                 "6.xml._COPYING_", "dir.xml/7.xml", "a b/c[1]/{d}/8.xml", "deep/er/and/deeper/9.xml", "a%20c/10.xml"]:
        write(root, name, "" if name == "empty.xml" else name)
    os.symlink(root / "nowhere", root / "broken.xml")
    os.symlink(root / "deep", root / "link")
    os.symlink(root / "Old.xml", root / "11.xml")
    os.utime(root / "Old.xml", ns=(1, 1_234_567_890_987_654_321))
    os.utime(root / "000664.xml", ns=(1, -1_500_000))
    (root / "none").mkdir()


@pytest.mark.parametrize("most", [50_000, 1])
def test_tasks_list_what_spark_lists(spark, tmp_path, monkeypatch, most):
    """However many rounds it takes, with overlapping folders and names of any kind."""
    odd_tree(tmp_path / "in")
    monkeypatch.setattr(xml_files, "LISTED", most)
    for roots in (["in"], ["in/"], ["in", "in/deep", "in"], ["in/a%20c", "in/deep/er"], ["in/none"]):
        places = [f"{tmp_path}/{root}" for root in roots]
        by_spark = xml_files._scan_by_spark(spark, tuple(places))
        assert rows(xml_files.scan_xml_files(spark, *places)) == rows(by_spark)
        assert rows(xml_files.list_xml_files(spark, f"file:{places[0]}", *places[1:])) == rows(by_spark.drop("content"))


def test_the_driver_lists_no_files(spark, tmp_path, monkeypatch):
    odd_tree(tmp_path)
    monkeypatch.setattr(xml_files, "_binary", None)  # Spark's listing, which the driver holds
    known = xml_files.list_xml_files(spark, str(tmp_path)).where("path like '%deep%'").select(F.col("path").alias("file_name"))
    found = xml_files.scan_xml_files(spark, str(tmp_path)).count()
    assert found > known.count() > 0
    assert xml_files.scan_new_xml_files(spark, str(tmp_path), known).count() == found - known.count()


def test_patterns_and_single_files_are_scanned_as_by_spark(spark, folder):
    assert names(xml_files.scan_xml_files(spark, f"{folder}/d*"), folder) == ["deep/er/1.xml"]
    assert names(xml_files.list_xml_files(spark, f"{folder}/Old.xml", f"{folder}/deep"), folder) == ["Old.xml", "deep/er/1.xml"]
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        xml_files.scan_xml_files(spark, f"{folder}/missing")
