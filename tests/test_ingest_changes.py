"""Ingest with its own manifest: added, changed and removed files, runs cut short, untouched buckets."""

import os
import time

from pyspark.sql import functions as F

from articlelake.operators.tei import extract_articles
from articlelake.sources import xml_files
from articlelake.streaming.changes import committed_version, ingest_changes, read_ingested
from tests.conftest import rows
from tests.documents import tei

# names that a reader of patterns would take for patterns
NAMES = ["a[1].xml", "a{2,1}.xml", "a*3.xml", "a?4.xml", "a 5#.xml", "a%206.xml", "000007.xml", "deep/er/000008.xml"]
FIELDS = ["article_id", "body_text"]


def write(folder, name, body, age=0):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(tei(article_id=name, body=f"<p>{body}</p>"), encoding="utf-8")
    then = time.time() - age
    os.utime(path, (then, then))


def parsed_folder(spark, folder):
    """A parse of the whole folder as it is: what the kept table must equal."""
    return rows(extract_articles(xml_files.scan_xml_files(spark, str(folder)), fields=FIELDS))


def run(spark, folder, tmp_path, buckets=4):
    return ingest_changes(spark, str(folder), str(tmp_path / "table"), str(tmp_path / "state"), FIELDS, buckets)


def kept(spark, tmp_path):
    return rows(read_ingested(spark, str(tmp_path / "table")))


def test_added_changed_removed_equal_a_rebuild(spark, tmp_path):
    folder = tmp_path / "in"
    for at, name in enumerate(NAMES[:6]):
        write(folder, name, f"first {at}", age=86400 * at)
    first = run(spark, folder, tmp_path)
    assert sorted(r.change for r in first.collect()) == ["added"] * 6
    assert kept(spark, tmp_path) == parsed_folder(spark, folder)
    assert len(kept(spark, tmp_path)) == 6

    write(folder, NAMES[0], "changed and longer")
    (folder / NAMES[1]).unlink()
    write(folder, NAMES[6], "new", age=86400 * 900)  # older than all, still new
    write(folder, NAMES[7], "new too")
    second = run(spark, folder, tmp_path)
    assert sorted((r.path.rsplit("/", 1)[-1] if "deep" not in r.path else "deep", r.change) for r in second.collect()) \
        == sorted([(NAMES[0], "changed"), (NAMES[1], "removed"), (NAMES[6], "added"), ("deep", "added")])
    assert kept(spark, tmp_path) == parsed_folder(spark, folder)
    assert committed_version(str(tmp_path / "state")) == 1

    assert run(spark, folder, tmp_path).count() == 0  # nothing changed: nothing read
    assert kept(spark, tmp_path) == parsed_folder(spark, folder)


def test_a_run_cut_before_its_commit_neither_loses_nor_repeats(spark, tmp_path):
    folder = tmp_path / "in"
    for at, name in enumerate(NAMES[:4]):
        write(folder, name, f"body {at}")
    run(spark, folder, tmp_path)
    write(folder, NAMES[4], "later")
    run(spark, folder, tmp_path)
    # the second run wrote its rows but was stopped before its manifest was committed
    os.remove(tmp_path / "state" / "manifest" / "v=1" / "_SUCCESS")
    assert committed_version(str(tmp_path / "state")) == 0
    again = run(spark, folder, tmp_path)
    assert [r.change for r in again.collect()] == ["added"]
    assert kept(spark, tmp_path) == parsed_folder(spark, folder)
    assert len(kept(spark, tmp_path)) == 5


def test_untouched_buckets_are_not_rewritten(spark, tmp_path):
    folder = tmp_path / "in"
    for at in range(40):
        write(folder, f"{at:06d}.xml", f"body {at}")
    run(spark, folder, tmp_path, buckets=16)
    table = tmp_path / "table"
    before = {p.name: sorted(f.name for f in p.iterdir()) for p in table.iterdir() if p.name.startswith("bucket=")}
    write(folder, "000003.xml", "changed, and longer than before")
    changes = run(spark, folder, tmp_path, buckets=16).collect()
    touched = {f"bucket={r.bucket}" for r in changes}
    after = {p.name: sorted(f.name for f in p.iterdir()) for p in table.iterdir() if p.name.startswith("bucket=")}
    assert len(touched) == 1
    for bucket, files in before.items():
        if bucket not in touched:
            assert after[bucket] == files
    assert after[touched.pop()] != before[f"bucket={changes[0].bucket}"]
    assert kept(spark, tmp_path) == parsed_folder(spark, folder)


def test_a_bucket_whose_files_are_all_removed_is_emptied(spark, tmp_path):
    folder = tmp_path / "in"
    for at in range(6):
        write(folder, f"{at:06d}.xml", f"body {at}")
    run(spark, folder, tmp_path, buckets=64)
    (folder / "000002.xml").unlink()
    run(spark, folder, tmp_path, buckets=64)
    found = read_ingested(spark, str(tmp_path / "table"))
    assert found.where(F.col("file_name").endswith("000002.xml")).count() == 0
    assert rows(found) == parsed_folder(spark, folder)
