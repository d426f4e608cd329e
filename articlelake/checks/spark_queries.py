"""One query per operator: (spark, sf_dir) -> DataFrame over the whole driver tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from articlelake import schemas
from articlelake.functions import text as tx
from articlelake.functions.html_fields import Pick
from articlelake.operators import counts, html, joins, manifests, repair, tei, unions
from articlelake.plans import catalog, dataset, pages, report
from articlelake.session import settle, shared_folder
from articlelake.sources import crawl, tables, xml_files
from articlelake.streaming import ingest
from articlelake.streaming.changes import ingest_changes, read_ingested
from articlelake.checks import corpus
from articlelake.checks.corpus import SITE, table

DAY = "yyyy-MM-dd"


def _day(column: str):
    return F.date_format(column, DAY).alias(column)


def _orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.withColumn("date_text", F.date_format("o_orderdate", "d MMMM yyyy"))


# --- documents to articles ---------------------------------------------------

def tei_body_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = tei.extract_articles(
        corpus.documents_as_files(spark, sf_dir), fields=["body_text"], carry=["doc_id"])
    return parsed.select("doc_id", "body_text")


def tei_metadata(spark, sf_dir):
    fields = ["article_id", "volume", "issue", "article_type", "date_when", "keywords",
              "language_ident", "abstract"]
    parsed = tei.extract_articles(corpus.documents_as_files(spark, sf_dir), fields=fields)
    return tei.good_articles(parsed)


def tei_title_mixed(spark, sf_dir):
    parsed = tei.extract_articles(corpus.documents_as_files(spark, sf_dir), fields=["title"])
    return parsed.select("file_name", "title")


def tei_authors(spark, sf_dir):
    parsed = tei.extract_articles(corpus.documents_as_files(spark, sf_dir), fields=["authors"])
    return tei.author_rows(parsed, "file_name")


def _damaged(spark, sf_dir):
    return corpus.documents_as_files(spark, sf_dir).withColumn("content", F.expr(
        r"""case when doc_id % 11 = 0 then '\n <?xml version="1.0" encoding="UTF-8"?>\t\n'
                 when doc_id % 7 = 0 then replace(content, '</TEI>', '') else content end"""))


def tei_quarantine(spark, sf_dir):
    parsed = settle(tei.extract_articles(_damaged(spark, sf_dir), fields=[]))
    broken = tei.quarantine(parsed).select("file_name", "status")
    return unions.append_rows(broken, tei.good_articles(parsed))


def tei_status_counts(spark, sf_dir):
    parsed = tei.extract_articles(_damaged(spark, sf_dir), fields=[])
    return counts.count_by(parsed, "status")


def file_name_filter(spark, sf_dir):
    # every document under a name of its own form, most of them to be left out
    forms = """element_at(array(
        format_string('%06d.xml', doc_id), format_string('old/%06d.xml', doc_id), format_string('old%d.xml', doc_id),
        format_string('%06d_v1.xml', doc_id), format_string('sample%d.xml', doc_id), format_string('%drecovered.xml', doc_id),
        format_string('dhq%d.xml', doc_id), format_string('converted%d.xml', doc_id), format_string('%dtest.xml', doc_id),
        format_string('walsh%d.xml', doc_id), format_string('999%d.xml', doc_id), format_string('000000%d.xml', doc_id),
        format_string('%d.txt', doc_id), format_string('%d.XML', doc_id), format_string('Old%d.xml', doc_id)),
        cast(doc_id % 15 + 1 as int))"""
    named = table(spark, sf_dir, "documents").selectExpr("doc_id", f"concat('corpus/', {forms}) as path")
    name = xml_files.base_name(F.col("path"))
    return named.select("doc_id", "path", xml_files.is_article_file(name).alias("is_article"))


# --- pages -------------------------------------------------------------------

NAV = Pick(("nav", "a"), "rows", many=True, fields=html.NAV_LINKS.fields)
TOC = {
    "issue_title": Pick(("article", "h1")),
    "editors": Pick(("article", "h3"), default=""),
    "articles": Pick(("nav", "li"), "rows", many=True, fields={
        "authors": Pick(("div",)), "href": Pick(("a",), "@href"), "article_title": Pick(("a",)),
        "abstract": Pick(("span.viewAbstract",), default=""),
    }),
}
PAGE = {
    "header_lang": Pick(("html",), "@lang", default=""),
    "header_title": Pick(("article", "h1")),
    "pubinfo": Pick(("div.ad",)),
    "article_text": Pick(("article",), many=True),
    "notes": Pick(("article", "div.endnote"), many=True),
}


def nav_links(spark, sf_dir):
    found = html.link_rows(corpus.pages_table(spark, sf_dir), NAV, carry=["page_id"])
    return found.select(
        "page_id", "pos", tx.absolute_url(SITE, F.col("href")).alias("link"), F.col("text").alias("link_text"),
        html.is_issue_link(F.col("href")).alias("is_issue"))


def page_hrefs(spark, sf_dir):
    return html.page_hrefs(corpus.pages_table(spark, sf_dir), carry=["page_id"])


def page_toc(spark, sf_dir):
    return html.article_links(corpus.pages_table(spark, sf_dir), SITE, TOC, carry=["page_id"])


def page_article(spark, sf_dir):
    found = html.article_pages(corpus.pages_table(spark, sf_dir), PAGE, carry=["page_id"])
    return found.select("page_id", "header_lang", "header_title", "pubinfo", "extracted_text",
                        F.size("notes").alias("n_notes"))


def xml_links(spark, sf_dir):
    hrefs = table(spark, sf_dir, "documents").selectExpr("""case lang
        when 'en' then concat('/dhq/vol/', doc_id % 17, '/', doc_id % 4, '/', doc_id, '.xml')
        when 'de' then concat('http://x.example/dhq/vol/1/2/', doc_id, '.xml?from=', source)
        when 'fr' then concat('/feed/', doc_id, '.xml')
        else concat('/dhq/vol/1/2/', doc_id, '.html') end as href""")
    return html.xml_links(hrefs)


# --- column rules ------------------------------------------------------------

def article_key(spark, sf_dir):
    links = table(spark, sf_dir, "documents").selectExpr("doc_id", f"""case
        when lang = 'es' then concat('{SITE}/preview/', doc_id, '.html')
        when doc_id % 5 = 0 then concat('{SITE}/dhq/vol/1/2/', doc_id, '/', doc_id + 1, '.html')
        else concat('{SITE}/dhq/vol/', doc_id % 1500, '/', doc_id % 4, '/', doc_id, '/', doc_id, '.html?x=', source)
        end as link""")
    keyed = links.select("doc_id", *tx.article_key(F.col("link")))
    return keyed.select("doc_id", "issue", tx.pad_volume(F.col("volume")).alias("volume"),
                        tx.pad_article_id(F.col("article_id")).alias("article_id"))


def parse_dates(spark, sf_dir):
    written = _orders(spark, sf_dir).withColumn("date_text", F.expr("""case o_orderpriority
        when '1-URGENT' then replace(date_text, 'February', 'Feburary')
        when '2-HIGH' then date_format(o_orderdate, 'yyyy-MM-dd')
        when '3-MEDIUM' then date_format(o_orderdate, 'MMMM yyyy')
        when '4-NOT SPECIFIED' then concat('Winter ', year(o_orderdate))
        else date_text end"""))
    repaired = written.withColumn("date_text", tx.replace_all(F.col("date_text")))
    return repaired.select(
        "o_orderkey", "date_text", F.date_format(tx.parse_date(F.col("date_text")), DAY).alias("day"))


def json_field(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    body = F.concat(F.lit("["), "props", F.lit(', {"k": -1}]'))
    return events.select("event_id", tx.json_field(F.col("props"), "k").alias("k"),
                         tx.json_first(body, "k").alias("first_k"))


# --- cleaning ----------------------------------------------------------------

def latest_by_text(spark, sf_dir):
    newest = repair.latest_per_key(_orders(spark, sf_dir), "o_custkey", "date_text", ["o_orderkey"])
    return newest.select("o_custkey", "o_orderkey", "date_text")


def latest_by_date(spark, sf_dir):
    newest = repair.latest_per_key(_orders(spark, sf_dir), "o_custkey", "o_orderdate", ["o_orderkey"])
    return newest.select("o_custkey", "o_orderkey", "date_text")


def fix_and_default(spark, sf_dir):
    files = table(spark, sf_dir, "documents").selectExpr(
        f"concat('corpus/', {corpus.padded('doc_id')}, '.xml') as file_name",
        f"{corpus.FULL['volume']} as volume", f"{corpus.FULL['issue']} as issue")
    fixed = repair.apply_overrides(files, corpus.label_overrides(spark, sf_dir))
    return repair.default_unassigned(fixed)


def fill_dates(spark, sf_dir):
    gaps = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", "o_orderpriority",
        "case when o_orderkey % 10 <> 0 then o_orderdate end as o_orderdate")
    filled = repair.fill_from_group(
        gaps, "o_orderdate", ["o_orderstatus", "o_orderpriority"], spread_by=["o_orderkey"])
    return filled.withColumn("o_orderdate", F.date_format("o_orderdate", DAY))


def _page_issues(spark, sf_dir):
    return table(spark, sf_dir, "pages").selectExpr(
        "page_id", "url", "substring_index(substring_index(url, '/', 4), '/', -1) as volume",
        "nullif(substring_index(substring_index(url, '/', 3), '.', -1), 'org') as issue",
        "case when page_id % 3 = 1 then concat('t', page_id % 50) end as issue_title",
        "case when url like '%www%' then url end as issue_link")


def fill_issue_attrs(spark, sf_dir):
    return repair.share_in_group(_page_issues(spark, sf_dir), ["issue_title", "issue_link"],
                                 order_by=["url"], spread_by=["url"])


def fill_issue_gaps(spark, sf_dir):
    return repair.share_in_group(_page_issues(spark, sf_dir), ["issue_title", "issue_link"],
                                 order_by=["url"], mode="fill", spread_by=["url"])


# --- joins -------------------------------------------------------------------

def _document_keys(spark, sf_dir):
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id as file_name", f"{corpus.padded('doc_id div 2')} as article_id",
        "case when source <> 'src3' then (doc_id div 2) % 17 end as volume",
        "(doc_id div 2) % 4 as issue", "lang", "source")


def link_join(spark, sf_dir):
    return joins.join_links(_document_keys(spark, sf_dir), corpus.label_links(spark, sf_dir))


def missing_articles(spark, sf_dir):
    links = table(spark, sf_dir, "documents").selectExpr(
        "case when lang <> 'fr' then cast(doc_id as string) end as article_id", "source", "doc_id as article_link")
    known = table(spark, sf_dir, "labels").selectExpr("cast(doc_id as string) as article_id")
    return joins.missing_articles(links, known)


def missing_count(spark, sf_dir):
    return counts.row_count(missing_articles(spark, sf_dir)).withColumnRenamed("rows", "missing")


def _document_links(spark, sf_dir):
    keys = _document_keys(spark, sf_dir)
    return keys.selectExpr("file_name", "article_id", "format_string('%03d', volume) as volume_text",
                           "volume", "cast(issue as string) as issue", "lang").selectExpr(
        "file_name", "article_id", "case when volume is not null then volume_text end as volume", "issue",
        f"case when lang = 'de' then concat('{SITE}/own/', file_name) end as article_link")


def fill_links(spark, sf_dir):
    return repair.fill_links(_document_links(spark, sf_dir), corpus.label_crawl(spark, sf_dir), SITE)


def link_exists(spark, sf_dir):
    return crawl.with_link_exists(corpus.label_crawl(spark, sf_dir)).select("url", "status", "link_exists")


def existing_links(spark, sf_dir):
    built = _document_links(spark, sf_dir).select("file_name", tx.article_url(
        SITE, F.col("volume"), F.col("issue"), F.col("article_id")).alias("article_link"))
    return joins.existing_links(built, crawl.reachable_urls(corpus.label_crawl(spark, sf_dir)))


# --- unions and increments ---------------------------------------------------

def union_backfill(spark, sf_dir):
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus", "date_text")
    finished = orders.where("o_orderstatus = 'F'")
    others = orders.where("not (o_orderstatus <=> 'F')").drop("date_text")
    return unions.append_rows(finished, others)


def resume_append(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").selectExpr("doc_id as file_name", "text")
    labelled = table(spark, sf_dir, "labels").selectExpr("doc_id as file_name")
    existing = documents.join(labelled, "file_name", "left_semi").withColumn("run", F.lit("first"))
    new = unions.not_yet_processed(documents, existing).withColumn("run", F.lit("second"))
    return unions.append_rows(existing, new)


def _versions(documents, name, text, at):
    return documents.selectExpr(
        f"{name} as path", f"timestamp'{at}' as modification_time", "cast(0 as bigint) as length",
        f"sha2({text}, 256) as sha256")


def snapshot_diff(spark, sf_dir):
    documents = corpus.documents_table(spark, sf_dir)
    name = "concat('d', doc_id)"
    first = _versions(documents, name, "upper(text)", "2024-01-01 00:00:00")
    second = _versions(documents, name, "text", "2024-01-02 00:00:00")
    kept = documents.where("lang <> 'fr'")
    changed = "case when lang = 'de' then concat(text, '!') else text end"
    now = _versions(kept, name, changed, "2024-01-03 00:00:00")
    added = _versions(table(spark, sf_dir, "benchmark"), "concat('b', item_id)", "text", "2024-01-03 00:00:00")
    return manifests.snapshot_diff(first.union(second), now.union(added))


def latest_version(spark, sf_dir):
    log = table(spark, sf_dir, "events").selectExpr(
        "cast(user_id as string) as path", "ts as modification_time", "event_id as length",
        "concat(event_type, event_id) as sha256")
    return manifests.latest_version(log).select("path", F.col("length").alias("event_id"), "sha256")


def csv_round_trip(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").withColumn(
        "source", F.expr("case when lang <> 'de' then source end"))
    folder = shared_folder(spark)
    tables.write_csv(documents, folder)
    return tables.read_csv(spark, folder, documents.schema)


def ingest_stream(spark, sf_dir):
    """Two runs of the stream over the documents; the second finds nothing new."""
    path = f"{sf_dir}/documents.parquet"
    folder = shared_folder(spark)
    for _ in range(2):
        # a pattern, as a stream source takes no path of a single file
        documents = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path + "*")
        ingest.ingest_stream(corpus.as_files(documents), f"{folder}/parsed", f"{folder}/checkpoint",
                             fields=["article_id", "body_text"])
    return spark.read.parquet(f"{folder}/parsed").select("file_name", "article_id", "body_text", "status")


def _document_files(spark, sf_dir, where: str, text: str = "text"):
    """Some documents as article files under odd names; a third of them seem to be old."""
    return corpus.as_files(table(spark, sf_dir, "documents").where(where).withColumn("text", F.expr(text)), {
        "article_id": corpus.padded("doc_id"), "body": corpus.MARKED_BODY}).withColumn(
        "path", F.expr(corpus.ODD_NAMES)).withColumn("days", F.expr("case when doc_id % 3 = 0 then 30 else 0 end"))


def _read_back(parsed):
    return parsed.select("article_id", "body_text", F.substring_index("file_name", "/", -1).alias("file_name"))


def scan_files(spark, sf_dir):
    """Documents written as files, scanned by name and parsed."""
    folder = shared_folder(spark)
    corpus.write_files(_document_files(spark, sf_dir, "true"), folder)
    files = xml_files.scan_xml_files(spark, folder)
    return _read_back(tei.extract_articles(files, fields=["article_id", "body_text"]))


def scan_new_files(spark, sf_dir):
    """Documents of one language come first; of those that follow, only the new files are read."""
    folder, fields = shared_folder(spark), ["article_id", "body_text"]
    corpus.write_files(_document_files(spark, sf_dir, "lang <=> 'en'"), folder)
    known = settle(tei.extract_articles(xml_files.scan_xml_files(spark, folder), fields=fields))
    corpus.write_files(_document_files(spark, sf_dir, "not lang <=> 'en'"), folder)
    new = tei.extract_articles(xml_files.scan_new_xml_files(spark, folder, known), fields=fields)
    return _read_back(known).withColumn("run", F.lit("first")).union(_read_back(new).withColumn("run", F.lit("second")))


def ingest_files(spark, sf_dir):
    """Three runs of the ingest; files of the later runs are partly older than those of the first."""
    folder = shared_folder(spark)
    for part in ("lang <=> 'en'", "lang <=> 'de'", "not (lang <=> 'en' or lang <=> 'de')"):
        corpus.write_files(_document_files(spark, sf_dir, part), f"{folder}/in")
        ingest_changes(spark, f"{folder}/in", f"{folder}/parsed", f"{folder}/state", fields=["article_id", "body_text"])
    return _read_back(read_ingested(spark, f"{folder}/parsed"))


def ingest_updates(spark, sf_dir):
    """Files added, rewritten and removed between two runs: the kept table is a parse of the folder as it is last."""
    folder, fields = shared_folder(spark), ["article_id", "body_text"]
    corpus.write_files(_document_files(spark, sf_dir, "doc_id % 3 <> 0"), f"{folder}/in")
    ingest_changes(spark, f"{folder}/in", f"{folder}/parsed", f"{folder}/state", fields=fields)
    corpus.write_files(_document_files(spark, sf_dir, "doc_id % 3 = 0"), f"{folder}/in")
    corpus.write_files(_document_files(spark, sf_dir, "doc_id % 3 <> 0 and doc_id % 5 = 0", "text || ' changed'"),
                       f"{folder}/in")
    corpus.remove_files(_document_files(spark, sf_dir, "doc_id % 7 = 0"), f"{folder}/in")
    ingest_changes(spark, f"{folder}/in", f"{folder}/parsed", f"{folder}/state", fields=fields)
    return _read_back(read_ingested(spark, f"{folder}/parsed"))


def build_articles_append(spark, sf_dir):
    """The whole job from files, built, extended by files that came later, and read again."""
    folder, links = shared_folder(spark), table(spark, sf_dir, "labels").where("false")
    crawled = links.selectExpr("'' as url", "0 as status", "'' as html")
    for part, mode in (("lang <=> 'en'", "rebuild"), ("not lang <=> 'en'", "append"), (None, "reuse")):
        if part:
            corpus.write_files(_document_files(spark, sf_dir, part), f"{folder}/in")
        built = dataset.build_articles(spark, f"{folder}/in", f"{folder}/out", crawled, SITE, mode=mode)
    return built.select("article_id", "volume", "issue", "body_text")


def _must_not_run():
    raise AssertionError("a finished stage was built again")


def reuse_stage(spark, sf_dir):
    """A finished stage is read, not built again."""
    folder = shared_folder(spark)
    tables.stage(spark, folder, lambda: table(spark, sf_dir, "documents"))
    return tables.stage(spark, folder, _must_not_run)


def stage_fingerprint(spark, sf_dir):
    """A stage is reused while its input and parameters are the same, and built again when a parameter changes."""
    folder, given = shared_folder(spark), f"{sf_dir}/documents.parquet"

    def build(lang):
        return lambda: table(spark, sf_dir, "documents").where(F.col("lang") == lang).select("doc_id", "lang")

    tables.stage(spark, folder, build("en"), inputs=[given], params={"lang": "en"})
    tables.stage(spark, folder, _must_not_run, inputs=[given], params={"lang": "en"})
    return tables.stage(spark, folder, build("de"), inputs=[given], params={"lang": "de"})


def optional_backfill(spark, sf_dir):
    """One backfill table exists; an empty one of its type takes the place of another."""
    documents = table(spark, sf_dir, "documents").selectExpr(
        f"concat('corpus/', {corpus.padded('doc_id')}, '.xml') as file_name", "source as article_type")
    settle(table(spark, sf_dir, "labels").selectExpr(
        f"concat('backfill/', {corpus.padded('doc_id')}, '.xml') as file_name", "'backfill' as article_type",
        "date_add(date'2020-01-02', quality) as date_processed").withColumn(
        "date_processed", F.col("date_processed").cast("timestamp")), folder := shared_folder(spark))
    both = documents
    for path in (folder, shared_folder(spark)):
        both = unions.append_rows(both, tables.read_optional(spark, path, schemas.ARTICLES_CLEAN))
    return both.select("file_name", "article_type", _day("date_processed"), F.array_size("authors").alias("n_authors"))


def null_split(spark, sf_dir):
    """Orders without and with a date, each marked by the side it went to."""
    gaps = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "case when o_orderkey % 10 <> 0 then o_orderdate end as o_orderdate")
    missing, present = counts.null_split(gaps, "o_orderdate")
    both = unions.append_rows(missing.withColumn("side", F.lit("missing")),
                              present.withColumn("side", F.lit("present")))
    return both.withColumn("o_orderdate", F.date_format("o_orderdate", DAY))


# --- reports -----------------------------------------------------------------

def counts_by_type(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "date_format(o_orderdate, 'yyyy-MM-dd') as date_processed", "o_orderstatus as article_type")
    return counts.counts_by_type(rows)


def counts_by_lang(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").selectExpr(
        "case when doc_id % 11 <> 5 then cast(2007 + doc_id % 17 as string) end as date_processed",
        "lang as language_ident")
    return counts.counts_by_language(rows)


def top_articles(spark, sf_dir):
    top = counts.top_rows(table(spark, sf_dir, "documents"), "n_chars", 20, "doc_id")
    return top.select("doc_id", "lang", "n_chars")


# --- plans -------------------------------------------------------------------

def _curated(spark, sf_dir, fields=None):
    parsed = settle(tei.extract_articles(corpus.documents_as_files(spark, sf_dir, corpus.VERSIONED), fields=fields))
    articles = tei.good_articles(parsed)
    rows = dataset.build_dataset(articles, corpus.label_links(spark, sf_dir),
                                 overrides=corpus.label_overrides(spark, sf_dir))
    final = dataset.finalize(rows, corpus.label_crawl(spark, sf_dir), SITE)
    return dataset.with_contents(settle(final), articles)


def curated_dataset(spark, sf_dir):
    return _curated(spark, sf_dir).select(
        "file_name", "article_id", "volume", "issue", "date_when", _day("date_processed"), "article_link",
        "issue_title", "scraped_editors", "scraped_authors", "issue_text", "issue_link", "article_title",
        "language_ident", "title", "body_text")


def _reported(spark, sf_dir):
    """The finished table without texts: a report counts keys and dates."""
    return _curated(spark, sf_dir, [*dataset.KEY_COLUMNS[1:], "article_type", "language_ident"])


def report_by_type(spark, sf_dir):
    by_type = report.report(_reported(spark, sf_dir)).by_type
    return by_type.select(_day("date_processed"), "article_type", "articles")


def report_by_language(spark, sf_dir):
    by_language = report.report(_reported(spark, sf_dir)).by_language
    return by_language.select(_day("date_processed"), "language_ident", "articles")


def _labelled(spark, sf_dir):
    return table(spark, sf_dir, "labels").selectExpr("doc_id * 1000 as article_id")


def catalog_issues(spark, sf_dir):
    return html.issue_links(corpus.journal_home(spark, sf_dir), SITE)


def catalog_articles(spark, sf_dir):
    issues = settle(catalog_issues(spark, sf_dir))
    return catalog.catalog_articles(corpus.journal_crawl(spark, sf_dir), issues, SITE)


def catalog_missing(spark, sf_dir):
    links = settle(catalog_articles(spark, sf_dir))
    return catalog.catalog_missing(links, _labelled(spark, sf_dir)).select("article_link", "article_id")


def _catalog(spark, sf_dir):
    home, crawled = corpus.journal_home(spark, sf_dir), corpus.journal_crawl(spark, sf_dir)
    return catalog.link_catalog(crawled, home, SITE, _labelled(spark, sf_dir))


def catalog_xml_links(spark, sf_dir):
    return _catalog(spark, sf_dir).xml_links


def catalog_backfill(spark, sf_dir):
    return _catalog(spark, sf_dir).backfill.select("file_name", "article_id", "volume", "body_text")


def article_page_table(spark, sf_dir):
    found = pages.article_page_table(
        corpus.article_page_links(spark, sf_dir), corpus.article_crawl(spark, sf_dir))
    return found.select(
        "article_link", "article_title", "issue_text", "doc_id", "pubinfo", "header_lang", "header_title",
        F.array_join("page_authors", "|").alias("page_authors"), "article_abstract", "extracted_text",
        F.array_join("notes", "|").alias("notes"), F.array_join("works_cited", "|").alias("works_cited"),
        F.size("article_text").alias("parts"))


def page_notes(spark, sf_dir):
    found = pages.article_page_table(
        corpus.article_page_links(spark, sf_dir), corpus.article_crawl(spark, sf_dir),
        {"notes": html.ARTICLE_PAGE["notes"]})
    return html.note_rows(found, "notes", "doc_id")


QUERIES = {
    query.__name__: query
    for query in (
        tei_body_text, tei_metadata, tei_title_mixed, tei_authors, tei_quarantine, tei_status_counts,
        file_name_filter, nav_links, page_hrefs, page_toc, page_article, xml_links, article_key,
        parse_dates, json_field, latest_by_text, latest_by_date, fix_and_default, fill_dates,
        fill_issue_attrs, fill_issue_gaps, link_join, missing_articles, missing_count, fill_links,
        link_exists, existing_links, union_backfill, resume_append, snapshot_diff, latest_version,
        csv_round_trip, ingest_stream, scan_files, scan_new_files, ingest_files, ingest_updates,
        build_articles_append, reuse_stage, stage_fingerprint,
        optional_backfill, null_split, counts_by_type, counts_by_lang, top_articles,
        curated_dataset, report_by_type, report_by_language, catalog_issues, catalog_articles,
        catalog_missing, catalog_xml_links, catalog_backfill, article_page_table, page_notes,
    )
}
