"""Article documents: every field, every absent node, damaged documents."""

from xml.sax.saxutils import escape

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row

from articlelake.functions.tei_fields import OK, read_tei
from articlelake.operators.tei import author_rows, extract_articles, good_articles, quarantine
from tests.conftest import plan
from tests.documents import BROKEN, DECLARATION, tei


def one(spark, document, **options):
    content = document if isinstance(document, bytes) else document.encode()
    files = spark.createDataFrame([("d/1.xml", bytearray(content))], "path string, content binary")
    return extract_articles(files, **options).first()


def test_complete_document(spark):
    row = one(spark, tei())
    assert (row.file_name, row.article_id, row.volume, row.issue) == ("d/1.xml", "000001", "001", "1")
    assert (row.article_type, row.date_when, row.keywords) == ("article", "3 May 2010", "k1")
    assert (row.language_ident, row.abstract, row.title) == ("en", "About it", "A title")
    assert (row.authors, row.body_text, row.status, row.parse_error) == ([], "Text", "ok", None)


@pytest.mark.parametrize("argument, column", [
    ("article_id", "article_id"), ("volume", "volume"), ("issue", "issue"), ("kind", "article_type"),
    ("date", "date_when"), ("keywords", "keywords"), ("language", "language_ident"),
    ("abstract", "abstract"), ("title", "title"), ("body", "body_text"),
])
def test_absent_node_is_null(spark, argument, column):
    row = one(spark, tei(**{argument: None}))
    assert row[column] is None and row.status == "ok"


def test_language_without_ident_is_null(spark):
    assert one(spark, tei(language="<language>en</language>")).language_ident is None


@pytest.mark.parametrize("title, text", [
    ("plain", "plain"), ("a <i>b</i> c", "a b c"), ("Lead <i>x<b>y</b>z</i>w", "Lead xyzw"),
    ("<i/>end", "end"), ("", ""), ("R &amp; D &lt;1&gt;", "R & D <1>"),
])
def test_title_in_reading_order(spark, title, text):
    assert one(spark, tei(title=title)).title == text


def test_abstract_is_text_before_first_tag_of_first_paragraph(spark):
    assert one(spark, tei(abstract="<p>One <i>two</i> three</p><p>four</p>")).abstract == "One "
    assert one(spark, tei(abstract="<p><i>two</i> three</p>")).abstract is None


def test_body_keeps_all_text_in_order(spark):
    body = "\n <p>a<hi>b</hi>c</p><!-- no --><p><![CDATA[<d>]]> é</p>\n "
    assert one(spark, tei(body=body)).body_text == "abc<d> é"


def test_authors(spark):
    def info(inner):
        return f"<j:authorInfo>{inner}</j:authorInfo>"

    authors = (
        info("<j:author_name>Ann <j:family>Lee</j:family></j:author_name>"
             "<j:affiliation>Uni</j:affiliation><email>a@x</email>"
             "<j:bio><p> Bio <i>text</i> </p><p>more</p></j:bio>")
        + info("<j:author_name>Solo</j:author_name>")
        + info("<j:author_name><j:family>Only</j:family></j:author_name>")
        + info("<j:affiliation>None</j:affiliation>")
        + info("<j:author_name/>")
    )
    found = one(spark, tei(authors=authors)).authors
    assert [tuple(a) for a in found] == [
        ("Ann Lee", "Uni", "a@x", "Bio text"), ("Solo", None, None, None),
        ("Only", None, None, None), (None, "None", None, None), (None, None, None, None),
    ]


def test_email_outside_the_namespace(spark):
    authors = '<j:authorInfo><email xmlns="">b@x</email></j:authorInfo>'
    assert one(spark, tei(authors=authors)).authors[0].email == "b@x"


def test_author_rows_keep_articles_without_authors(spark):
    authors = "<j:authorInfo><j:author_name>A</j:author_name></j:authorInfo>" * 2
    files = spark.createDataFrame([("1", tei(authors=authors)), ("2", tei())], "path string, content string")
    found = author_rows(extract_articles(files, fields=["authors"]), "file_name").collect()
    assert sorted((r.file_name, r.position, r.author_name) for r in found if r.position is not None) == [
        ("1", 0, "A"), ("1", 1, "A")]
    assert [r.file_name for r in found if r.position is None] == ["2"]


def test_other_prefix_of_the_same_namespace(spark):
    ns = 'xmlns:t="http://www.tei-c.org/ns/1.0"'
    document = (f"<t:TEI {ns}><t:teiHeader><t:titleStmt><t:title>T</t:title></t:titleStmt></t:teiHeader>"
                "<t:text><t:body>B</t:body></t:text></t:TEI>")
    row = one(spark, document)
    assert (row.title, row.body_text) == ("T", "B")


def test_namespace_decides(spark):
    row = one(spark, tei(ns='xmlns="http://x.example" xmlns:j="http://y.example"'))
    assert row.status == "ok" and row.title is None and row.article_type is None


def test_declared_encoding(spark):
    document = tei(title="é").replace("UTF-8", "ISO-8859-1").encode("latin-1")
    assert one(spark, document).title == "é"


def test_good_rows_and_quarantine_share_the_input(spark):
    documents = [("ok", tei()), ("cut", BROKEN), ("declaration", DECLARATION), ("empty", ""), ("null", None),
                 ("text", "no xml"), ("declared twice", DECLARATION.strip() * 2)]
    files = spark.createDataFrame(documents, "path string, content string")
    parsed = extract_articles(files)
    assert [r.file_name for r in good_articles(parsed).collect()] == ["ok"]
    bad = {r.file_name: r for r in quarantine(parsed).collect()}
    assert {name: r.status for name, r in bad.items()} == {
        "cut": "malformed", "declaration": "declaration_only", "empty": "malformed", "null": "malformed",
        "text": "malformed", "declared twice": "malformed"}
    assert bad["cut"].parse_error and bad["declaration"].parse_error is None


def test_only_wanted_fields_and_carried_columns(spark):
    files = spark.createDataFrame([Row(path="p", content=tei(), n=7)])
    found = extract_articles(files, fields=["title"], carry=["n"])
    assert found.columns == ["file_name", "title", "status", "parse_error", "n"]
    assert tuple(found.first()) == ("p", "A title", "ok", None, 7)


def test_one_python_stage(spark):
    files = spark.createDataFrame([("p", tei())], "path string, content string")
    text = plan(good_articles(extract_articles(files)).where("volume = '001'"))
    assert text.count("MapInArrow") == 1


def test_all_texts_survive_many_batches(spark):
    documents = [(f"{n}.xml", tei(article_id=f"{n:06d}", body=f"<p>{'x' * (n % 97)}</p>")) for n in range(3000)]
    files = spark.createDataFrame(documents, "path string, content string").repartition(3)
    found = {r.article_id: r.body_text for r in extract_articles(files).collect()}
    assert found == {f"{n:06d}": "x" * (n % 97) for n in range(3000)}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs", "Cc"], exclude_characters="\ufffe\uffff")), max_size=6))
def test_written_text_is_read_back(pieces):
    body = "".join(f"<p>{escape(piece)}<hi/></p>" for piece in pieces)
    status, _, record = read_tei(tei(body=body).encode(), ["body_text"])
    assert status == OK and record["body_text"] == "".join(pieces).strip()
