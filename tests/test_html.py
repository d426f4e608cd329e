"""Pages: selection, text, repair of broken markup, and the tables made from them."""

import pytest

from articlelake.functions.html_fields import Pick, read_page
from articlelake.operators import html
from tests.conftest import rows
from tests.documents import issue_page


def text(page, *path, **options):
    return read_page(page, {"x": Pick(path, **options)})["x"]


@pytest.mark.parametrize("page, found", [
    ("<div>a<b>b</b>c</div>", "abc"),
    ("<div>a<p>b<p>c</div>d", "abc"),                 # an end tag closes what is open inside it
    ("<div>a</b>c</div>", "ac"),                       # an end tag without a start tag
    ("<div>a<br>b<img src='x'>c<br/>d</div>", "abcd"),  # void elements hold nothing
    ("<div>a<script>if (1<2) '</b>'</script>b<style>p{}</style>c</div>", "abc"),
    ("<div>a<template><p>no</p></template>b</div>", "ab"),
    ("<div>a<!-- no -->b</div>", "ab"),
    ("<div>&amp;&lt;&eacute;&#65;&#x42;&copy &unknown;! a & b</div>", "&<éAB© &unknown! a & b"),
    ("<div>a < b</div>", "a < b"),
    ("<div> \n  <b>x</b>   <i> y  z </i><!-- c -->  \t</div>", "\nx  y  z  "),  # whitespace alone is one space
    ("<div><pre>  \n  </pre></div>", "  \n  "),
    ("<div>\u00a0 <b>x</b></div>", "\u00a0 x"),
    ("<div><![CDATA[a<b]]></div>", "a<b"),
    ("<div>never closed <i>x", "never closed x"),
    ("<DIV>Upper</DIV>", "Upper"),
    ("<p>none</p>", None), ("", None), (None, None),
])
def test_text_of_first_div(page, found):
    assert text(page, "div") == found


def test_steps():
    page = ('<div class="a b"><span>1</span></div><div id="x" class="div div0">2<div class="b">3</div></div>'
            '<div class="div0 div">4</div>')
    assert text(page, "div.b") == "1"
    assert text(page, "div.b", many=True) == ["1", "3"]
    assert text(page, "div#x") == "23"
    assert text(page, "div#x", "div") == "3"
    assert text(page, "div[class=div div0]", many=True) == ["23"]
    assert text(page, "div#none", "div", many=True) == []
    assert text(page, "div#none", "div", default="d") == "d"
    assert text(page, "div", "i", default="") == ""


def test_attributes():
    page = "<a>0</a><a href>1</a><a href='u?a=1&amp;b'>2</a><a href=x href=y>3</a>"
    assert text(page, "a", take="@href", many=True) == [None, "", "u?a=1&b", "y"]


def test_nested_matches_are_all_found():
    page = '<div class="div div0">a<div class="div div0">b</div></div>'
    assert text(page, "div[class=div div0]", many=True) == ["ab", "b"]


def pages(spark, *texts):
    return spark.createDataFrame([(f"u{n}", t) for n, t in enumerate(texts)], "url string, html string")


def test_issue_links(spark):
    home = pages(spark, """<a href="/vol/9/9/index.html">outside</a><div id="leftsidenav">
        <a href="/dhq/vol/1/2/index.html">2007: <b>1.2</b></a><a href="/dhq/preview/index.html">next</a>
        <a href="/about">About</a><a>no link</a></div>""")
    assert rows(html.issue_links(home, "http://j")) == [
        ("http://j/dhq/preview/index.html", "next"), ("http://j/dhq/vol/1/2/index.html", "2007: 1.2")]


def test_article_links(spark):
    articles = [
        ("Ann", "/dhq/vol/1/2/000007/000007.html", "One", '<span class="viewAbstract">Abs</span>'),
        ("Bob", "/dhq/preview/000008.html", "Two", ""),
        ("Cid", "/dhq/vol/1/2/000007/000009.html?x", "Three", ""),
    ]
    issues = pages(spark, issue_page(1, 2, articles), issue_page(1, 3, articles[:1], editors=""),
                   issue_page(1, 4, []), "<p>no contents</p>")
    issues = issues.selectExpr("url as issue_link", "'text' as issue_text", "html")
    found = html.article_links(issues, "http://j")
    got = {(r.issue_link, r.authors): r for r in found.collect()}
    assert set(got) == {("u0", "Ann"), ("u0", "Bob"), ("u0", "Cid"), ("u1", "Ann")}
    ann = got["u0", "Ann"]
    assert (ann.issue_title, ann.editors, ann.abstract) == ("Issue 1.2", "Ed One", "Abs")
    assert (ann.article_link, ann.article_title) == ("http://j/dhq/vol/1/2/000007/000007.html", "One")
    assert (ann.volume, ann.issue, ann.article_id) == ("1", "2", "000007")
    assert got["u1", "Ann"].editors == "" and got["u0", "Bob"].abstract == ""
    for name in ("Bob", "Cid"):
        assert (got["u0", name].volume, got["u0", name].issue, got["u0", name].article_id) == (None,) * 3


def test_xml_links(spark):
    page = pages(spark, """<a href="/dhq/vol/1/2/000007.xml">x</a><a href="/feed.xml">f</a><a name="t">t</a>
        <a href="http://h/dhq/vol/10/20/000008.xml?y">y</a><a href="/dhq/vol/1/2/000007.html">h</a>""")
    assert rows(html.xml_links(html.page_hrefs(page))) == [
        ("/dhq/vol/1/2/000007.xml", "1", "2", "000007"), ("http://h/dhq/vol/10/20/000008.xml?y", "10", "20", "000008")]


def test_article_page(spark):
    full = """<div class="DHQarticle"><div id="pubInfo">2010</div><div class="DHQheader">
        <h1 class="fr main">T<i>t</i></h1><div class="author">A</div><div class="author">B</div></div>
        <div id="DHQtext"><div id="abstract">Ab</div><div class="div div0">one</div>-<div class="div div0">two</div></div>
        <div id="notes"><div class="endnote">n1</div></div><div id="worksCited"><div class="bibl">w1</div>
        <div class="bibl">w2</div></div></div>"""
    bare = """<div class="DHQarticle"><div class="DHQheader"><h1>T</h1></div><div id="DHQtext"></div></div>"""
    found = {r.url: r for r in html.article_pages(pages(spark, full, bare)).collect()}
    row = found["u0"]
    assert (row.pubinfo, row.header_lang, row.header_title, row.page_authors) == ("2010", "fr", "Tt", ["A", "B"])
    assert (row.article_abstract, row.extracted_text, row.notes) == ("Ab", "onetwo", ["n1"])
    assert row.works_cited == ["w1", "w2"]
    row = found["u1"]
    assert (row.pubinfo, row.header_lang, row.article_abstract, row.extracted_text) == (None, "", "", "")
    assert (row.page_authors, row.notes, row.works_cited) == ([], [], [])
    notes = html.note_rows(html.article_pages(pages(spark, full, bare)), "works_cited", "url")
    assert rows(notes) == [("u0", 0, "w1"), ("u0", 1, "w2")]
