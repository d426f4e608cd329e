"""Article files, link catalogs and crawled pages derived row by row from the driver tables."""

import os
import time

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from articlelake import fixed_values as fixed
from articlelake.session import DOCUMENT_BATCH, bound_batches, settle
from articlelake.sources.xml_files import client_for

SITE = "http://journal.example"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def pages_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def escaped(text: str) -> str:
    return f"replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def padded(number: str) -> str:
    return f"format_string('%06d', {number})"


DATE_TEXT = "date_format(date_add(date'2007-01-01', cast(doc_id % 6000 as int)), 'd MMMM yyyy')"
# every text piece in a paragraph of its own, frequent words marked up
MARKED_BODY = f"""concat('<div><p>', replace(replace({escaped('text')},
    '\\n', '</p>\\n<p>'), ' the ', ' <hi rend="i">the</hi> '), '</p></div>')"""
HEAD = f'<TEI xmlns="{fixed.NAMESPACES["tei"]}" xmlns:j="{fixed.NAMESPACES["journal"]}">'

# Fields of the documents' articles; a null leaves the node out.
FULL = {
    "article_id": padded("doc_id"),
    "volume": "case when doc_id % 10 <> 3 then format_string('%03d', doc_id % 17) end",
    "issue": "case when doc_id % 10 <> 7 then cast(doc_id % 4 as string) end",
    "article_type": "case when lang <> 'de' then source end",
    "date": f"case when doc_id % 11 <> 5 then {DATE_TEXT} end",
    "keywords": "case when lang <> 'fr' then concat(lang, ', ', source) end",
    "language": "case when lang = 'es' then '<language/>' "
                "else concat('<language ident=\"', lang, '\"/>') end",
    "abstract": "case lang when 'de' then concat('<p><hi>', source, '</hi> tail</p><p>next</p>') "
                "when 'fr' then null else concat('<p>About ', source, ' <hi>more</hi></p><p>next</p>') end",
    "title": "concat('On ', source, ' <emph>in <hi>', lang, '</hi> of ', n_chars, '</emph> letters')",
    "authors": """concat_ws('', transform(sequence(0, 3), i -> case when i < doc_id % 4 then concat(
        '<j:authorInfo><j:author_name>First', i, ' ',
        case when (doc_id + i) % 3 <> 0 then concat('<j:family>Last', doc_id, '</j:family>') else '' end,
        '</j:author_name>',
        case when i <> 1 then concat('<j:affiliation>', source, '</j:affiliation>') else '' end,
        case when i = 0 then concat('<email>a', doc_id, '@x.example</email>') else '' end,
        case when i = 2 then concat('<j:bio><p> Writes <hi>', lang, '</hi> texts </p></j:bio>') else '' end,
        '</j:authorInfo>') end))""",
    "body": MARKED_BODY,
}


def _node(value: str | None, before: str, after: str) -> str:
    return "''" if value is None else f"coalesce(concat('{before}', {value}, '{after}'), '')"


def tei(fields: dict[str, str]) -> Column:
    """One document as XML text; ``fields`` are expressions over the input columns."""
    def node(name, before, after):
        return _node(fields.get(name), before, after)

    return F.expr("concat(" + ", ".join([
        f"""'<?xml version="1.0" encoding="UTF-8"?>\\n{HEAD}<teiHeader><fileDesc><titleStmt>'""",
        node("title", "<title>", "</title>"), node("authors", "", ""),
        "'</titleStmt><publicationStmt>'",
        node("article_id", '<idno type="DHQarticle-id">', "</idno>"),
        node("volume", '<idno type="volume">', "</idno>"),
        node("issue", '<idno type="issue">', "</idno>"),
        node("article_type", "<j:articleType>", "</j:articleType>"),
        node("date", '<date when="x">', "</date>"),
        "'</publicationStmt></fileDesc>'",
        node("keywords", '<encodingDesc><classDecl><taxonomy xml:id="dhq_keywords"><bibl>',
             "</bibl></taxonomy></classDecl></encodingDesc>"),
        node("language", "<profileDesc><langUsage>", "</langUsage></profileDesc>"),
        "'</teiHeader><text>'",
        node("abstract", "<front><j:abstract>", "</j:abstract></front>"),
        node("body", "<body>", "</body>"),
        "'</text></TEI>'",
    ]) + ")")


def documents_as_files(spark: SparkSession, sf_dir: str, fields: dict[str, str] = FULL) -> DataFrame:
    """``doc_id, path, content``: every document as an article file."""
    return as_files(documents_table(spark, sf_dir), fields)


def as_files(documents: DataFrame, fields: dict[str, str] = FULL) -> DataFrame:
    return documents.select(
        "doc_id", F.expr(f"concat('corpus/', {padded('doc_id')}, '.xml')").alias("path"),
        tei(fields).alias("content"),
    )


# Article versions: two documents share an id, volume and issue.
VERSIONED = {
    "article_id": padded("doc_id div 2"),
    "volume": "case when source <> 'src3' then format_string('%03d', (doc_id div 2) % 17) end",
    "issue": "case when source <> 'src4' then cast((doc_id div 2) % 4 as string) end",
    "article_type": "source",
    "date": f"case when doc_id % 11 <> 5 then replace({DATE_TEXT}, 'February', 'Feburary') end",
    "language": "concat('<language ident=\"', lang, '\"/>')",
    "title": "concat('On <hi>', source, '</hi>')",
    "body": MARKED_BODY,
}


def label_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog entry for every labelled document."""
    link = f"concat('{SITE}/dhq/vol/', volume, '/', issue, '/', article_id, '/', article_id, '.html')"
    keys = table(spark, sf_dir, "labels").selectExpr(
        "doc_id", "quality", "toxic", f"{padded('doc_id div 2')} as article_id",
        "cast((doc_id div 2) % 17 as string) as volume", "cast((doc_id div 2) % 4 as string) as issue",
    )
    return keys.selectExpr(
        "case when quality = 1 then concat('Issue ', volume, '.', issue, ' of ', doc_id) end as issue_title",
        "concat('Editor ', toxic) as editors", "concat('Author ', doc_id) as authors",
        f"case when toxic = 0 then {link} end as article_link", "concat('Title ', doc_id) as article_title",
        "'' as abstract", "concat(volume, '.', issue) as issue_text",
        f"concat('{SITE}/vol/', volume, '/', issue, '/index.html') as issue_link",
        "volume", "issue", "article_id",
    )


def label_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What fetching the address of each labelled article gave."""
    volume, issue = "format_string('%03d', (doc_id div 2) % 17)", "(doc_id div 2) % 4"
    article = padded("doc_id div 2")
    return table(spark, sf_dir, "labels").selectExpr(
        f"concat('{SITE}/dhq/vol/', {volume}, '/', {issue}, '/', {article}, '/', {article}, '.html') as url",
        "case when quality = 1 then 200 else 404 end as status",
        "case when toxic = 1 then '<p>Resource Not Found</p>' else '<p>Found</p>' end as html",
    )


def label_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections for the files of toxic documents."""
    return table(spark, sf_dir, "labels").where("toxic = 1").selectExpr(
        f"concat({padded('doc_id')}, '.xml') as base_name", "'016' as volume", "'4' as issue"
    )


def journal_home(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The home page of a journal per document, with links to its issue, its preview and elsewhere."""
    return documents_table(spark, sf_dir).selectExpr(
        f"concat('{SITE}/home/', doc_id) as url", "200 as status",
        """concat('<body><div id="other"><a href="/vol/0/0/none.html">no</a></div><div id="leftsidenav"><ul>',
            '<li><a href="/vol/', doc_id, '/1/index.html">', lang, ': ', doc_id, '.1</a>',
            '<li><a href="/preview/', doc_id, '.html">Preview</a>',
            '<li><a href="/about/', doc_id, '.html">About</a><li><a>No link</a></ul></div>') as html""",
    )


def journal_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A journal whose issues are documents and whose articles are their lines.

    Each page is made from one row.  Fetching fails for the issue pages of one source.
    """
    documents = documents_table(spark, sf_dir)
    issues = documents.selectExpr(
        f"concat('{SITE}/vol/', doc_id, '/1/index.html') as url",
        "case when source = 'src7' then 404 else 200 end as status",
        f"""concat('<body><h2>Outside</h2><div id="toc"><h2>Issue <i>', doc_id, '</i></h2>',
            case when lang = 'fr' then '' else concat('<h3>Editor ', source, '</h3>') end,
            concat_ws('', transform(split({escaped('text')}, '\\n'), (line, i) -> concat(
                '<div class="articleInfo top"><div>Author ', i, '</div><a href="/vol/', doc_id, '/1/',
                doc_id * 1000 + i, '/', doc_id * 1000 + case when lang = 'es' then i + 1 else i end,
                '.html">Article <b>', i, '</b></a>',
                case when line = '' then '' else concat('<span class="viewAbstract">', line, '</span>') end,
                '<script>var x = "<div>";</script></div>'))), '</div></body>') as html""",
    )
    lines = documents.selectExpr(
        "doc_id", "lang", "posexplode(split(text, '\\n')) as (line_no, line)"
    ).selectExpr("*", "doc_id * 1000 + line_no as id")
    pages = lines.selectExpr(
        f"concat('{SITE}/vol/', doc_id, '/1/', id, '/', id, '.html') as url", "200 as status",
        """concat('<a name="top"></a><a href="/style.css">s</a><a href="/dhq/vol/', doc_id, '/1/', id,
            '.xml">XML</a><a href="/feed.xml">feed</a>') as html""",
    )
    xml = lines.select(
        F.expr(f"concat('{SITE}/dhq/vol/', doc_id, '/1/', id, '.xml')").alias("url"),
        F.expr("case when line_no = 1 then 404 else 200 end").alias("status"),
        tei({"article_id": "cast(id as string)", "volume": "cast(doc_id as string)",
             "body": f"concat('<p>', {escaped('line')}, '</p>')"}).alias("html"),
    )
    return settle(issues.unionByName(pages).unionByName(xml))


def article_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full article page for every document; fetching fails for one source."""
    pages = documents_table(spark, sf_dir).selectExpr(
        f"concat('{SITE}/page/', doc_id) as url",
        "case when source = 'src7' then 404 else 200 end as status",
        f"""concat('<body><div class="DHQarticle wide"><div id="pubInfo">', source, ' &middot; ', doc_id, '</div>',
            '<div class="DHQheader"><h1', case when lang = 'es' then '' else concat(' class="', lang, ' main"') end,
            '>Title <em>', doc_id, '</em></h1><div class="author">A', doc_id, '</div><div class="author">B</div></div>',
            '<div id="DHQtext">',
            case when lang = 'fr' then '' else concat('<div id="abstract"><p>In ', lang, '</div>') end,
            '<div class="div div0">', replace({escaped('text')}, '\\n', '</div>\\n<div class="div div0">'), '</div></div>',
            case when doc_id % 3 = 0 then '' else concat('<div id="notes"><div class="endnote">n', doc_id,
                '</div><div class="endnote"><b>m</b></div></div>') end,
            case when doc_id % 4 = 0 then '' else '<div id="worksCited"><div class="bibl">Cited<br></div></div>' end,
            '</div></body>') as html""",
    )
    return settle(pages)


def article_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(
        f"concat('{SITE}/page/', doc_id) as article_link", "concat('Title ', doc_id) as article_title",
        "lang as issue_text", "doc_id",
    )


# A form of file name for each document; most of them hold what some readers take for a pattern.
ODD_NAMES = """element_at(array(
    format_string('%06d.xml', doc_id), format_string('deep/er/%06d.xml', doc_id), format_string('a[%d].xml', doc_id),
    format_string('a{%d,1}.xml', doc_id), format_string('a*%d.xml', doc_id), format_string('a?%d.xml', doc_id),
    format_string('a %d#.xml', doc_id), format_string('a%%20%d.xml', doc_id), format_string('sample%d.xml', doc_id),
    format_string('%d.txt', doc_id)), cast(doc_id % 10 + 1 as int))"""


def write_files(files: DataFrame, folder: str) -> None:
    """Write each row ``path, content, days`` as a file of its own below ``folder``, on the executors.

    ``days`` is the age that the file shall seem to have, where its file system has a clock to set.
    """
    def write(batches):
        made = set()
        for batch in batches:
            for row in batch.to_pylist():
                client, place = client_for(f"{folder}/{row['path']}")
                parent = place.rsplit("/", 1)[0]
                if parent not in made:
                    client.create_dir(parent, recursive=True)
                    made.add(parent)
                with client.open_output_stream(place) as out:
                    out.write(row["content"].encode())
                if isinstance(client, fs.LocalFileSystem):
                    then = time.time() - 86400 * row["days"]
                    os.utime(place, (then, then))
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["files"])

    bound_batches(files.sparkSession, DOCUMENT_BATCH)
    files.select("path", "content", "days").mapInArrow(write, "files long").agg(F.sum("files")).collect()


def remove_files(paths: DataFrame, folder: str) -> None:
    """Delete the file of each row ``path`` below ``folder``, on the executors; a missing file is no fault."""
    def remove(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                client, place = client_for(f"{folder}/{path}")
                try:
                    client.delete_file(place)
                except FileNotFoundError:
                    pass
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["files"])

    paths.select("path").mapInArrow(remove, "files long").agg(F.sum("files")).collect()
