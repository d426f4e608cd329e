"""Small article files and pages in the shapes the library reads."""

from articlelake.fixed_values import NAMESPACES

NS = f'xmlns="{NAMESPACES["tei"]}" xmlns:j="{NAMESPACES["journal"]}"'


def tei(article_id="000001", volume="001", issue="1", date="3 May 2010", kind="article",
        language='<language ident="en"/>', title="A title", authors="", keywords="k1",
        abstract="<p>About it</p>", body="<p>Text</p>", ns=NS):
    def node(value, before, after):
        return "" if value is None else f"{before}{value}{after}"

    return (
        f'<?xml version="1.0" encoding="UTF-8"?>\n<TEI {ns}><teiHeader><fileDesc><titleStmt>'
        + node(title, "<title>", "</title>") + authors + "</titleStmt><publicationStmt>"
        + node(article_id, '<idno type="DHQarticle-id">', "</idno>")
        + node(volume, '<idno type="volume">', "</idno>") + node(issue, '<idno type="issue">', "</idno>")
        + node(kind, "<j:articleType>", "</j:articleType>")
        + node(date, '<date when="2001-01-01">', "</date>") + "</publicationStmt></fileDesc>"
        + node(keywords, '<encodingDesc><classDecl><taxonomy xml:id="other"><bibl>x</bibl></taxonomy>'
               '<taxonomy xml:id="dhq_keywords"><bibl>', "</bibl></taxonomy></classDecl></encodingDesc>")
        + "<profileDesc><langUsage>" + (language or "") + "</langUsage></profileDesc></teiHeader><text>"
        + node(abstract, "<front><j:abstract>", "</j:abstract></front>")
        + node(body, "<body>", "</body>") + "</text></TEI>"
    )


BROKEN = tei(title="Broken")[:-6]
DECLARATION = '\n<?xml version="1.0" encoding="UTF-8"?>  \n'


def issue_page(volume, issue, articles, editors="<h3>Ed One</h3><h3>Ed Two</h3>"):
    infos = "".join(
        f'<div class="articleInfo"><div>{author}</div><a href="{href}">{title}</a>{abstract}</div>'
        for author, href, title, abstract in articles
    )
    return f'<html><h2>Site</h2><div id="toc"><h2>Issue {volume}.{issue}</h2>{editors}{infos}</div></html>'
