"""Values fixed by the article file format and the journal site's page layout.

Everything in this module must keep exactly these spellings: they decide which
nodes, files and links are recognised.  Functions take them as defaults, so a
corpus with another layout can pass its own.
"""

# --- Fixed values: XML namespaces -------------------------------------------
NAMESPACES = {
    "tei": "http://www.tei-c.org/ns/1.0",
    "journal": "http://www.digitalhumanities.org/ns/dhq",
    "xml": "http://www.w3.org/XML/1998/namespace",
}

# --- Fixed values: nodes whose leading text becomes a column ----------------
FIRST_TEXT_PATHS = {
    "article_id": ".//tei:publicationStmt/tei:idno[@type='DHQarticle-id']",
    "volume": ".//tei:publicationStmt/tei:idno[@type='volume']",
    "issue": ".//tei:publicationStmt/tei:idno[@type='issue']",
    "article_type": ".//tei:publicationStmt/journal:articleType",
    "date_when": ".//tei:publicationStmt/tei:date",
    "keywords": ".//tei:encodingDesc/tei:classDecl/tei:taxonomy[@xml:id='dhq_keywords']/tei:bibl",
    "abstract": ".//tei:text/tei:front/journal:abstract/tei:p",
}
LANGUAGE_PATH = ".//tei:profileDesc/tei:langUsage/tei:language"
TITLE_PATH = ".//tei:titleStmt/tei:title"
AUTHOR_PATH = ".//tei:titleStmt/journal:authorInfo"
AUTHOR_NAME_PATH = "journal:author_name"
AUTHOR_FAMILY_PATH = "journal:family"
AUTHOR_AFFILIATION_PATH = "journal:affiliation"
AUTHOR_EMAIL_PATHS = ("tei:email", "email")
AUTHOR_BIO_PATH = "journal:bio/tei:p"
BODY_PATH = ".//tei:text/tei:body"

# --- Fixed values: files that are not articles ------------------------------
XML_DECLARATION = '<?xml version="1.0" encoding="UTF-8"?>'
FILE_SUFFIX = ".xml"
EXCLUDED_NAME_PARTS = ("old", "converted", "dhq", "sample", "recovered", "test", "walsh")
EXCLUDED_NAME_STARTS = ("999", "000000")
EXCLUDED_NAME_CHARACTER = "_"

# --- Fixed values: links ----------------------------------------------------
ARTICLE_LINK_PATTERN = r".*vol/([^/]*)/([^/]*)/(\d+)/\3\.html"
XML_LINK_PATTERN = r"/dhq/vol/(\d+)/(\d+)/(\d+)\.xml"
ARTICLE_LINK_FORMAT = "%s/dhq/vol/%s/%s/%s/%s.html"
ISSUE_LINK_PARTS = ("vol", "preview")
XML_LINK_PART = "xml"
NOT_FOUND_TEXT = "Resource Not Found"

# --- Fixed values: repairs and widths ---------------------------------------
DATE_TYPOS = {"Feburary": "February"}
UNASSIGNED = "yet to be assigned"
OVERRIDES = (("000664.xml", "016", "4"),)
VOLUME_WIDTH = 3
ARTICLE_ID_WIDTH = 6

# --- Fixed values: date spellings accepted, tried in this order -------------
DATE_FORMATS = (
    "d MMMM yyyy",
    "d MMM yyyy",
    "MMMM d, yyyy",
    "MMM d, yyyy",
    "MMMM d yyyy",
    "MMM d yyyy",
    "d-MMM-yyyy",
    "MMMM yyyy",
    "MMM yyyy",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "yyyy/M/d",
    "M/d/yyyy",
    "yyyy-MM",
    "yyyy",
)
