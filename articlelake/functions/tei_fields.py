"""Read the wanted fields out of one TEI document (runs inside Spark tasks)."""

from xml.etree import ElementTree

from articlelake import fixed_values as fixed

OK, DECLARATION_ONLY, MALFORMED = "ok", "declaration_only", "malformed"


def _find(node, path):
    return node.find(path, fixed.NAMESPACES)


def _first_text(node, path):
    found = _find(node, path)
    return None if found is None else found.text


def _all_text(node, path):
    found = _find(node, path)
    return None if found is None else "".join(found.itertext())


def _stripped(text):
    return None if text is None else text.strip()


def _author(info):
    name = _find(info, fixed.AUTHOR_NAME_PATH)
    if name is not None:
        parts = (name.text, _first_text(name, fixed.AUTHOR_FAMILY_PATH))
        name = " ".join(part.strip() for part in parts if part and part.strip()) or None
    emails = (_first_text(info, path) for path in fixed.AUTHOR_EMAIL_PATHS)
    return {
        "author_name": name,
        "affiliation": _first_text(info, fixed.AUTHOR_AFFILIATION_PATH),
        "email": next((email for email in emails if email is not None), None),
        "bio": _stripped(_all_text(info, fixed.AUTHOR_BIO_PATH)),
    }


def _language(root):
    language = _find(root, fixed.LANGUAGE_PATH)
    return None if language is None else language.get("ident")


READERS = {
    **{name: (lambda root, path=path: _first_text(root, path))
       for name, path in fixed.FIRST_TEXT_PATHS.items()},
    "language_ident": _language,
    "title": lambda root: _all_text(root, fixed.TITLE_PATH),
    "authors": lambda root: [_author(a) for a in root.findall(fixed.AUTHOR_PATH, fixed.NAMESPACES)],
    "body_text": lambda root: _stripped(_all_text(root, fixed.BODY_PATH)),
}


def read_tei(content, wanted):
    """-> (status, error, {field: value}) for one document given as bytes or text."""
    text = content.decode("utf-8", "replace") if isinstance(content, bytes) else content or ""
    if text.strip() == fixed.XML_DECLARATION:
        return DECLARATION_ONLY, None, {}
    try:
        root = ElementTree.fromstring(content or "")
    except (ElementTree.ParseError, LookupError, ValueError) as error:
        return MALFORMED, str(error), {}
    return OK, None, {name: READERS[name](root) for name in wanted}
