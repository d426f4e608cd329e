"""Read selected fields out of one HTML page (runs inside Spark tasks).

Pages are rarely well formed, so the reading is tolerant: void elements close
at once, an end tag closes everything up to its start tag, an end tag without
a start tag is ignored, and text inside scripts, styles and templates does not
count as text of the page.  A text of nothing but whitespace counts as one line
break or one space, except where whitespace is kept.
"""

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape
from html.entities import html5
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNREAD = frozenset(("script", "style", "template"))
KEEPS_SPACE = frozenset(("pre", "textarea"))
SPACES = " \n\t\f\r"
_STEP = re.compile(r"(?P<tag>[a-z0-9]+)(?:#(?P<id>[^\[.]+)|\.(?P<token>[^\[]+)|\[class=(?P<cls>[^\]]+)\])?$")


@dataclass(frozen=True)
class Pick:
    """One field of a page.

    ``path``: steps such as ``div#toc``, ``span.viewAbstract`` or
    ``div[class=div div0]``; every step but the last goes to its first match.
    ``take``: ``text``, ``@name`` for an attribute, or ``rows`` to read ``fields``
    inside each match.  ``many`` returns every match of the last step.
    An empty path reads the element itself.
    """

    path: tuple
    take: str = "text"
    many: bool = False
    default: str | None = None
    fields: dict = field(default_factory=dict)


_seen_steps = {}


def _wanted(step):
    if step not in _seen_steps:
        _seen_steps[step] = _STEP.match(step).groupdict()
    return _seen_steps[step]


class _Node:
    __slots__ = ("tag", "attrs", "text_from", "text_to", "last")

    def __init__(self, tag, attrs, text_from):
        self.tag, self.attrs, self.text_from = tag, attrs, text_from
        self.text_to = self.last = None


class _Page(HTMLParser):
    """Elements in document order; each knows its span of texts and descendants."""

    def __init__(self, html):
        super().__init__(convert_charrefs=False)
        self.nodes, self.texts, self.open = [_Node("", {}, 0)], [], []
        self.run, self.unread, self.keep_space, self.open_tags = [], 0, 0, Counter()
        self.feed(html)
        self.close()
        self._end_text()
        self._close_from(0)
        self.nodes[0].text_to, self.nodes[0].last = len(self.texts), len(self.nodes)

    def handle_starttag(self, tag, attrs):
        self._end_text()
        node = _Node(tag, {name: value or "" for name, value in attrs}, len(self.texts))
        self.nodes.append(node)
        if tag in VOID:
            node.text_to, node.last = len(self.texts), len(self.nodes)
        else:
            self.open.append(node)
            self.open_tags[tag] += 1
            self.unread += tag in UNREAD
            self.keep_space += tag in KEEPS_SPACE

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._end_text()
        if self.open_tags[tag]:
            at = len(self.open) - 1
            while self.open[at].tag != tag:
                at -= 1
            self._close_from(at)

    def handle_data(self, data):
        self.run.append(data)

    def handle_charref(self, name):
        self.run.append(unescape(f"&#{name};"))

    def handle_entityref(self, name):
        self.run.append(html5.get(name + ";", "&" + name))

    def handle_comment(self, data):
        self._end_text()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self._end_text()
        if data.upper().startswith("CDATA[") and not self.unread:
            self.texts.append(data[len("CDATA["):])

    def updatepos(self, start, end):  # line numbers are not used
        return end

    def _end_text(self):
        """The data since the last tag or comment is one text."""
        if not self.run:
            return
        text = "".join(self.run)
        self.run.clear()
        if not self.unread:
            if not self.keep_space and not text.strip(SPACES):
                text = "\n" if "\n" in text else " "
            self.texts.append(text)

    def _close_from(self, at):
        for node in self.open[at:]:
            node.text_to, node.last = len(self.texts), len(self.nodes)
            self.open_tags[node.tag] -= 1
            self.unread -= node.tag in UNREAD
            self.keep_space -= node.tag in KEEPS_SPACE
        del self.open[at:]

    def matches(self, scope, step):
        """Descendants of the node at index ``scope`` that fit ``step``, in document order."""
        want = _wanted(step)
        for index in range(scope + 1, self.nodes[scope].last):
            node = self.nodes[index]
            if node.tag != want["tag"]:
                continue
            classes = node.attrs.get("class") or ""
            if (
                (want["id"] is None or node.attrs.get("id") == want["id"])
                and (want["token"] is None or want["token"] in classes.split())
                and (want["cls"] is None or want["cls"] == classes)
            ):
                yield index

    def read(self, scope, pick):
        if not pick.path:
            return self._value(scope, pick, 0)
        for step in pick.path[:-1]:
            scope = next(self.matches(scope, step), None)
            if scope is None:
                return [] if pick.many else pick.default
        found = self.matches(scope, pick.path[-1])
        if pick.many:
            return [self._value(index, pick, position) for position, index in enumerate(found)]
        first = next(found, None)
        value = None if first is None else self._value(first, pick, 0)
        return pick.default if value is None else value

    def _value(self, index, pick, position):
        node = self.nodes[index]
        if pick.take == "text":
            return "".join(self.texts[node.text_from:node.text_to])
        if pick.take == "rows":
            row = {name: self.read(index, inner) for name, inner in pick.fields.items()}
            return {"pos": position, **row}
        return node.attrs.get(pick.take[1:])


def read_page(html, picks):
    """-> {name: value} for one page."""
    page = _Page(html or "")
    return {name: page.read(0, pick) for name, pick in picks.items()}
