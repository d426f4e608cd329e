"""Column rules for text, keys, links and dates. Built-in expressions only."""

import calendar
import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from articlelake import fixed_values as fixed

# Unicode classes and line ends as the patterns were written for: only \n ends a line.
_REGEX_FLAGS = "(?dU)"


def strip(text: Column) -> Column:
    """Without leading and trailing whitespace of any kind."""
    return F.regexp_replace(text, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def zero_pad(text: Column, width: int) -> Column:
    """Padded with zeros on the left; longer values are kept whole."""
    text = text.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def pad_article_id(text: Column) -> Column:
    return zero_pad(text, fixed.ARTICLE_ID_WIDTH)


def pad_volume(text: Column) -> Column:
    return zero_pad(text, fixed.VOLUME_WIDTH)


def as_key(value: Column) -> Column:
    """Keys are text, so leading zeros count; a null key stays null and joins nothing."""
    return value.cast("string")


def replace_all(text: Column, fixes: Mapping[str, str] = fixed.DATE_TYPOS) -> Column:
    for wrong, right in fixes.items():
        text = F.replace(text, F.lit(wrong), F.lit(right))
    return text


def _date_shape(date_format: str) -> str:
    """A pattern that every text of this date format fits: digits, names and literals in order."""
    def piece(part):
        if part.group("quoted") is not None:
            return re.escape(part.group("quoted"))
        letters = part.group("letters")
        if letters is None:
            return re.escape(part.group())
        if letters.startswith("MMM"):
            names = calendar.month_name if len(letters) > 3 else calendar.month_abbr
            return f"(?i:{'|'.join(name for name in names if name)})"
        return r"[+-]?\d+"

    pieces = re.sub(r"'(?P<quoted>[^']*)'|(?P<letters>([yMdHms])\3*)|.", piece, date_format)
    return rf"\A{pieces}\z"


def parse_date(text: Column, formats: Iterable[str] = fixed.DATE_FORMATS) -> Column:
    """The first format that fits gives the timestamp; no fit or null gives null.

    A failed attempt at a date is costly, so each format is tried only on texts of its shape.
    """
    trimmed = F.trim(text)
    return F.coalesce(*[
        F.when(trimmed.rlike(_date_shape(f)), F.try_to_timestamp(trimmed, F.lit(f))) for f in formats
    ])


def _groups(text: Column, pattern: str, names: Iterable[str]) -> list[Column]:
    found = text.rlike(_REGEX_FLAGS + pattern)
    return [
        F.when(found, F.regexp_extract(text, _REGEX_FLAGS + pattern, at)).alias(name)
        for at, name in enumerate(names, start=1)
    ]


def article_key(link: Column, pattern: str = fixed.ARTICLE_LINK_PATTERN) -> list[Column]:
    """``volume, issue, article_id`` of an article link; all null when it has another form."""
    return _groups(link, pattern, ("volume", "issue", "article_id"))


def xml_key(link: Column, pattern: str = fixed.XML_LINK_PATTERN) -> list[Column]:
    return _groups(link, pattern, ("volume", "issue", "article_id"))


def article_url(base: str, volume: Column, issue: Column, article_id: Column) -> Column:
    """The address an article should have; null when a part is missing."""
    complete = volume.isNotNull() & issue.isNotNull() & article_id.isNotNull()
    url = F.format_string(fixed.ARTICLE_LINK_FORMAT, F.lit(base), volume, issue, article_id, article_id)
    return F.when(complete, url)


def absolute_url(base: str, href: Column) -> Column:
    return F.concat(F.lit(base), href)


def first_or(array: Column, default: str = "") -> Column:
    return F.coalesce(F.get(array, F.lit(0)), F.lit(default))


def join_texts(array: Column) -> Column:
    """One text from many; nulls are left out."""
    return F.array_join(array, "")


def json_first(body: Column, name: str) -> Column:
    """Field ``name`` of the first element of a JSON array."""
    return F.get_json_object(body, f"$[0].{name}")


def json_field(body: Column, name: str) -> Column:
    return F.get_json_object(body, f"$.{name}")
