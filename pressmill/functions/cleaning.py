"""Article cleaning: case, diacritics and all other letters are kept."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .blanks import BLANK, squeeze
from .fixed import AGENCIES, HEADER_KEYS

_KEYS = "|".join(re.escape(key) for key in HEADER_KEYS)
_AGENCIES = "|".join(AGENCIES)

# (?d): only \n ends a line. (?m): ^ and $ work per line.
DELIMITER = "<***>"
HEADER_LINE = rf"(?md)^(?:{_KEYS}){BLANK}*:.*$"
TAG = r"<[^>]+>"
ENTITY = r"&[a-z]+;"
_TAG_OR_ENTITY = r"[<&](?:(?<=<)[^>]+>|(?<=&)[a-z]+;)"


def drop_delimiters(text: Column) -> Column:
    return F.replace(text, F.lit(DELIMITER), F.lit(" "))


def drop_header_lines(text: Column) -> Column:
    """Header lines that leaked into the body; only those starting at column 0."""
    return F.regexp_replace(text, HEADER_LINE, " ")


def drop_tags(text: Column) -> Column:
    return F.regexp_replace(text, TAG, " ")


def drop_entities(text: Column) -> Column:
    """Named lower-case entities are dropped, not decoded; numeric ones stay."""
    return F.regexp_replace(text, ENTITY, " ")


def drop_markup(text: Column) -> Column:
    """Tags, then entities, in one pass.

    They cannot overlap partly, as an entity holds no angle bracket. The pattern starts
    with one character class, so most characters cost one look.
    """
    return F.regexp_replace(text, _TAG_OR_ENTITY, " ")


def _byline(before: str, max_chars: int | None) -> str:
    tail = "*" if max_chars is None else f"{{0,{int(max_chars)}}}"
    return rf"(?d){before}[(\-–—]{BLANK}*(?:{_AGENCIES})[^)]{tail}\)?\.?{BLANK}*$"


def drop_byline(text: Column, max_chars: int | None = None) -> Column:
    """Agency byline at the end of the text, with the blanks before it.

    By default the byline has no length bound: a dash followed by an agency name
    takes everything to the end if no closing bracket follows. ``max_chars``
    bounds what may follow the name.
    """
    return F.regexp_replace(text, _byline(f"{BLANK}*", max_chars), "")


def drop_byline_only(text: Column, max_chars: int | None = None) -> Column:
    """The byline without the blanks before it, for a text that is trimmed later."""
    return F.regexp_replace(text, _byline("", max_chars), "")


def clean_text(text: Column, byline_max_chars: int | None = None) -> Column:
    """The whole cleaning; null becomes the empty string.

    The order matters: a delimiter becomes a blank before header lines are looked for.
    """
    text = F.coalesce(text, F.lit(""))
    text = drop_markup(drop_header_lines(drop_delimiters(text)))
    return squeeze(drop_byline_only(text, byline_max_chars))
