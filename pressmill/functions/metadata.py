"""Columns derived from article headers and from file paths."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .blanks import strip
from .fixed import (
    AI_ERA_START,
    DIACRITICS,
    DIACRITICS_PLAIN,
    HUMAN,
    NOT_AVAILABLE,
    UNKNOWN_SOURCE,
)


def blank_if_unavailable(value: Column) -> Column:
    """``N/A`` and its spellings become the empty string, never null."""
    return F.when(value.isin(*NOT_AVAILABLE), "").otherwise(value)


def source_name(newspaper: Column, portal: Column) -> Column:
    """The newspaper if it is filled, else the portal."""
    return F.coalesce(F.nullif(newspaper, F.lit("")), portal, F.lit(""))


def first_present(*values: Column) -> Column:
    """The first value whose key is present, even if it is empty (null = absent)."""
    return F.coalesce(*values, F.lit(""))


def source_slug(name: Column) -> Column:
    plain = F.translate(F.lower(strip(name)), DIACRITICS, DIACRITICS_PLAIN)
    slug = F.btrim(F.regexp_replace(plain, "[^a-z0-9]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit(UNKNOWN_SOURCE))


def source_or_default(source: Column, default: str | None) -> Column:
    """Replace an empty or unknown source by the collection's own name."""
    if default is None:
        return source
    return F.when(source.isin("", UNKNOWN_SOURCE), default).otherwise(source)


def year_of(date: Column) -> Column:
    """First 19xx or 20xx anywhere in the date string, else null."""
    digits = F.regexp_extract(date, "(?:19|20)[0-9]{2}", 0)
    return F.nullif(digits, F.lit("")).try_cast("int")


def with_title(title: Column, text: Column) -> Column:
    return F.when(title != "", F.concat(title, F.lit(". "), text)).otherwise(text)


def as_int(value: Column) -> Column:
    """Integer of a CSV cell; ``2005.0`` counts, fractions and anything unreadable are null."""
    number = value.try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int"))


def ai_era(label: Column, year: Column) -> Column:
    """True for rows of the human class from the years when that is in doubt."""
    return F.coalesce((label == HUMAN) & (year >= AI_ERA_START), F.lit(False))


def decoded_path(encoded: Column) -> Column:
    """File paths in ``_metadata`` are URL-encoded, but a plus stands for itself."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def folder_of(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def stem_of(path: Column) -> Column:
    """File name without its last suffix."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, r"(?s)(?<=.)\.[^.]+\z", "")


def label_from_stem(stem: Column) -> Column:
    """Class that a file name announces; the AI patterns are tried first."""
    name = F.lower(stem)
    ai = r"(?:^|[_-])ai(?:[_-]|$)|_ai(?![\p{L}\p{N}_])|ai_rewritten|gpt"
    return F.when(name.rlike(ai), 1).when(name.rlike("human|original|ljudsk"), 0)
