"""From raw dump text to articles, and from articles to corpus rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import metadata as meta
from ..functions.blanks import BLANK, lines, strip
from ..functions.fixed import HEADER_KEYS
from ..session import computed_once

# A line that holds only the delimiter and blanks.
DELIMITER_LINE = rf"(?md)^{BLANK}*<\*{{3}}>{BLANK}*$"

_KEYS = "|".join(re.escape(key) for key in HEADER_KEYS)

# A header line: key, spaces, colon, value. Only plain spaces may precede the colon.
_ENTRY = rf"(?s)\A{BLANK}*({_KEYS}) *:(.*)\z"

# A line that may stand in a header. Body lines fail at their first letters.
_HEADER_OR_BLANK = rf"\A{BLANK}*(?:\z|(?:{_KEYS}) *:)"


def split_blocks(dumps: DataFrame) -> DataFrame:
    """One row per block between delimiter lines; ``pos`` counts from 0 in a file.

    Text before the first delimiter is a block too, and so are empty blocks.
    """
    keep = [c for c in dumps.columns if c != "value"]
    return dumps.select(
        *keep, F.posexplode(F.split("value", DELIMITER_LINE)).alias("pos", "block")
    )


def _entry(line: Column) -> Column:
    return F.struct(
        F.regexp_extract(line, _ENTRY, 1).alias("key"),
        strip(F.regexp_extract(line, _ENTRY, 2)).alias("value"),
    )


def _last_value(entries: Column, key: str) -> Column:
    """Value of the last header line with this key; null if the key is absent."""
    hits = F.filter(entries, lambda e: e["key"] == key)
    return F.try_element_at(hits, F.lit(-1))["value"]


def has_body(block: Column) -> Column:
    """Is there a line that cannot stand in a header? Such a block is an article."""
    return F.exists(lines(strip(block)), lambda line: ~line.rlike(_HEADER_OR_BLANK))


def parse_blocks(blocks: DataFrame) -> DataFrame:
    """Header fields and body of every block that has a body.

    The header is the run of blank and ``KEY: value`` lines at the top. The first
    other line starts the body, which keeps its own blank lines.
    """
    keep = [c for c in blocks.columns if c != "block"]
    split = blocks.select(*keep, lines(strip(F.col("block"))).alias("_lines"))
    in_header = F.transform("_lines", lambda line: line.rlike(_HEADER_OR_BLANK))
    # A block without a body has no such line and is dropped.
    marked = computed_once(split, "_start", F.array_position(in_header, False))
    marked = marked.where(F.col("_start") > 0)
    start = F.col("_start").cast("int")
    cut = marked.select(
        *keep,
        # Blank lines have no key and are never asked for.
        F.transform(F.slice("_lines", F.lit(1), start - 1), _entry).alias("_head"),
        strip(F.array_join(F.slice("_lines", start, F.size("_lines")), "\n")).alias("text"),
    )
    raw = cut.select(
        *keep, "text", *(_last_value(F.col("_head"), key).alias(f"_{key}") for key in HEADER_KEYS)
    )

    def value(key: str) -> Column:
        return meta.blank_if_unavailable(F.col(f"_{key}"))

    def optional(key: str) -> Column:
        return meta.first_present(value(key))

    return raw.select(
        *keep,
        meta.source_name(value("NOVINA"), value("PORTAL")).alias("source_name"),
        optional("DATUM").alias("date"),
        optional("LINK").alias("link"),
        optional("RUBRIKA").alias("section"),
        optional("NADNASLOV").alias("supertitle"),
        optional("NASLOV").alias("title"),
        optional("PODNASLOV").alias("subtitle"),
        meta.first_present(value("AUTOR(I)"), value("AUTORI"), value("AUTOR")).alias("author"),
        "text",
    )


def parse_dumps(dumps: DataFrame) -> DataFrame:
    return parse_blocks(split_blocks(dumps))


def corpus_rows(
    articles: DataFrame,
    label: int | Column | None,
    include_title: bool = False,
    default_source: str | None = None,
) -> DataFrame:
    """Corpus columns of parsed articles.

    ``label`` is one class for the whole load, a column, or None for unknown truth
    (the label column is then left out). Titles are left out of the text by default,
    since headlines give away formatting rather than style.
    """
    known = {
        "source_name", "section", "supertitle", "subtitle", "author",
        "title", "date", "link", "text",
    }
    keep = [c for c in articles.columns if c not in known]
    text = F.col("text")
    if include_title:
        text = meta.with_title(F.col("title"), text)
    columns = [*keep, text.alias("text")]
    if label is not None:
        label = label if isinstance(label, Column) else F.lit(label)
        columns.append(label.cast("int").alias("label"))
    source = meta.source_slug(F.col("source_name"))
    columns += [
        meta.source_or_default(source, default_source).alias("source"),
        meta.year_of(F.col("date")).alias("year"),
        "title",
        "date",
        "link",
    ]
    return articles.select(*columns)
