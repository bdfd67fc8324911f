"""Cleaning a text column of a table, without running patterns that cannot match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import cleaning
from ..functions.blanks import join_spaces, plain_spaces
from ..functions.fixed import AGENCIES
from ..session import computed_once

def _holds(text: Column, words: tuple[str, ...]) -> Column:
    found = F.contains(text, F.lit(words[0]))
    for word in words[1:]:
        found = found | F.contains(text, F.lit(word))
    return found


def with_clean_text(
    df: DataFrame,
    source: str = "text",
    target: str = "text",
    byline_max_chars: int | None = None,
) -> DataFrame:
    """``df`` with ``target`` as the cleaned ``source``; the same text as ``clean_text``.

    Most articles hold no mark-up and no agency. A byte search for what a pattern needs
    is several times cheaper than the pattern, which decodes the text and steps through
    it. Every step is a column of its own, so that its result is computed once though it
    is used several times; all steps are one stage of generated code. Later filters on
    the text do not recompute it.
    """
    kept = [c for c in df.columns if c != target]
    order = df.columns if target in df.columns else [*kept, target]
    text = F.col("_clean")

    def step(frame: DataFrame, change: Column, needs=None) -> DataFrame:
        if needs is not None:
            change = F.when(_holds(text, needs), change).otherwise(text)
        return frame.select(*kept, change.alias("_clean"))

    start = cleaning.drop_delimiters(F.coalesce(F.col(source), F.lit("")))
    df = df.select(*kept, cleaning.drop_header_lines(start).alias("_clean"))
    df = step(df, cleaning.drop_markup(text), ("<", "&"))
    df = step(df, cleaning.drop_byline_only(text, byline_max_chars), AGENCIES)
    df = step(df, plain_spaces(text))
    df = step(df, join_spaces(text), ("  ",))
    return computed_once(df, target, F.trim(text)).select(*order)
