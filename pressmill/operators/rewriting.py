"""Rewrite requests as a table, and their answers as rows of the AI class.

Calling a service is left to the caller: this makes the prompts of a whole table, and
joins a table of answers back.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.blanks import strip
from ..functions.fixed import AI


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """The template with its placeholders replaced by columns.

    It is cut at the placeholders once, so a text that itself contains something
    like a placeholder stays as it is.
    """
    pieces = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if name is not None:
            pieces.append(F.coalesce(values[name].cast("string"), F.lit("")))
    return F.concat(*pieces)


def rewrite_requests(
    df: DataFrame,
    template: str,
    newspaper: Column | str = "source",
    text: str = "text",
    key: str = "article_id",
) -> DataFrame:
    """``(article_id, prompt)``; the template names ``{newspaper_name}`` and ``{article_text}``."""
    newspaper = F.col(newspaper) if isinstance(newspaper, str) else newspaper
    prompt = fill_template(template, {"newspaper_name": newspaper, "article_text": F.col(text)})
    return df.select(key, prompt.alias("prompt"))


def attach_rewrites(
    corpus: DataFrame, answers: DataFrame, key: str = "article_id", answer: str = "ai_text"
) -> DataFrame:
    """The corpus and, for every answered article, its rewrite as a row of the AI class.

    A rewrite carries the source and year of its original. Its key is the original's
    with ``:ai`` behind it.
    """
    carried = [c for c in ("source", "year") if c in corpus.columns]
    rewrites = (
        corpus.select(key, *carried)
        .join(answers.select(key, answer), key)
        .select(
            F.concat(F.col(key).cast("string"), F.lit(":ai")).alias(key),
            strip(F.col(answer)).alias("text"),
            *carried,
            F.lit(AI).alias("label"),
        )
    )
    originals = corpus.withColumn(key, F.col(key).cast("string"))
    return originals.unionByName(rewrites, allowMissingColumns=True)
