"""Row filters and the checks a corpus must pass."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, functions as F

from ..functions.fixed import AI, DEFAULT_EXCLUDED_CATEGORIES, HUMAN, MAX_LENGTH, MIN_LENGTH


def with_length(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("text_len", F.length(text))


def within_length(df: DataFrame, shortest: int = MIN_LENGTH, longest: int = MAX_LENGTH) -> DataFrame:
    """Both ends included; expects ``text_len`` of the cleaned text."""
    return df.where(F.col("text_len").between(shortest, longest))


def without_categories(df: DataFrame, exclude: Collection[str] | None = None) -> DataFrame:
    """None leaves out the default categories; an empty collection leaves out none."""
    excluded = DEFAULT_EXCLUDED_CATEGORIES if exclude is None else tuple(exclude)
    return df.where(~F.col("category").isin(*excluded)) if excluded else df


def within_years(df: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """A row without a year is dropped by either bound."""
    if last is not None:
        df = df.where(F.col("year") <= last)
    if first is not None:
        df = df.where(F.col("year") >= first)
    return df


def of_class(df: DataFrame, label: int) -> DataFrame:
    return df.where(F.col("label") == label)


def complete(df: DataFrame) -> DataFrame:
    """Rows that have both a text and a label."""
    return df.dropna(subset=["text", "label"])


def labelled(df: DataFrame) -> DataFrame:
    return df.where(F.col("label").isNotNull())


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def require_both_classes(n_human: int, n_ai: int) -> None:
    if not n_human or not n_ai:
        raise ValueError(f"both classes are required (human={n_human}, AI={n_ai})")


def count_classes(df: DataFrame) -> tuple[int, int]:
    """Number of rows of either class (an action)."""
    row = df.agg(
        F.count_if(F.col("label") == HUMAN).alias("human"),
        F.count_if(F.col("label") == AI).alias("ai"),
    ).first()
    return row.human, row.ai
