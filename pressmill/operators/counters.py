"""Counts and profiles of a corpus: one pass of partial and final aggregation each."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.fixed import AI_ERA_START, HUMAN
from ..functions.metadata import ai_era


def class_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count("*").alias("n"))


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; null values are not counted."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), column)


def counts_by_year(df: DataFrame) -> DataFrame:
    """Rows per year in the order of years; rows without a year are not counted."""
    known = df.where(F.col("year").isNotNull())
    return known.groupBy("year").agg(F.count("*").alias("n")).orderBy("year")


def year_profile(df: DataFrame) -> DataFrame:
    """First and last year and the rows from the years of AI text, in one row."""
    return df.agg(
        F.count("*").alias("n_articles"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.count_if(F.col("year") >= AI_ERA_START).alias("n_ai_era"),
    )


def contamination(df: DataFrame, *by: str) -> DataFrame:
    """Rows of the human class that may hold AI text, beside all rows of that class."""
    return df.groupBy(*by).agg(
        F.count_if(ai_era(F.col("label"), F.col("year"))).alias("n_ai_era"),
        F.count_if(F.col("label") == HUMAN).alias("n_human"),
    )


def split_counts(df: DataFrame) -> DataFrame:
    """Rows in all, per split, and per split and class, in one rollup.

    The total has neither split nor label, a split's own line no label.
    """
    return df.rollup("split", "label").agg(F.count("*").alias("n"))


def split_statistics(df: DataFrame) -> DataFrame:
    """The same counts as one nested row: total, train, val, test, class_distribution.

    The rollup has at most four lines per class, so gathering them is harmless.
    """
    per_class = df.groupBy("split", "label").agg(F.count("*").alias("n"))
    per_split = per_class.groupBy("split").agg(
        F.sum("n").alias("n"),
        F.map_from_entries(
            F.sort_array(F.collect_list(F.struct(F.col("label").cast("string"), "n")))
        ).alias("classes"),
    )

    def size(split: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("split") == split, F.col("n"))), F.lit(0))

    return per_split.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        *(size(split).alias(split) for split in ("train", "val", "test")),
        F.map_from_entries(F.collect_list(F.struct("split", "classes"))).alias(
            "class_distribution"
        ),
    )


def stage_counts(df: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """Rows that reach each stage, from one pass over per-row conditions."""
    return df.agg(*(F.count_if(reached).alias(name) for name, reached in stages.items()))
