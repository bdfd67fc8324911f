"""Exact de-duplication that keeps the first copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import broadcast_if_small, written


def text_key(text: Column) -> Column:
    """32 bytes that stand for a text."""
    return F.unhex(F.sha2(text, 256))


def first_copies(df: DataFrame, key: str, order: str, *carried: str) -> DataFrame:
    """One row per ``key``: the smallest ``order`` and what its row carries.

    Only these narrow columns are shuffled, after each task has combined its own
    copies: however many rows share one text, a task sends one of them.
    """
    return df.groupBy(key).agg(
        F.min(order).alias(order),
        *(F.min_by(name, order).alias(name) for name in carried),
    )


def later_copies(narrow: DataFrame, key: str, order: str) -> DataFrame:
    """``(order)`` of every row whose ``key`` appears in a row with a smaller ``order``. Stored.

    Keys that appear once leave the job at the first, partial count. The others' first rows
    meet all rows again; they are few, and if not, Spark's skew join divides a hot key.
    """
    counts = narrow.groupBy(key).agg(F.min(order).alias("_first"), F.count("*").alias("_n"))
    copied = written(counts.where("_n > 1").select(key, "_first"), "copied")
    later = narrow.join(broadcast_if_small(copied), key).where(F.col(order) > F.col("_first"))
    return written(later.select(order), "later-copies")


def without(df: DataFrame, losers: DataFrame, order: str) -> DataFrame:
    """Rows of ``df`` less those named. A few losers are sent to the rows, not the rows to them."""
    return df.join(broadcast_if_small(losers), order, "left_anti")


def keep_first(df: DataFrame, order: str, text: str = "text") -> DataFrame:
    """Rows of ``df`` whose text appears in no row with a smaller ``order``.

    ``order`` is unique. The survivor of ``dropDuplicates`` would be any copy; here
    it is the first one. Texts and their hashes are stored once, where they are computed; only
    hashes and numbers are shuffled, and the later copies are taken out of the stored table.
    A null text is one text of its own. The stored hash takes the place of a column ``_key``.
    """
    hashed = F.coalesce(text_key(F.col(text)), F.lit(bytearray()))
    staged = written(df.withColumn("_key", hashed), "staged")
    losers = later_copies(staged.select(order, "_key"), "_key", order)
    return without(staged, losers, order).select(*df.columns)
