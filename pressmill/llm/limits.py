"""Bounds on what is broadcast and on what a Python worker holds at once."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressmill import session

BROADCAST_ENTRIES = 1 << 19
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_enough(table: DataFrame, entries: Column | None = None, most: int = BROADCAST_ENTRIES) -> DataFrame:
    """A written table with a broadcast hint if its counted entries are few.

    An entry is a row of some numbers or, where ``entries`` tells their number, one of the
    structs of numbers in a row's list. Beyond the bound the table is returned as it is, and
    Spark joins by sorting and shuffling.
    """
    size = table.agg(F.sum(F.lit(1) if entries is None else entries + 1)).first()[0] or 0
    return F.broadcast(table) if size <= most else table


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Arrow batches of at most ``rows`` for the jobs that run inside.

    Rows with whole texts or sets are kilobytes each; the default batch of ten thousand would
    take most of a worker's memory. The session's setting is put back afterwards, so a table that
    is returned without having been written gets the batches of whoever runs it.
    """
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def written(df: DataFrame, name: str, batch_rows: int = BATCH_ROWS, codec: str | None = None) -> DataFrame:
    """``df`` written to scratch and read back, with Arrow batches of at most ``batch_rows``."""
    with small_batches(df.sparkSession, batch_rows):
        return session.written(df, name, codec)


def inner_names(columns: list[str]) -> tuple[list[Column], list[str], list[Column]]:
    """Columns under names that nothing else has, these names, and the columns under their own again."""
    names = [f"carried_{i}" for i in range(len(columns))]
    into = [F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)]
    return into, names, [F.col(n).alias(c) for c, n in zip(columns, names)]
