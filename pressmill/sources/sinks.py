"""Writers: every task writes its own files, nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators.summary import available_reports, one_report, summarize_family
from .tables import CSV_FORMAT

# A CSV file is one task for whoever reads it.
CSV_FILE_BYTES = 64 * 1024 * 1024
ROWS_PER_FILE = 1 << 20
_STEPS = (4, 7, 10, 13, 16, 20)


def rows_per_file(df: DataFrame, most_bytes: int = CSV_FILE_BYTES) -> int:
    """The greatest number of rows of which no file will hold more than about ``most_bytes``.

    A task cuts its files behind every so many rows. So rows are measured in stretches of 16, 128, 1024, …
    of each task, and the longest stretch counts of which the widest fits: a few very
    long texts, or many in a row, make files of fewer rows but none that is too large.
    """
    widths = (F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 1 for c in df.columns)
    rows = df.select(
        F.monotonically_increasing_id().alias("row"), reduce(lambda a, b: a + b, widths).alias("width")
    )
    stretches = rows.select("*", F.explode(F.array(*map(F.lit, _STEPS))).alias("step"))
    sums = stretches.groupBy("step", F.expr("shiftright(row, step)").alias("stretch")).agg(
        F.sum("width").alias("width"), F.max("width").alias("row")
    )
    widest = sums.groupBy("step").agg(F.max("width").alias("width"), F.max("row").alias("row")).collect()
    fitting = [1 << r["step"] for r in widest if r["width"] <= most_bytes]
    longest = max((r["row"] for r in widest), default=1)
    return max([*fitting, 1 if fitting else max(1, most_bytes // longest)]) if widest else ROWS_PER_FILE


def _writer(df: DataFrame, fmt: str):
    writer = df.write.mode("overwrite")
    if fmt != "csv":
        return writer.option("maxRecordsPerFile", ROWS_PER_FILE)
    return writer.options(**CSV_FORMAT).option("maxRecordsPerFile", rows_per_file(df))


def write_corpus(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """A parsed corpus; ``partition_by`` the category lets later reads skip categories."""
    writer = _writer(df, fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)


def write_splits(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The three splits as partitions of one table, in one job."""
    _writer(df, fmt).partitionBy("split").format(fmt).save(path)


def write_small(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Statistics, run results and reports: a handful of rows, as one file."""
    writer = df.coalesce(1).write.mode("overwrite")
    (writer.options(**CSV_FORMAT) if fmt == "csv" else writer).format(fmt).save(path)


def write_predictions(
    scored: DataFrame, path: str, fmt: str = "parquet", report_fmt: str = "csv"
) -> None:
    """All predictions and the reports of the family that the columns allow.

    Rows are scored once: the reports are computed from the stored predictions,
    of which they read the group and prediction columns only, in one pass.
    """
    stored_path = f"{path}/predictions_full"
    write_corpus(scored, stored_path, fmt)
    spark = scored.sparkSession
    reader = spark.read.schema(scored.schema)
    if fmt == "csv":
        reader = reader.options(**CSV_FORMAT, multiLine="true")
    stored = reader.format(fmt).load(stored_path)
    reports = available_reports(stored.columns)
    if not reports:
        return
    table = summarize_family(stored).cache()
    for name in reports:
        write_small(one_report(table, name), f"{path}/{name}", report_fmt)
    table.unpersist()
