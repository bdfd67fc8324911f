"""Summary tables of predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.fixed import AI
from ..functions.rounding import round1_exact, round1_scaled

# The family of reports: name -> group columns.
FAMILY = {
    "summary_by_year_source": ("year", "source"),
    "summary_by_year_category": ("year", "category"),
    "summary_by_year": ("year",),
}

def _totals() -> list[Column]:
    return [
        F.count("*").alias("n_articles"),
        F.count_if(F.col("pred_label") == AI).alias("_n_ai"),
        F.avg("confidence").alias("_confidence"),
    ]


def _percentages() -> list[Column]:
    n, n_ai = F.col("n_articles").cast("double"), F.col("_n_ai")
    return [
        "n_articles",
        round1_exact(F.lit(100.0) * (F.lit(1.0) - n_ai / n)).alias("human_pct"),
        round1_exact(n_ai * F.lit(100.0) / n).alias("ai_pct"),
        round1_scaled(F.col("_confidence") * 100).alias("mean_conf_pct"),
    ]


def summarize(scored: DataFrame, group: Sequence[str], ordered: bool = False) -> DataFrame:
    """Articles, class shares and mean confidence per group; null keys are groups.

    Group columns the table lacks are left out; with none left there is one group.
    A group may hold any share of the rows: tasks combine before they shuffle.
    """
    keys = [name for name in group if name in scored.columns]
    if not keys:
        scored, keys = scored.withColumn("_all", F.lit("all")), ["_all"]
    table = scored.groupBy(*keys).agg(*_totals()).select(*keys, *_percentages())
    return table.orderBy(*(F.asc_nulls_last(key) for key in keys)) if ordered else table


def available_reports(
    columns: Sequence[str], family: dict[str, Sequence[str]] | None = None
) -> dict[str, tuple[str, ...]]:
    """The reports a table allows: each with its group columns that the table has."""
    family = FAMILY if family is None else family
    kept = {name: tuple(c for c in keys if c in columns) for name, keys in family.items()}
    return {name: keys for name, keys in kept.items() if keys}


def summarize_family(
    scored: DataFrame, family: dict[str, Sequence[str]] | None = None
) -> DataFrame:
    """All reports of the family from one pass over the predictions.

    ``report`` names the table a line belongs to, which also tells a null key from
    a key that the report does not have. Reports that lack of columns makes equal
    are there once, under the last of their names.
    """
    reports = {keys: name for name, keys in available_reports(scored.columns, family).items()}
    keys = list(dict.fromkeys(c for columns in reports for c in columns))
    grouped = scored.groupingSets([list(columns) for columns in reports], *keys).agg(
        F.grouping_id().alias("_set"), *_totals()
    )
    report = F.lit(None).cast("string")
    for columns, name in reports.items():
        # One bit per key, the first key highest; a set bit is a key left out.
        bits = sum(1 << (len(keys) - 1 - i) for i, key in enumerate(keys) if key not in columns)
        report = F.when(F.col("_set") == bits, name).otherwise(report)
    return grouped.select(report.alias("report"), *keys, *_percentages())


def one_report(
    family_table: DataFrame, name: str, family: dict[str, Sequence[str]] | None = None
) -> DataFrame:
    """One report of ``summarize_family`` with its own columns, in order."""
    reports = available_reports(family_table.columns, family)
    keys = reports[name]
    stored_as = [other for other, columns in reports.items() if columns == keys][-1]
    measures = ["n_articles", "human_pct", "ai_pct", "mean_conf_pct"]
    table = family_table.where(F.col("report") == stored_as).select(*keys, *measures)
    return table.orderBy(*(F.asc_nulls_last(key) for key in keys))


def prediction_totals() -> dict[str, Column]:
    """What the totals of a batch are computed from, as aggregates of its rows."""
    return {
        "n_articles": F.count(F.lit(1)),
        "n_ai": F.count_if(F.col("pred_label") == AI),
        "confidence": F.avg("confidence"),
    }


def totals_table(counted: DataFrame) -> DataFrame:
    """Share of AI text and mean confidence of counted rows; null for an empty batch."""
    n = F.nullif(F.col("n_articles"), F.lit(0)).cast("double")
    return counted.select(
        "n_articles",
        "n_ai",
        round1_exact(F.col("n_ai") * F.lit(100.0) / n).alias("ai_pct"),
        round1_exact(F.col("confidence") * 100).alias("mean_conf_pct"),
    )


def batch_totals(scored: DataFrame) -> DataFrame:
    """The totals of a table of predictions, in one row."""
    return totals_table(scored.agg(*(t.alias(name) for name, t in prediction_totals().items())))
