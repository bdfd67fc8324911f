"""Classification metrics and summaries over runs.

Every metric is a function of the confusion matrix, which is the only thing computed
from the rows: classes squared lines per group, after partial aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.fixed import REPORT_NAMES

METRICS = ("accuracy", "f1", "precision", "recall")


def confusion(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    rows = df.where(F.col("label").isNotNull() & F.col("pred_label").isNotNull())
    return rows.groupBy(*by, "label", "pred_label").agg(F.count("*").alias("n"))


def _ratio(part: Column, whole: Column) -> Column:
    """0 where there is nothing to divide by, as for a class nobody predicted."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def per_class(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of every class that is true or predicted."""
    hit = F.when(F.col("label") == F.col("pred_label"), F.col("n")).otherwise(0)
    sides = confusion(df, by).select(
        *by,
        F.inline(
            F.array(
                F.struct(
                    F.col("label").alias("class"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("predicted"),
                    hit.alias("hits"),
                ),
                F.struct(
                    F.col("pred_label").alias("class"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("long").alias("hits"),
                ),
            )
        ),
    )
    table = sides.groupBy(*by, "class").agg(
        F.sum("support").alias("support"),
        F.sum("predicted").alias("predicted"),
        F.sum("hits").alias("hits"),
    )
    precision = _ratio(F.col("hits"), F.col("predicted"))
    recall = _ratio(F.col("hits"), F.col("support"))
    return table.select(
        *by,
        "class",
        precision.alias("precision"),
        recall.alias("recall"),
        _ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
        "hits",
    )


def classification_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and macro F1, precision and recall: every class counts the same."""
    return (
        per_class(df, by)
        .groupBy(*by)
        .agg(
            _ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
            F.avg("f1").alias("f1"),
            F.avg("precision").alias("precision"),
            F.avg("recall").alias("recall"),
        )
    )


def classification_report(
    df: DataFrame, by: Sequence[str] = (), names: Mapping[int, str] = REPORT_NAMES
) -> DataFrame:
    """``(section, metric, value)`` lines: each class, accuracy, macro and weighted means."""
    classes = per_class(df, by)
    name = F.col("class").cast("string")
    for label, title in names.items():
        name = F.when(F.col("class") == label, title).otherwise(name)

    def lines(section: Column, **values: Column) -> Column:
        return F.array(
            *(
                F.struct(
                    section.alias("section"),
                    F.lit(metric).alias("metric"),
                    value.cast("double").alias("value"),
                )
                for metric, value in values.items()
            )
        )

    own = classes.select(
        *by,
        F.inline(
            lines(
                name,
                **{
                    "precision": F.col("precision"),
                    "recall": F.col("recall"),
                    "f1-score": F.col("f1"),
                    "support": F.col("support"),
                },
            )
        ),
    )

    def weighted(metric: str) -> Column:
        return _ratio(F.sum(F.col(metric) * F.col("support")), F.sum("support"))

    means = classes.groupBy(*by).agg(
        _ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        F.sum("support").alias("support"),
        *(F.avg(m).alias(f"macro_{m}") for m in ("precision", "recall", "f1")),
        *(weighted(m).alias(f"weighted_{m}") for m in ("precision", "recall", "f1")),
    )
    overall = means.select(
        *by,
        F.inline(
            F.concat(
                lines(F.lit("accuracy"), accuracy=F.col("accuracy")),
                *(
                    lines(
                        F.lit(f"{kind} avg"),
                        **{
                            "precision": F.col(f"{kind}_precision"),
                            "recall": F.col(f"{kind}_recall"),
                            "f1-score": F.col(f"{kind}_f1"),
                            "support": F.col("support"),
                        },
                    )
                    for kind in ("macro", "weighted")
                ),
            )
        ),
    )
    return own.unionByName(overall)


def multi_run_summary(runs: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Mean, population deviation, least, greatest and all values of each metric."""
    long = runs.unpivot("run_id", list(metrics), "metric", "value")
    return long.groupBy("metric").agg(
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.transform(
            F.sort_array(F.collect_list(F.struct("run_id", "value"))), lambda r: r["value"]
        ).alias("per_run"),
    )


def best_run(runs: DataFrame, metric: str = "f1") -> DataFrame:
    """The run with the highest value; of several, the first.

    Choosing among runs is a selection: prefer a metric of the validation rows.
    """
    return runs.orderBy(F.desc(metric), "run_id").limit(1)
