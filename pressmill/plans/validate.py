"""Scoring jobs over whole collections, with their reports."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators import summary
from ..operators.scoring import Scorer, score_table
from ..operators.summary import prediction_totals
from ..sources.dumps import PLACE, load_categories, load_dumps
from ..sources.sinks import write_predictions
from ..sources.tables import read_csv


def score_years(
    spark: SparkSession, folder: str, scorer: Scorer, output_dir: str | None = None
) -> DataFrame:
    """Scores all CSV files of a folder; files without a year have it in their name."""
    corpus = read_csv(spark, f"{folder}/*.csv", year_from_name=True).drop("path", "pos")
    return _finish(score_table(corpus, scorer), output_dir)


def score_categories(
    spark: SparkSession,
    folder: str,
    scorer: Scorer,
    output_dir: str | None = None,
    exclude: Collection[str] | None = None,
) -> DataFrame:
    """Scores a folder of categories, whose classes are not known."""
    corpus = load_categories(
        spark, folder, label=None, exclude=exclude, fallback=False
    ).drop("path", *PLACE)
    return _finish(score_table(corpus, scorer), output_dir)


def score_batch(
    spark: SparkSession, path: str, scorer: Scorer, text: str = "text"
) -> DataFrame:
    """Scores one CSV file, or one dump parsed on the fly."""
    if path.endswith(".txt"):
        corpus = load_dumps(spark, path, label=None)
    else:
        corpus = read_csv(spark, path)
    return score_table(corpus.drop("path", "pos", *PLACE), scorer, text)


def store_batch(
    spark: SparkSession, path: str, scorer: Scorer, output_dir: str, batch: str, text: str = "text"
) -> dict:
    """Scores one batch, stores its predictions and totals, and returns the totals.

    Predictions are a table divided by ``batch``. A batch that is run again, or after a failure, takes
    the place of its own part and leaves all others alone. The totals are those of the very pass that
    stores: articles, AI articles, share of AI text and mean confidence in percent (null for no articles).
    """
    scored = score_batch(spark, path, scorer, text)
    if "batch" in scored.columns:
        raise ValueError("the table has a column batch, by which predictions are stored")
    seen = Observation()
    scored = scored.observe(seen, *(t.alias(n) for n, t in prediction_totals().items()))
    _replace_part(scored, f"{output_dir}/predictions", batch)
    totals = spark.createDataFrame([seen.get], "n_articles long, n_ai long, confidence double")
    totals = summary.totals_table(totals)
    _replace_part(totals, f"{output_dir}/totals", batch)
    return totals.first().asDict()


def _replace_part(df: DataFrame, path: str, batch: str) -> None:
    """Stores ``df`` as the part ``batch`` of a table, in place of what it held before."""
    writer = df.withColumn("batch", F.lit(batch)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def _finish(scored: DataFrame, output_dir: str | None) -> DataFrame:
    """With an output folder, store predictions and reports and read the former back."""
    if output_dir is None:
        return scored
    write_predictions(scored, output_dir)
    return scored.sparkSession.read.parquet(f"{output_dir}/predictions_full")
