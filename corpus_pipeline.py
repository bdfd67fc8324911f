"""From raw documents to packed sequences: five stages, each on all that the one before kept.

Every stage but the last returns the columns of ``documents``, in their order. ``n_chars`` is
the length of the text as a stage leaves it (null for a null text).

A stage whose texts come back from Python workers returns a stored table: so they pass through in
small Arrow batches, whatever the session's setting is when the table is read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressmill.llm.decontamination import find_items
from pressmill.llm.jaccard import jaccard_components
from pressmill.llm.limits import small_enough, written
from pressmill.llm.lines import dedup_lines
from pressmill.llm.packing import pack
from pressmill.llm.toxicity import fit_toxicity, score_toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
OTHERS = ("doc_id", "lang", "source", "n_chars")

# The stages are models, hashes and joins over whole texts; no SQL states their rows.
ORACLE_SQL = None


def _kept(docs: DataFrame, stage: str) -> DataFrame:
    return written(docs, f"stage-{stage}", codec="zstd")  # such tables are whole texts and stay in scratch


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half. Trained on the labelled ones among ``docs``.

    A null or empty text is not toxic and stays.
    """
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _kept(score_toxicity(docs.select(*COLUMNS), model).where("score < 0.5").select(*COLUMNS), "toxicity")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less their later repeated runs of lines. A text of which nothing is left goes.

    A text that had no line to begin with stays as it is.
    """
    kept = dedup_lines(docs, carry=OTHERS)
    left = kept.where("n_removed < n_lines or n_lines = 0")
    text = F.col("kept")
    changed = F.when(F.col("n_removed") > 0, F.length(text).cast("long")).otherwise(F.col("n_chars"))
    return _kept(left.select("doc_id", text.alias("text"), "lang", "source", changed.alias("n_chars")), "line_dedup")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; five words, similarity 0.8.

    Rows with a null id stay. Rows that repeat an id that stays all stay.
    """
    groups = jaccard_components(docs)
    losers = written(groups.where("component_id <> doc_id").select("doc_id").distinct(), "losers")
    return docs.select(*COLUMNS).join(small_enough(losers), "doc_id", "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an item of the benchmark."""
    found = find_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=COLUMNS)
    return _kept(found.where(F.size("hits") == 0).select(*COLUMNS), "decontamination")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens, with their ids."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what more than one later job reads is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
