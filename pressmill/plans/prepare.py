"""The dataset-preparation job: load, clean, filter, de-duplicate, balance, split, store."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.fixed import HUMAN, MAX_LENGTH, MIN_LENGTH, SEED, TRAIN_SHARE, VAL_SHARE
from ..functions.metadata import ai_era
from ..operators.cleaning import with_clean_text
from ..operators.counters import split_statistics
from ..operators.dedup import first_copies, later_copies, text_key, without
from ..operators.filters import require_columns, with_length, within_length
from ..operators.sampling import balanced, split_of
from ..session import written
from ..sources.sinks import write_small, write_splits
from ..sources.tables import read_mixed, unlabelled_dumps

SPLIT_NAMES = ("train", "val", "test")


def cleaned(corpus: DataFrame) -> DataFrame:
    """Cleaned text and its length in characters."""
    return with_length(with_clean_text(corpus))


def unique_rows(measured: DataFrame, key: str = "article_id") -> DataFrame:
    """``(text_key, key, label, text_len)`` of the first copy of every text.

    No text is shuffled: tasks measure and hash it where they scan it, and copies
    meet as hashes. The smallest ``key`` is the first copy.
    """
    narrow = measured.select(key, "label", "text_len", text_key(F.col("text")).alias("text_key"))
    return first_copies(narrow, "text_key", key, "label", "text_len")


@dataclass(frozen=True)
class Prepared:
    """A prepared corpus, and the rows left after every stage as the passes counted them."""

    rows: DataFrame
    chosen: DataFrame
    stages: dict[str, int]
    contamination: dict[str, int]


def _observed(df: DataFrame, name: str, observation: Observation, **metrics) -> DataFrame:
    """``df`` stored, with metrics of the very pass that stores it."""
    return written(df.observe(observation, *(m.alias(n) for n, m in metrics.items())), name)


def prepared(
    corpus: DataFrame,
    key: str = "article_id",
    seed: int = SEED,
    shortest: int = MIN_LENGTH,
    longest: int = MAX_LENGTH,
    train_share: float = TRAIN_SHARE,
    val_share: float = VAL_SHARE,
    sample_key: str | None = None,
) -> Prepared:
    """The balanced and split corpus with cleaned text, ``text_len`` and ``split``.

    A text is cleaned, measured, hashed and stored once, where it is scanned. Copies meet as hashes; the
    sample and the split are conditions on literals. So the stored table is read once more, and its
    rows pass two filters on their way out: no body is shuffled, and none of the surplus is carried.
    Rows are drawn by ``sample_key`` (by default ``key``); ``text_key`` is the hash of the text in hexadecimal digits.
    """
    require_columns(corpus, "text", "label", key)
    long_enough = F.col("text_len").between(shortest, longest)
    loading, deduplicating = Observation(), Observation()
    year = F.col("year") if "year" in corpus.columns else F.lit(None).cast("int")
    staged = cleaned(corpus).withColumn("text_key", F.hex(text_key(F.col("text"))))
    staged = _observed(
        staged, "cleaned", loading,
        loaded=F.count(F.lit(1)), length=F.count_if(long_enough),
        n_human=F.count_if(F.col("label") == HUMAN), n_ai_era=F.count_if(ai_era(F.col("label"), year)),
    )
    kept = within_length(staged, shortest, longest)
    narrow = kept.select(*dict.fromkeys([key, "label", "text_key"]))
    losers = later_copies(narrow, "text_key", key)
    unique = _observed(without(narrow, losers, key), "unique", deduplicating, unique=F.count(F.lit(1)))
    draw = sample_key or key
    in_sample = balanced(unique, seed, draw)
    chosen = unique.where(in_sample)
    split = split_of(chosen, seed, draw, train_share, val_share)
    chosen = chosen.withColumn("split", split)
    rows = without(kept, losers, key).where(in_sample).withColumn("split", split)
    counts = loading.get
    stages = {"loaded": counts["loaded"], "length": counts["length"], "unique": deduplicating.get["unique"]}
    return Prepared(rows, chosen, stages, {n: counts[n] for n in ("n_ai_era", "n_human")})


def prepare(corpus: DataFrame, key: str = "article_id", seed: int = SEED, **options) -> DataFrame:
    """The rows of ``prepared``: ``corpus`` with cleaned text, ``text_len`` and ``split``."""
    return prepared(corpus, key, seed, **options).rows.drop("text_key")


def load_order(corpus: DataFrame) -> DataFrame:
    """Adds ``article_id``: unique, and in load order as a string."""
    return corpus.withColumn("article_id", F.concat_ws("#", "kind", "path", "pos")).drop(
        "kind", "path", "pos"
    )


def prepare_dataset(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    shortest: int = MIN_LENGTH,
    longest: int = MAX_LENGTH,
    train_share: float = TRAIN_SHARE,
    val_share: float = VAL_SHARE,
    seed: int = SEED,
    txt_label: int | None = None,
    fmt: str = "parquet",
) -> dict:
    """Prepares a folder of CSV tables and dumps, stores splits and statistics.

    Parsing and cleaning run once. Rows are sampled by the hash of their text, which is unique by
    then and does not depend on how the files were read. Returns the statistics, the rows left
    after every stage, the rows of the human class from the years that are in doubt, and how many dumps
    were left out because their name tells no class; these are listed in ``rejected_files``.
    """
    corpus = load_order(read_mixed(spark, input_dir, txt_label))
    done = prepared(
        corpus, "article_id", seed, shortest, longest, train_share, val_share, sample_key="text_key"
    )
    write_splits(done.rows.drop("text_key"), f"{output_dir}/splits", fmt)
    statistics = split_statistics(done.chosen)
    write_small(statistics, f"{output_dir}/statistics")
    row = statistics.first().asDict(recursive=True)
    rejected = 0
    if txt_label is None:
        unlabelled = unlabelled_dumps(spark, input_dir)
        write_small(unlabelled, f"{output_dir}/rejected_files")
        rejected = unlabelled.count()
    return {
        **row,
        "stages": {**done.stages, "balanced": row["total"]},
        "contamination": done.contamination,
        "rejected_files": rejected,
    }
