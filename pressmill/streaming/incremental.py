"""Scoring dumps as they arrive.

Parsing, cleaning and scoring work row by row, so the batch functions run on a stream
unchanged. Sampling and splitting need all rows and stay batch jobs. A streamed file is
read whole; very large dumps are for the batch readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import metadata as meta
from ..functions.blanks import fold_newlines
from ..operators.articles import corpus_rows, parse_dumps
from ..operators.scoring import Scorer, score_table


def stream_dumps(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """New dump files below a folder as ``(path, value)``."""
    stream = (
        spark.readStream.format("text")
        .option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.txt")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )
    return stream.select(
        meta.decoded_path(F.col("_metadata.file_path")).alias("path"),
        fold_newlines(F.make_valid_utf8("value")).alias("value"),
    )


def score_new_dumps(
    spark: SparkSession, folder: str, scorer: Scorer, output: str, checkpoint: str
) -> StreamingQuery:
    """Scores what is new since the last call, then stops.

    The file sink and the checkpoint together give every file exactly once.
    """
    articles = corpus_rows(parse_dumps(stream_dumps(spark, folder)), label=None)
    return (
        score_table(articles, scorer)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
