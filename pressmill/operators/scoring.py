"""Scoring a table with a model or with a column expression.

A scorer is a function from the text column to an array column of two logits,
``[human, ai]``. ``model_scorer`` makes one from any model that works on batches.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.fixed import SCORE_BATCH
from ..functions.prediction import head_words, prediction_columns, softmax_pair
from .cleaning import with_clean_text

Scorer = Callable[[Column], Column]


def model_scorer(make_predict: Callable, batch_size: int = SCORE_BATCH) -> Scorer:
    """Scorer of a batch model.

    ``make_predict()`` runs once per Python worker, loads the model and returns a
    function from an array of texts to an array of shape (texts, 2).
    """
    return predict_batch_udf(
        make_predict, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size
    )


def expression_scorer(score: Callable[[Column], Column]) -> Scorer:
    """Scorer of an expression for the logit of the AI class against 0."""
    return lambda text: F.array(F.lit(0.0), score(text))


def score_table(
    df: DataFrame,
    scorer: Scorer,
    text: str = "text",
    clean: bool = True,
    max_words: int | None = None,
) -> DataFrame:
    """Appends the five prediction columns; no other column changes.

    The model sees the text cleaned as for training, while the stored text stays
    raw. Null and empty texts are scored as well. Rows are scored where they are.
    """
    kept = [F.col(name) for name in df.columns]
    if clean:
        scored = with_clean_text(df, text, "_seen")
    else:
        scored = df.withColumn("_seen", F.coalesce(F.col(text), F.lit("")))
    if max_words is not None:
        scored = scored.withColumn("_seen", head_words(F.col("_seen"), max_words))
    scored = scored.withColumn("_logits", scorer(F.col("_seen")))
    human, ai = softmax_pair(F.col("_logits")[0], F.col("_logits")[1])
    scored = scored.select(*kept, human.alias("_human"), ai.alias("_ai"))
    columns: Mapping[str, Column] = prediction_columns(F.col("_human"), F.col("_ai"))
    return scored.select(*kept, *(column.alias(name) for name, column in columns.items()))
