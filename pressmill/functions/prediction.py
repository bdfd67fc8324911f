"""From model output to prediction columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .fixed import AI, HEAD_WORDS, HUMAN, PREDICTION_NAMES

PREDICTION_COLUMNS = ("pred_label", "pred_label_name", "prob_human", "prob_ai", "confidence")


def head_words(text: Column, n: int = HEAD_WORDS) -> Column:
    """The first ``n`` words of a cleaned text."""
    return F.array_join(F.slice(F.split(text, " "), 1, n), " ")


def softmax_pair(human: Column, ai: Column) -> tuple[Column, Column]:
    """Probabilities of two logits, shifted by the larger so that exp cannot overflow."""
    top = F.greatest(human, ai)
    e_human, e_ai = F.exp(human - top), F.exp(ai - top)
    return e_human / (e_human + e_ai), e_ai / (e_human + e_ai)


def prediction_columns(prob_human: Column, prob_ai: Column) -> dict[str, Column]:
    """The five appended columns. A tie goes to the human class."""
    is_ai = prob_ai > prob_human
    return {
        "pred_label": F.when(is_ai, AI).otherwise(HUMAN),
        "pred_label_name": F.when(is_ai, PREDICTION_NAMES[AI]).otherwise(PREDICTION_NAMES[HUMAN]),
        "prob_human": prob_human,
        "prob_ai": prob_ai,
        "confidence": F.greatest(prob_human, prob_ai),
    }
