"""Continuous scoring: incoming vectors -> logits -> probabilities -> decisions.

Stateless: every micro-batch is scored with the same static model, attached
by a stream-static broadcast join of bounded size, so the streaming result
equals the batch result row for row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from utterspark.operators.decide import CONFIDENCE_THRESHOLD, decide
from utterspark.operators.scoring import linear_logits, with_probabilities


def score_stream(stream: DataFrame, model: DataFrame, labels: DataFrame, vec_col: str = "embedding",
                 scale: float = 1.0, threshold: float = CONFIDENCE_THRESHOLD) -> DataFrame:
    scored = with_probabilities(linear_logits(stream, model, vec_col, "z", scale))
    return decide(scored, labels, threshold)


def score_text_stream(stream: DataFrame, model, labels: DataFrame, text_col: str = "text",
                      threshold: float = CONFIDENCE_THRESHOLD) -> DataFrame:
    """Incoming text -> the fitted pipeline (tokens, hashed terms, weighted
    multinomial model) -> decisions. Every stage is row-wise, so the fitted
    model transforms the stream as it transforms a table; empty inputs are
    rejected first, as the prediction loop does."""
    from utterspark.operators.corpus import valid_inputs
    from utterspark.operators.training import score

    return decide(score(model, valid_inputs(stream, text_col)), labels, threshold)
