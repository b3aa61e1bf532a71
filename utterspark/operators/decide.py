"""Turning probabilities into decisions: threshold, UNKNOWN rule, accepted labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterspark.functions.arrays import top_k
from utterspark.functions.text import INVALID_LABEL

# The decision threshold and the decision outputs.
CONFIDENCE_THRESHOLD = 0.6
UNKNOWN_LABEL = "UNKNOWN"
REASON_LOW_CONFIDENCE = "low_confidence"
REASON_INVALID = "invalid_intent"
REASON_NONE_ACCEPTED = "no_valid_prediction"


def _class_names(labels: DataFrame) -> DataFrame:
    """One row, ``_names``: labels in idx order (bounded by the class count)."""
    return labels.agg(F.array_sort(F.collect_list(F.struct("idx", "label"))).alias("_s")).select(
        F.lit(0).alias("_k"), F.transform("_s", lambda s: s["label"]).alias("_names"))


def with_class_names(df: DataFrame, labels: DataFrame) -> DataFrame:
    return (df.withColumn("_k", F.lit(0)).join(F.broadcast(_class_names(labels)), "_k").drop("_k"))


def apply_threshold(df: DataFrame, invalid_idx: int, threshold: float = CONFIDENCE_THRESHOLD,
                    out: str = "eval_idx") -> DataFrame:
    """Evaluation rule: below the threshold the row counts as the INVALID class.

    ``invalid_idx`` is looked up in the label dictionary (pass 0 for the
    index-0 behaviour).
    """
    return df.withColumn(out, F.when(F.col("p_max") < F.lit(threshold), F.lit(invalid_idx))
                         .otherwise(F.col("pred_idx")).cast("int"))


def accepted(threshold: float, names_col: str = "_names", p_col: str = "p"):
    """All non-INVALID classes with ``p >= threshold``, probability desc (ties: lower idx)."""
    # filter first, then order the few that are left by (-p, idx)
    cand = F.transform(F.col(p_col), lambda p, i: F.struct((-p).alias("neg"), i.alias("idx")))
    keep = F.filter(cand, lambda s: (-s["neg"] >= F.lit(threshold))
                    & (F.element_at(F.col(names_col), s["idx"] + 1) != F.lit(INVALID_LABEL)))
    return F.transform(F.sort_array(keep), lambda s: F.struct(
        F.element_at(F.col(names_col), s["idx"] + 1).alias("label"), (-s["neg"]).alias("probability")))


def decide(df: DataFrame, labels: DataFrame, threshold: float = CONFIDENCE_THRESHOLD) -> DataFrame:
    """Adds ``decision`` ARRAY<STRUCT<label, probability, reason>>.

    INVALID arg-max or ``p_max < threshold`` -> one UNKNOWN entry with
    probability 0.0 (low confidence wins as the reason); otherwise the accepted
    labels; if none is accepted, UNKNOWN with its own reason.
    """
    named = with_class_names(df, labels)
    top_label = F.element_at(F.col("_names"), F.col("pred_idx") + 1)
    low = F.col("p_max") < F.lit(threshold)
    unknown = lambda reason: F.array(F.struct(
        F.lit(UNKNOWN_LABEL).alias("label"), F.lit(0.0).alias("probability"), reason.alias("reason")))
    acc = F.transform(accepted(threshold), lambda s: F.struct(
        s["label"].alias("label"), s["probability"].alias("probability"),
        F.lit(None).cast("string").alias("reason")))
    decision = (F.when(low, unknown(F.lit(REASON_LOW_CONFIDENCE)))
                 .when(top_label == F.lit(INVALID_LABEL), unknown(F.lit(REASON_INVALID)))
                 .when(F.size(acc) == 0, unknown(F.lit(REASON_NONE_ACCEPTED)))
                 .otherwise(acc))
    return named.withColumn("decision", decision).drop("_names")


def with_top_k(df: DataFrame, labels: DataFrame, k: int = 3) -> DataFrame:
    """Adds ``top`` ARRAY<STRUCT<idx, label, probability>> of the k best classes."""
    named = with_class_names(df, labels)
    top = F.transform(top_k("p", k), lambda s: F.struct(
        s["idx"].alias("idx"), F.element_at(F.col("_names"), s["idx"] + 1).alias("label"),
        s["p"].alias("probability")))
    return named.withColumn("top", top).drop("_names")
