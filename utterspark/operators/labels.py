"""Label dictionary: fit (sorted), encode, decode, mapping.

The dictionary holds one row per class, so broadcasting it is bounded by the
number of classes; the bound is checked before the hint is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from utterspark.session import broadcast_if_bounded, materialize

MAX_BROADCAST_LABELS = 1_000_000


def fit_labels(df: DataFrame, col: str = "intent") -> DataFrame:
    """``(label, idx)``: distinct labels in code-point order, idx from 0."""
    distinct = materialize(df.select(F.col(col).alias("label")).filter(F.col("label").isNotNull()).distinct())
    # One row per class: the unpartitioned window sorts a class-sized table.
    return distinct.select("label", (F.dense_rank().over(Window.orderBy("label")) - 1).cast("int").alias("idx"))


def class_list(labels: DataFrame) -> DataFrame:
    return labels.agg(F.count(F.lit(1)).alias("n_classes"),
                      F.array_sort(F.collect_set("label")).alias("classes"))


def _small(labels: DataFrame) -> DataFrame:
    return broadcast_if_bounded(labels, MAX_BROADCAST_LABELS)


def encode_labels(df: DataFrame, labels: DataFrame, col: str = "intent", out: str = "label_idx",
                  unseen: str = "error") -> DataFrame:
    """label -> idx. ``unseen``: ``error`` raises, ``skip`` drops, ``keep`` leaves NULL."""
    lab = _small(labels.select(F.col("label").alias(col), F.col("idx").alias(out)))
    joined = df.join(lab, col, "left")
    if unseen == "error":
        # only the distinct labels are checked, not every row
        seen = df.select(col).where(F.col(col).isNotNull()).distinct()
        bad = seen.join(lab, col, "left_anti").limit(1).collect()
        if bad:
            raise ValueError(f"label {bad[0][0]!r} is not in the label dictionary")
        return joined
    if unseen == "skip":
        return joined.filter(F.col(out).isNotNull())
    if unseen == "keep":
        return joined
    raise ValueError(f"unknown unseen policy {unseen!r}")


def decode_labels(df: DataFrame, labels: DataFrame, idx_col: str = "pred_idx",
                  out: str = "pred_label") -> DataFrame:
    lab = _small(labels.select(F.col("idx").alias(idx_col), F.col("label").alias(out)))
    return df.join(lab, idx_col, "inner")


def label_mapping(labels: DataFrame) -> DataFrame:
    """Rows of the idx -> label document section (idx as its string key)."""
    return labels.select(F.col("idx").cast("string").alias("key"), "label")


def index_of(labels: DataFrame, label: str) -> int | None:
    row = labels.filter(F.col("label") == label).select("idx").collect()
    return int(row[0][0]) if row else None
