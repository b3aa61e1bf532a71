"""Incremental learning: new data and new classes on top of a trained head.

- ``grow_labels``: the label dictionary of an earlier version with the new labels behind it; an index once
  given never moves, so stored predictions and weights keep their meaning. Every row says in which
  version it came.
- ``grown_weights``: the earlier head with one more row per new class, the mean of the old rows, so a new
  class starts as likely as an average one.
- ``replay_sample``: old training rows to train along with the new ones, so old classes are not forgotten:
  a keyed share of every class, at least ``LEAST`` rows of each, by a digest of the row's id (the same
  rows on every run, a filter on the scan).
- ``learn``: per-batch training (``batches``) from the grown weights over new rows and replayed rows.

Everything but the dictionary and the head (one row per class) stays distributed.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterspark.operators import batches as B
from utterspark.operators.labels import MAX_BROADCAST_LABELS
from utterspark.operators.ranking import global_rank
from utterspark.operators.split import ID_COLS, shuffle_key
from utterspark.session import broadcast_if_bounded, materialize

LEAST = 32
EPOCHS = 10


def grow_labels(labels: DataFrame, df: DataFrame, col: str = "intent") -> DataFrame:
    """``(label, idx, version)``: ``labels`` (label, idx and, after the first increment, version) as it is,
    and the labels of ``df`` that it does not have, in order, behind its last index. NULL is no label."""
    if "version" not in labels.columns:
        labels = labels.withColumn("version", F.lit(1))
    labels = materialize(labels.select("label", F.col("idx").cast("int").alias("idx"), F.col("version").cast("int").alias("version")))
    last, version = labels.agg(F.coalesce(F.max("idx"), F.lit(-1)), F.coalesce(F.max("version"), F.lit(0))).first()
    known = broadcast_if_bounded(labels.select("label"), MAX_BROADCAST_LABELS)
    new = df.select(F.col(col).alias("label")).where(F.col("label").isNotNull()).distinct().join(known, "label", "left_anti")
    new = global_rank(new, ["label"], rank_col="_r", size_col=None)
    return labels.unionByName(new.select("label", (F.col("_r") + last).cast("int").alias("idx"), F.lit(version + 1).alias("version")))


def replay_sample(old: DataFrame, rows: int, label_col: str = "intent", id_cols: Sequence[str] = ID_COLS, least: int = LEAST, seed: int | str = 42) -> DataFrame:
    """About ``rows`` rows of ``old`` in the proportions of its labels, but at least about ``least`` of each
    label that has them (all of a smaller one). NULL labels form a class of their own."""
    sizes = materialize(old.groupBy(F.col(label_col).alias("_label")).agg(F.count(F.lit(1)).alias("_n")))
    total = sizes.agg(F.sum("_n")).first()[0] or 0
    share = F.greatest(F.lit(rows / max(total, 1)), F.lit(float(least)) / F.col("_n"))
    share = broadcast_if_bounded(sizes.select("_label", share.alias("_share")), MAX_BROADCAST_LABELS)
    u = F.conv(F.substring(shuffle_key(f"{seed}|replay", id_cols), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return old.join(share, F.col(label_col).eqNullSafe(F.col("_label"))).where(u < F.col("_share")).select(*old.columns)


def grown_weights(weights: np.ndarray, n_classes: int) -> np.ndarray:
    """(classes x features and a bias) with the mean of the old rows for every new class."""
    if n_classes < len(weights):
        raise ValueError("a head cannot lose classes")
    new = np.tile(weights.mean(axis=0), (n_classes - len(weights), 1)) if len(weights) else np.zeros((n_classes, weights.shape[1]))
    return np.concatenate([weights, new])


def weights_of(models: DataFrame, epoch: int) -> np.ndarray:
    """The head of an epoch of ``models`` (one row per class)."""
    rows = models.where(F.col("epoch") == epoch).orderBy("class_idx").collect()
    return np.array([[*r["w"], r["b"]] for r in rows])


def learn(old: DataFrame, new: DataFrame, weights: np.ndarray, n_classes: int, dim: int, id_col: str, replay_rows: int | None = None,
          epochs: int = EPOCHS, lr: float = B.LEARNING_RATE, seed: int = 42, tasks: int | None = None):
    """``(history, models)`` of training on the train rows of ``new`` and a replay sample of those of ``old``,
    from the grown ``weights``; valid rows of both measure every epoch. ``old`` and ``new`` have the
    columns of :func:`batches.fit_softmax_batches` (``id_col``, x, y, w, split, batch_id).

    ``replay_rows`` is as many as there are new rows if not given.
    """
    columns = [id_col, "x", "y", "w", "split", "batch_id"]
    train = new.where(F.col("split") == "train")
    if replay_rows is None:
        replay_rows = train.count()
    replayed = replay_sample(old.where(F.col("split") == "train").select(*columns), replay_rows, "y", [id_col], seed=seed)
    # the valid batches of old and new rows stay apart
    valid = old.where(F.col("split") == "valid").select(*columns[:-1], (F.col("batch_id") * 2).alias("batch_id")).unionByName(
        new.where(F.col("split") == "valid").select(*columns[:-1], (F.col("batch_id") * 2 + 1).alias("batch_id")))
    rows = materialize(train.select(*columns).unionByName(replayed).unionByName(valid))
    return B.fit_softmax_batches(rows, n_classes, dim, id_col, epochs, lr, tasks, seed, start=grown_weights(weights, n_classes))
