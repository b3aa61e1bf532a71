"""Epoch training of a linear softmax head with validation-based model choice.

Each epoch is one full-batch AdamW step whose gradient is a Spark job: the
current weights (classes x dimension, small, like any Spark ML model) go to
the tasks, a task sums its rows' sparse outer products in numpy and returns a
few blocks whatever its rows, and Spark sums the blocks of all tasks. One more
job per epoch gives the train/valid loss and accuracy with the reference's
batch semantics. Every epoch's weights are kept, so the chosen epoch's model
is the one evaluated.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from utterspark.functions.arrays import argmax, softmax
from utterspark.functions.slices import cuts_of, give_back
from utterspark.operators import metrics as M
from utterspark.session import ship_package

# Epochs of the canonical flow and AdamW's usual moments and
# weight decay. The learning rate is ours: one full-batch step per epoch on a
# linear head, not the reference's per-batch steps on a pretrained network.
EPOCHS = 30
LEARNING_RATE = 0.5
BETAS = (0.9, 0.999)
WEIGHT_DECAY = 0.01
ADAM_EPS = 1e-8


class _AdamW:
    """Decoupled-weight-decay Adam on the driver-held (classes x dim) weights."""

    def __init__(self, shape, lr=LEARNING_RATE, betas=BETAS, wd=WEIGHT_DECAY, eps=ADAM_EPS):
        self.m, self.v = np.zeros(shape), np.zeros(shape)
        self.lr, self.b1, self.b2, self.wd, self.eps, self.t = lr, betas[0], betas[1], wd, eps, 0

    def step(self, p: np.ndarray, g: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = self.b1 * self.m + (1 - self.b1) * g
        self.v = self.b2 * self.v + (1 - self.b2) * g * g
        mh, vh = self.m / (1 - self.b1 ** self.t), self.v / (1 - self.b2 ** self.t)
        return p - self.lr * mh / (np.sqrt(vh) + self.eps) - self.lr * self.wd * p


BLOCK = 8_192
SLICE_VALUES = 500_000  # feature values a task unpacks at a time


def _sparse(batch, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of a batch: sparse columns ``idx`` / ``val`` or a dense ``x``."""
    names = batch.schema.names
    col = batch.column("val" if "val" in names else "x")
    value = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(col)), np.diff(col.offsets.to_numpy()))
    if "idx" in names:
        return row, batch.column("idx").flatten().to_numpy(zero_copy_only=False).astype(np.int64), value
    return row, np.tile(np.arange(dim), len(col)), value


def _slices(batches):
    """Batches in slices of about ``SLICE_VALUES`` feature values: the temporaries of a task are a few dozen
    megabytes whatever the rows and the length of their texts."""
    for b in batches:
        column = b.column("val" if "val" in b.schema.names else "x")
        for lo, hi in cuts_of(column.offsets.to_numpy(), SLICE_VALUES):
            yield b.slice(lo, hi - lo)
    give_back()


def _logits(row, feature, value, n: int, weights: np.ndarray) -> np.ndarray:
    return np.stack([np.bincount(row, w[feature] * value, n) + w[-1] for w in weights], axis=1)


def _gradient_task(weights: np.ndarray):
    """Per task: the gradient sums of every class in blocks of features, and the weight total."""
    def run(batches):
        dim = weights.shape[1] - 1
        g, total = np.zeros(weights.shape), 0.0
        for b in _slices(batches):
            n = len(b)
            row, feature, value = _sparse(b, dim)
            y, w = b.column("y").to_numpy(zero_copy_only=False), b.column("w").to_numpy(zero_copy_only=False)
            z = _logits(row, feature, value, n, weights)
            r = np.exp(z - z.max(axis=1, keepdims=True))
            r /= r.sum(axis=1, keepdims=True)
            r[np.arange(n), y] -= 1.0
            r *= w[:, None]
            for c in range(len(weights)):
                g[c, :dim] += np.bincount(feature, value * r[row, c], dim)
            g[:, dim] += r.sum(axis=0)
            total += w.sum()
        cells = [(c, at, g[c, at:at + BLOCK].tobytes()) for c in range(len(g)) for at in range(0, dim + 1, BLOCK) if g[c, at:at + BLOCK].any()]
        cells.append((-1, 0, np.array([total]).tobytes()))
        yield pa.RecordBatch.from_pydict({"c": pa.array([x[0] for x in cells], pa.int32()), "at": pa.array([x[1] for x in cells], pa.int32()),
                                          "g": pa.array([x[2] for x in cells], pa.binary())})
    return run


def _sum_blocks(t: pa.Table) -> pa.Table:
    total = 0.0
    for x in t.column("g"):  # one block at a time, where it lies
        total = total + np.frombuffer(x.as_buffer(), np.float64)
    return pa.table({"c": t.column("c")[:1], "at": t.column("at")[:1], "g": pa.array([total.tobytes()], pa.binary())})


def _metric_task(weights: np.ndarray, epoch: int):
    def run(batches):
        for b in _slices(batches):
            n = len(b)
            y = b.column("y").to_numpy(zero_copy_only=False)
            z = _logits(*_sparse(b, weights.shape[1] - 1), n, weights)
            top = z.max(axis=1)
            loss = np.log(np.exp(z - top[:, None]).sum(axis=1)) + top - z[np.arange(n), y]
            yield pa.RecordBatch.from_pydict({"epoch": pa.array(np.full(n, epoch), pa.int32()), "split": b.column("split"), "batch_id": b.column("batch_id"),
                                              "loss": pa.array(loss), "w": b.column("w"), "correct": pa.array(z.argmax(axis=1) == y)})
    return run


def _features(df: DataFrame, x: str) -> list:
    """Feature columns: a struct of ``idx`` and ``val`` (sparse) or a dense array."""
    if isinstance(df.schema[x].dataType, StructType):
        return [F.col(f"{x}.idx").alias("idx"), F.col(f"{x}.val").cast("array<double>").alias("val")]
    return [F.col(x).cast("array<double>").alias("x")]


def fit_softmax_epochs(df: DataFrame, n_classes: int, dim: int, epochs: int = EPOCHS,
                       lr: float = LEARNING_RATE, x: str = "x", y: str = "y", w: str = "w",
                       split: str = "split", batch: str = "batch_id"):
    """Train on ``split = 'train'`` rows; returns ``(history, models)``.

    ``df``: ``x`` (ARRAY<DOUBLE>(dim), or STRUCT<idx, val> of sparse features
    below ``dim``), ``y INT``, ``w DOUBLE`` (sample weight), ``split``,
    ``batch_id``; it is read twice an epoch, so pass a materialised table.
    ``history``: one row per epoch (epoch, train_loss, train_acc, valid_loss,
    valid_acc) by :func:`metrics.epoch_metrics`; ``models``: (epoch, class_idx,
    w, b) for every epoch. Train figures are those of the epoch's final weights
    (measured after the step).
    """
    spark = df.sparkSession
    ship_package(spark)
    data = df.select(*_features(df, x), F.col(y).cast("int").alias("y"), F.col(w).cast("double").alias("w"),
                     F.col(split).alias("split"), F.col(batch).cast("long").alias("batch_id"))
    train = data.filter(F.col("split") == "train").drop("split", "batch_id")
    evalrows = data.filter(F.col("split").isin("train", "valid"))
    Wb = np.zeros((n_classes, dim + 1))  # weights with the bias as last column
    opt = _AdamW(Wb.shape, lr=lr)
    history, kept = [], []

    def gradient(weights) -> np.ndarray:
        # one block row per class and block of features from each task, summed in Spark:
        # what reaches the driver is one gradient, the size of the model
        parts = train.mapInArrow(_gradient_task(weights), "c int, at int, g binary")
        g, total = np.zeros((n_classes, dim + 1)), 1.0
        for r in parts.groupBy("c", "at").applyInArrow(_sum_blocks, "c int, at int, g binary").collect():
            block = np.frombuffer(r["g"], np.float64)
            if r["c"] < 0:
                total = max(float(block[0]), 1e-300)
            else:
                g[r["c"], r["at"]:r["at"] + len(block)] = block
        return g / total

    def epoch_row(e: int, weights):
        rows = evalrows.mapInArrow(_metric_task(weights, e), "epoch int, split string, batch_id long, loss double, w double, correct boolean")
        return M.epoch_metrics(rows).collect()

    # The metrics of epoch e - 1 and the gradient of epoch e read the same
    # weights and are independent: the two jobs run side by side.
    with ThreadPoolExecutor(max_workers=2) as pool:
        for e in range(1, epochs + 1):
            pending = pool.submit(epoch_row, e - 1, Wb) if e > 1 else None
            Wb = opt.step(Wb, gradient(Wb))
            if pending is not None:
                history.extend(pending.result())
            kept.append(Wb)
        history.extend(epoch_row(epochs, Wb))
    hist = spark.createDataFrame(history, "epoch int, train_loss double, train_acc double, "
                                          "valid_loss double, valid_acc double")
    return hist, model_rows(spark, kept, n_classes, dim)


def model_rows(spark, kept: list[np.ndarray], n_classes: int, dim: int) -> DataFrame:
    """(epoch, class_idx, w, b) of the weights (classes x features and a bias) after every epoch."""
    flat = [(e + 1, c) for e in range(len(kept)) for c in range(n_classes)]
    values = np.concatenate([k[:, :dim].ravel() for k in kept]) if kept else np.zeros(0)
    return spark.createDataFrame(pa.table({
        "epoch": pa.array([f[0] for f in flat], pa.int32()), "class_idx": pa.array([f[1] for f in flat], pa.int32()),
        "w": pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, dim, dtype=np.int32)), pa.array(values)),
        "b": pa.array([float(kept[e - 1][c, dim]) for e, c in flat], pa.float64())}))


def score_with(df: DataFrame, models: DataFrame, epoch: int, x: str = "x") -> DataFrame:
    """Adds ``z``, ``p``, ``pred_idx``, ``p_max`` with the weights of ``epoch``."""
    spark = df.sparkSession
    ship_package(spark)
    rows = models.filter(F.col("epoch") == epoch).orderBy("class_idx").collect()  # one row per class
    shared = spark.sparkContext.broadcast(np.array([[*r["w"], r["b"]] for r in rows]))
    sparse = isinstance(df.schema[x].dataType, StructType)

    def logits(batch):
        weights = shared.value
        z = np.concatenate([np.zeros((0, len(weights))), *(_logits(*_sparse(b, weights.shape[1] - 1), len(b), weights) for b in _slices([batch]))])
        return pa.ListArray.from_arrays(pa.array(np.arange(0, z.size + 1, len(weights)), pa.int32()), pa.array(z.ravel()))

    if sparse:
        @F.arrow_udf("array<double>")
        def run(idx: pa.Array, val: pa.Array) -> pa.Array:
            return logits(pa.RecordBatch.from_arrays([idx, val], ["idx", "val"]))
        z = run(F.col(f"{x}.idx"), F.col(f"{x}.val").cast("array<double>"))
    else:
        @F.arrow_udf("array<double>")
        def run(dense: pa.Array) -> pa.Array:
            return logits(pa.RecordBatch.from_arrays([dense], ["x"]))
        z = run(F.col(x).cast("array<double>"))
    out = df.withColumn("z", z).withColumn("p", softmax("z"))
    return out.withColumn("pred_idx", argmax("p")).withColumn("p_max", F.array_max("p"))
