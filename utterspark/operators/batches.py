"""Per-batch training of a softmax head: AdamW steps on reshuffled mini-batches, averaged over tasks.

The training rows are dealt once into partitions of about ``ROWS_PER_TASK`` rows by the hash of their id
and written to the shared checkpoint folder. An epoch is one Spark job without a shuffle of rows: every
task puts its rows in a new order (a hash of seed, epoch and id), takes one step per batch of 32 from
the weights all tasks start from, and returns its weights and moments, in blocks, times its share of all
batches; Spark sums the blocks of all tasks. A lost task is simply run again, which a barrier stage
would not allow.

Loss and accuracy of a batch are taken before its step, the loss is the batch's mean loss times its
mean weight, and an epoch's figures are plain means over batches, as in the flow this follows. With one
task the result is that of a plain loop. Every epoch's weights are kept for the choice of the model.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterspark.operators import epochs as EP
from utterspark.operators import metrics as M
from utterspark.session import materialize, ship_package

# Rows a batch and epochs of the canonical flow. The learning rate is ours (a linear head).
BATCH_ROWS = 32
EPOCHS = 30
LEARNING_RATE = 0.02

ROWS_PER_TASK = 50_000


def batch_order(ids: np.ndarray, seed: int, epoch: int) -> np.ndarray:
    """The rows' order in an epoch: by a hash of seed, epoch and id (ties by id)."""
    x = ids.astype(np.int64).view(np.uint64) ^ np.uint64((seed * 1_000_003 + epoch) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return np.lexsort((ids, x ^ (x >> np.uint64(31))))


class Stepper:
    """AdamW (decoupled weight decay) on the weights (classes x features and a bias) batch by batch."""

    def __init__(self, weights: np.ndarray, m: np.ndarray, v: np.ndarray, t: int, lr: float):
        self.w, self.m, self.v, self.t, self.lr = weights.copy(), m.copy(), v.copy(), t, lr

    def step(self, row: np.ndarray, feature: np.ndarray, value: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
        """(weighted loss, accuracy) of the batch before its step."""
        n = len(y)
        used, at = np.unique(feature, return_inverse=True)
        x = np.zeros((n, len(used)))
        np.add.at(x, (row, at), value)
        z = x @ self.w[:, used].T + self.w[:, -1]
        top = z.max(axis=1, keepdims=True)
        e = np.exp(z - top)
        loss = np.log(e.sum(axis=1)) + top[:, 0] - z[np.arange(n), y]
        r = e / e.sum(axis=1, keepdims=True)
        r[np.arange(n), y] -= 1.0
        r *= weight.mean() / n
        g = np.zeros(self.w.shape)
        g[:, used] = r.T @ x
        g[:, -1] = r.sum(axis=0)
        b1, b2 = EP.BETAS
        self.t += 1
        self.m = b1 * self.m + (1 - b1) * g
        self.v = b2 * self.v + (1 - b2) * g * g
        move = self.m / (1 - b1 ** self.t) / (np.sqrt(self.v / (1 - b2 ** self.t)) + EP.ADAM_EPS)
        self.w = self.w - self.lr * move - self.lr * EP.WEIGHT_DECAY * self.w
        return float(loss.mean() * weight.mean()), float((z.argmax(axis=1) == y).mean())


def run_epoch(stepper: Stepper, x: tuple, y: np.ndarray, w: np.ndarray, order: np.ndarray) -> tuple[float, float, int]:
    """(sum of batch losses, sum of batch accuracies, batches); ``x`` is (row starts, features, values)."""
    starts, feature, value = x
    losses = accuracies = 0.0
    for lo in range(0, len(order), BATCH_ROWS):
        rows = order[lo:lo + BATCH_ROWS]
        size = starts[rows + 1] - starts[rows]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(starts[rows] - (ends - size), size)
        loss, accuracy = stepper.step(np.repeat(np.arange(len(rows)), size), feature[at], value[at], y[rows], w[rows])
        losses, accuracies = losses + loss, accuracies + accuracy
    return losses, accuracies, -(-len(order) // BATCH_ROWS)


def _epoch_task(shared, epoch: int, dim: int, lr: float, seed: int, batches_in_all: int):
    def run(batches):
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        t = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        row, feature, value = EP._sparse(t, dim)
        starts = np.searchsorted(row, np.arange(len(t) + 1))
        weights, m, v, steps = shared.value
        s = Stepper(weights, m, v, steps, lr)
        order = batch_order(t.column("id").to_numpy(), seed, epoch)
        figures = run_epoch(s, (starts, feature, value), t.column("y").to_numpy(), t.column("w").to_numpy(), order)
        share = figures[2] / batches_in_all
        cells = [(k * len(weights) + c, at, (x[c, at:at + EP.BLOCK] * share).tobytes())
                 for k, x in enumerate((s.w, s.m, s.v)) for c in range(len(weights)) for at in range(0, dim + 1, EP.BLOCK)]
        cells.append((-1, 0, np.array(figures, float).tobytes()))
        yield pa.RecordBatch.from_pydict({"c": pa.array([x[0] for x in cells], pa.int32()), "at": pa.array([x[1] for x in cells], pa.int32()),
                                          "g": pa.array([x[2] for x in cells], pa.binary())})
    return run


def deal(df: DataFrame, tasks: int, id_col: str, x: str = "x", y: str = "y", w: str = "w") -> DataFrame:
    """The rows in ``tasks`` partitions by the hash of their id, written once."""
    rows = df.select(*EP._features(df, x), F.col(y).cast("int").alias("y"), F.col(w).cast("double").alias("w"), F.xxhash64(id_col).alias("id"))
    return materialize(rows.repartition(tasks, "id"))


def fit_softmax_batches(df: DataFrame, n_classes: int, dim: int, id_col: str, epochs: int = EPOCHS, lr: float = LEARNING_RATE,
                        tasks: int | None = None, seed: int = 42, x: str = "x", y: str = "y", w: str = "w",
                        split: str = "split", batch: str = "batch_id", start: np.ndarray | None = None):
    """Train on ``split = 'train'`` rows; returns ``(history, models)`` like :func:`epochs.fit_softmax_epochs`.

    ``id_col`` names a row; ``batch`` numbers the batches of the valid rows. Train figures are those before
    each step; without train or valid rows the figures are NULL and the weights stay as they start: zero, or
    ``start`` (classes x features and a bias).
    """
    spark = df.sparkSession
    ship_package(spark)
    train = df.where(F.col(split) == "train")
    rows = train.count()
    tasks = tasks or max(1, -(-rows // ROWS_PER_TASK))
    dealt = deal(train, tasks, id_col, x, y, w)
    per_task = dealt.groupBy(F.spark_partition_id()).count().select("count").toPandas()["count"].to_numpy()  # one number a task
    in_all, most = int((-(-per_task // BATCH_ROWS)).sum()), int((-(-per_task // BATCH_ROWS)).max(initial=0))
    valid = df.where(F.col(split) == "valid").select(
        *EP._features(df, x), F.col(y).cast("int").alias("y"), F.col(w).cast("double").alias("w"), F.col(split).alias("split"), F.col(batch).cast("long").alias("batch_id"))
    state = [np.zeros((n_classes, dim + 1)) if k or start is None else np.array(start, float) for k in range(3)]
    steps, history, kept = 0, [], []
    for e in range(1, epochs + 1):
        figures = None
        if in_all:
            shared = spark.sparkContext.broadcast((*state, steps))
            blocks = dealt.mapInArrow(_epoch_task(shared, e, dim, lr, seed, in_all), "c int, at int, g binary")
            state = [np.zeros((n_classes, dim + 1)) for _ in range(3)]
            for r in blocks.groupBy("c", "at").applyInArrow(EP._sum_blocks, "c int, at int, g binary").collect():  # the size of the model
                block = np.frombuffer(r["g"], np.float64)
                if r["c"] < 0:
                    figures = block
                else:
                    state[r["c"] // n_classes][r["c"] % n_classes, r["at"]:r["at"] + len(block)] = block
            shared.destroy()
            steps += most
        kept.append(state[0])
        check = valid.mapInArrow(EP._metric_task(state[0], e), "epoch int, split string, batch_id long, loss double, w double, correct boolean")
        seen = M.epoch_metrics(check).first()
        means = [None, None] if figures is None else [float(figures[0] / figures[2]), float(figures[1] / figures[2])]
        history.append((e, *means, *([None, None] if seen is None else [seen["valid_loss"], seen["valid_acc"]])))
    hist = spark.createDataFrame(history, "epoch int, train_loss double, train_acc double, valid_loss double, valid_acc double")
    return hist, EP.model_rows(spark, kept, n_classes, dim)
