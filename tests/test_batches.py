"""Per-batch training: one task equals a plain loop, several tasks reach the same accuracy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from utterspark.operators import batches as B
from utterspark.operators import epochs as EP

KIND = "uid long, x array<double>, y int, w double, split string, batch_id long"


def rows(n=600, dim=6, classes=3, seed=0):
    r = np.random.default_rng(seed)
    centers = r.normal(size=(classes, dim)) * 1.5
    out, counts = [], {}
    for i in range(n):
        y = int(r.integers(classes))
        split = "train" if i % 4 else "valid"
        k = counts[split] = counts.get(split, -1) + 1
        out.append((i, (centers[y] + r.normal(size=dim)).tolist(), y, 1.5 if y == 0 else 1.0, split, k // 32))
    return out


def plain(data, ids, classes, dim, epochs, lr, seed=42):
    """A loop over batches with dense gradients; the order of rows is the operator's."""
    x, y, w = np.array([d[1] for d in data]), np.array([d[2] for d in data]), np.array([d[3] for d in data])
    W, m, v, t, history = np.zeros((classes, dim + 1)), 0.0, 0.0, 0, []
    for e in range(1, epochs + 1):
        order, losses, accs = B.batch_order(ids, seed, e), [], []
        for lo in range(0, len(order), 32):
            b = order[lo:lo + 32]
            xb = np.hstack([x[b], np.ones((len(b), 1))])
            z = xb @ W.T
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            losses.append(-np.log(p[np.arange(len(b)), y[b]]).mean() * w[b].mean())
            accs.append((z.argmax(axis=1) == y[b]).mean())
            g = (p - np.eye(classes)[y[b]]).T @ xb / len(b) * w[b].mean()
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            W = W - lr * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8) - lr * 0.01 * W
        history.append((np.mean(losses), np.mean(accs)))
    return W, history


def weights_of(models, epoch):
    return np.array([[*r.w, r.b] for r in models.where(F.col("epoch") == epoch).orderBy("class_idx").collect()])


def test_one_task_equals_a_plain_loop(spark):
    data = rows()
    df = spark.createDataFrame(data, KIND).repartition(3)
    hist, models = B.fit_softmax_batches(df, 3, 6, "uid", epochs=4, lr=0.05, tasks=1)
    ids = {r.uid: r.h for r in df.select("uid", F.xxhash64("uid").alias("h")).collect()}
    train = [d for d in data if d[4] == "train"]
    want, figures = plain(train, np.array([ids[d[0]] for d in train]), 3, 6, 4, 0.05)
    assert np.allclose(weights_of(models, 4), want, rtol=0, atol=1e-12)
    got = [(r.train_loss, r.train_acc) for r in hist.orderBy("epoch").collect()]
    assert np.allclose(got, figures, rtol=0, atol=1e-12)
    assert abs(got[0][0] - figures[0][0]) < 1e-12  # the first batch's loss is taken at zero weights
    assert got[0][0] < np.log(3) * 1.5 and got[-1][0] < got[0][0]


def test_four_tasks_reach_the_same_validation_accuracy(spark):
    df = spark.createDataFrame(rows(2_000, seed=3), KIND).repartition(4).cache()
    last = []
    for tasks in (1, 4):
        hist, _ = B.fit_softmax_batches(df, 3, 6, "uid", epochs=8, lr=0.05, tasks=tasks)
        last.append(hist.agg(F.max("valid_acc")).first()[0])
    assert last[0] > 0.8 and abs(last[0] - last[1]) <= 0.01


def test_sparse_and_dense_rows_give_the_same_model(spark):
    df = spark.createDataFrame(rows(300), KIND)
    sparse = df.withColumn("x", F.struct(F.sequence(F.lit(0), F.lit(5)).alias("idx"), F.col("x").alias("val")))
    a, b = (weights_of(B.fit_softmax_batches(d, 3, 6, "uid", epochs=2, tasks=2)[1], 2) for d in (df, sparse))
    assert np.array_equal(a, b)


def test_epochs_reshuffle_and_layout_does_not_matter(spark):
    ids = np.arange(1000)
    assert not np.array_equal(B.batch_order(ids, 42, 1), B.batch_order(ids, 42, 2))
    assert sorted(B.batch_order(ids, 42, 1).tolist()) == ids.tolist()
    df = spark.createDataFrame(rows(300), KIND)
    a, b = (weights_of(B.fit_softmax_batches(df.repartition(n), 3, 6, "uid", epochs=2, tasks=3)[1], 2) for n in (1, 5))
    assert np.array_equal(a, b)


def test_an_epoch_does_not_shuffle_rows(spark):
    dealt = B.deal(spark.createDataFrame(rows(100), KIND), 2, "uid")
    shared = spark.sparkContext.broadcast((*[np.zeros((3, 7))] * 3, 0))
    steps = dealt.mapInArrow(B._epoch_task(shared, 1, 6, 0.1, 42, 4), "c int, at int, g binary")
    assert "Exchange" not in steps._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("keep", ["valid", "none"])
def test_without_train_rows(spark, keep):
    df = spark.createDataFrame(rows(64), KIND).where(F.col("split") == keep)
    hist, models = B.fit_softmax_batches(df, 3, 6, "uid", epochs=2)
    assert [r.train_loss for r in hist.collect()] == [None, None] and not weights_of(models, 2).any()


def test_scores_with_the_chosen_epoch(spark):
    df = spark.createDataFrame(rows(400, seed=5), KIND)
    _, models = B.fit_softmax_batches(df, 3, 6, "uid", epochs=5, lr=0.05)
    got = EP.score_with(df, models, 5)
    assert got.where("pred_idx = y").count() > 0.8 * 400
