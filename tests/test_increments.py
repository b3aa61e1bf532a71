"""Incremental learning: indices that never move, replay, and a new class that is usable."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from utterspark.operators import batches as B
from utterspark.operators import epochs as EP
from utterspark.operators import increments as I
from utterspark.operators import labels as L

KIND = "uid long, x array<double>, y int, w double, split string, batch_id long"


def planted(spark, classes, per_class, dim=8, seed=0, first=0):
    """Rows around one center per class; the centers are those of seed 99."""
    centers = np.random.default_rng(99).normal(size=(10, dim)) * 2
    r, rows, counts = np.random.default_rng(seed), [], {}
    for i in range(len(classes) * per_class):
        y = classes[i % len(classes)]
        split = ("train", "train", "valid", "test")[i // len(classes) % 4]
        k = counts[split] = counts.get(split, -1) + 1
        rows.append((first + i, (centers[y] + r.normal(size=dim)).tolist(), y, 1.0, split, k // 32))
    return spark.createDataFrame(rows, KIND).repartition(3).cache()


def accuracy(df, models, epoch):
    return EP.score_with(df.where(F.col("split") == "test"), models, epoch).agg(F.avg((F.col("pred_idx") == F.col("y")).cast("double"))).first()[0]


def test_indices_never_move(spark):
    words = lambda *x: spark.createDataFrame([(w,) for w in x], "intent string")
    v1 = L.fit_labels(words("m", "z", "m"))
    v2 = I.grow_labels(v1, words("a", "z", None, "k", "a"))
    v3 = I.grow_labels(v2, words("b", "m", "Z"))
    got = sorted((r.idx, r.label, r.version) for r in v3.collect())
    assert got == [(0, "m", 1), (1, "z", 1), (2, "a", 2), (3, "k", 2), (4, "Z", 3), (5, "b", 3)]
    same = I.grow_labels(v3, words("z", None))
    assert sorted((r.idx, r.label, r.version) for r in same.collect()) == got
    assert [tuple(r) for r in I.grow_labels(words().select(F.col("intent").alias("label"), F.lit(0).alias("idx")), words("q")).collect()] == [("q", 0, 1)]


def test_replay_has_the_proportions_and_the_least(spark):
    rows = [(i, "big") for i in range(6_000)] + [(10_000 + i, "mid") for i in range(3_000)] + [(20_000 + i, "small") for i in range(20)] + [(30_000 + i, None) for i in range(200)]
    df = spark.createDataFrame(rows, "uid long, intent string")
    got = {r.intent: r.n for r in I.replay_sample(df, 900, id_cols=["uid"], least=50).groupBy("intent").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert 480 < got["big"] < 700 and 220 < got["mid"] < 380 and got["small"] == 20 and 25 < got[None] < 80
    a, b = (sorted(r.uid for r in I.replay_sample(df.repartition(n), 900, id_cols=["uid"]).collect()) for n in (1, 6))
    assert a == b and len(a) == len(set(a))
    assert I.replay_sample(df.limit(0), 10, id_cols=["uid"]).count() == 0


def test_a_grown_head_scores_old_classes_as_before():
    r = np.random.default_rng(1)
    w, x = r.normal(size=(4, 7)), r.normal(size=(50, 6))
    grown = I.grown_weights(w, 6)
    z = x @ grown[:, :-1].T + grown[:, -1]
    assert np.array_equal(z[:, :4], x @ w[:, :-1].T + w[:, -1]) and np.allclose(z[:, 4], z[:, :4].mean(axis=1)) and grown.shape == (6, 7)
    with pytest.raises(ValueError):
        I.grown_weights(w, 3)


def test_a_new_class_is_usable_and_old_ones_are_kept(spark):
    old, new = planted(spark, [0, 1, 2, 3], 400), planted(spark, [4], 160, seed=5, first=10_000)
    _, models = B.fit_softmax_batches(old, 4, 8, "uid", epochs=6)
    before = accuracy(old, models, 6)
    hist, grown = I.learn(old, new, I.weights_of(models, 6), 5, 8, "uid", epochs=6)
    assert before > 0.85 and accuracy(new, grown, 6) > 0.85
    assert accuracy(old, grown, 6) >= before - 0.03
    assert hist.count() == 6 and hist.where("valid_acc > 0.8").count() > 0


def test_without_replay_old_classes_are_forgotten_more(spark):
    old, new = planted(spark, [0, 1, 2, 3], 400), planted(spark, [4], 400, seed=5, first=10_000)
    _, models = B.fit_softmax_batches(old, 4, 8, "uid", epochs=6)
    start = I.weights_of(models, 6)
    kept = accuracy(old, I.learn(old, new, start, 5, 8, "uid", epochs=8, lr=0.1)[1], 8)
    lost = accuracy(old, B.fit_softmax_batches(new, 5, 8, "uid", epochs=8, lr=0.1, start=I.grown_weights(start, 5))[1], 8)
    assert kept > lost


def test_without_new_rows_the_weights_come_from_replay_only(spark):
    old = planted(spark, [0, 1], 64)
    weights = np.zeros((2, 9))
    hist, models = I.learn(old, old.limit(0), weights, 2, 8, "uid", epochs=2)
    assert hist.count() == 2 and I.weights_of(models, 2).shape == (2, 9)
