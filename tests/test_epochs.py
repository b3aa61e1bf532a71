"""Epoch training against a brute-force numpy run of the same steps."""

import numpy as np

from utterspark.operators import epochs as EP
from utterspark.operators import metrics as M


def _numpy_run(X, y, w, train, C, epochs, lr):
    Wb = np.zeros((C, X.shape[1] + 1))
    opt = EP._AdamW(Wb.shape, lr=lr)
    Xt, yt, wt = X[train], y[train], w[train]
    out = []
    for _ in range(epochs):
        z = Xt @ Wb[:, :-1].T + Wb[:, -1]
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        r = p.copy()
        r[np.arange(len(yt)), yt] -= 1
        g = np.hstack([(wt[:, None] * r).T @ Xt, (wt[:, None] * r).sum(0)[:, None]]) / wt.sum()
        Wb = opt.step(Wb, g)
        out.append(Wb.copy())
    return out


def test_softmax_epochs_brute_force(spark):
    rng = np.random.default_rng(5)
    n, D, C = 60, 3, 3
    X = rng.normal(size=(n, D))
    y = (X[:, 0] > 0).astype(int) + (X[:, 1] > 0.5).astype(int)
    w = np.where(y == 0, 1.5, 1.0)
    split = np.array(["train" if i % 4 else "valid" for i in range(n)])
    rows = [(X[i].tolist(), int(y[i]), float(w[i]), str(split[i]), i // 8) for i in range(n)]
    df = spark.createDataFrame(rows, "x array<double>, y int, w double, split string, batch_id long")
    hist, models = EP.fit_softmax_epochs(df, C, D, epochs=4, lr=0.3)
    want = _numpy_run(X, y, w, split == "train", C, 4, 0.3)
    got = {(r["epoch"], r["class_idx"]): r["w"] + [r["b"]] for r in models.collect()}
    for e in range(1, 5):
        for c in range(C):
            assert np.allclose(got[(e, c)], want[e - 1][c], atol=1e-9)
    h = sorted(hist.collect(), key=lambda r: r["epoch"])
    assert [r["epoch"] for r in h] == [1, 2, 3, 4]
    # valid accuracy: mean of per-batch accuracies with that epoch's weights
    for r in h:
        Wb = want[r["epoch"] - 1]
        pred = (X @ Wb[:, :-1].T + Wb[:, -1]).argmax(1)
        va = [np.mean(pred[(split == "valid") & (np.arange(n) // 8 == bt)] == y[(split == "valid") & (np.arange(n) // 8 == bt)])
              for bt in sorted(set(np.arange(n)[split == "valid"] // 8))]
        assert abs(r["valid_acc"] - np.mean(va)) < 1e-9
    best = M.best_epoch(hist).first()["best_epoch"]
    accs = [r["valid_acc"] for r in h]
    first_best = next((i + 1 for i, a in enumerate(accs) if a > 0 and a > max([0.0] + accs[:i])
                       and a == max(accs)), None)
    assert best == first_best


def test_hashed_bow(spark):
    from pyspark.sql import functions as F

    from utterspark.plans.model_plans import hashed_bow

    df = spark.createDataFrame([(1, "a a b"), (2, ""), (3, "  ")], "uid long, text string")
    got = {r["uid"]: dict(zip(r["x"]["idx"], r["x"]["val"])) for r in hashed_bow(df, "uid", 4).collect()}
    buckets = {r["t"]: r["b"] for r in spark.createDataFrame([("a",), ("b",)], "t string")
               .select("t", F.pmod(F.xxhash64("t"), F.lit(4)).alias("b")).collect()}
    want = np.zeros(4)
    want[buckets["a"]] += 2
    want[buckets["b"]] += 1
    want /= np.linalg.norm(want)
    assert np.allclose([got[1].get(i, 0.0) for i in range(4)], want)
    assert got[2] == {} and got[3] == {}


def test_sparse_features_train_like_dense_ones(spark):
    rng = np.random.default_rng(6)
    X = np.where(rng.random((40, 6)) < 0.4, rng.normal(size=(40, 6)), 0.0)
    rows = [(X[i].tolist(), (np.flatnonzero(X[i]).tolist(), X[i][X[i] != 0].tolist()), i % 3, 1.0, "train" if i % 4 else "valid", i // 8) for i in range(40)]
    df = spark.createDataFrame(rows, "d array<double>, s struct<idx:array<int>,val:array<double>>, y int, w double, split string, batch_id long")
    (h1, m1), (h2, m2) = (EP.fit_softmax_epochs(df, 3, 6, epochs=3, x=c) for c in "ds")
    assert np.allclose([list(r) for r in h1.orderBy("epoch").collect()], [list(r) for r in h2.orderBy("epoch").collect()])
    p1, p2 = (sorted(tuple(r.p) for r in EP.score_with(df, m, 3, x=c).collect()) for m, c in ((m1, "d"), (m2, "s")))
    assert np.allclose(p1, p2)
