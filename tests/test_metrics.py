import random

import pytest

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from utterspark.operators import metrics as M
from utterspark.operators.labels import fit_labels


def _preds(spark, n=600, classes=5, seed=3):
    random.seed(seed)
    rows = []
    for i in range(n):
        y = random.randrange(classes)
        k = y if random.random() < 0.45 else random.randrange(classes)
        raw = [random.random() for _ in range(classes)]
        raw[y] += 0.3 * random.random()
        s = sum(raw)
        rows.append((i, y, k, [round(x / s, 3) for x in raw]))
    return spark.createDataFrame(rows, "id long, y int, k int, p array<double>")


def test_weighted_prf_matches_evaluator(spark):
    df = _preds(spark)
    w = M.weighted_prf(M.confusion(df, "y", "k")).first()
    ev = df.select(F.col("y").cast("double").alias("label"), F.col("k").cast("double").alias("prediction"))
    for metric, col in (("weightedPrecision", "precision"), ("weightedRecall", "recall"),
                        ("weightedFMeasure", "f1_score")):
        want = MulticlassClassificationEvaluator(metricName=metric).evaluate(ev)
        assert abs(w[col] - want) < 1e-10, metric
    acc = M.accuracy(df, "y", "k").first()[0]
    assert abs(acc - MulticlassClassificationEvaluator(metricName="accuracy").evaluate(ev)) < 1e-12


def test_fpr_matches_evaluator(spark):
    df = _preds(spark)
    labels = fit_labels(df.select(F.col("y").cast("string").alias("intent"))).select(
        F.col("label").cast("int").alias("idx"), "label")
    fpr = {r["class_idx"]: r["fpr"] for r in M.false_positive_rate(M.confusion(df, "y", "k"), labels).collect()}
    ev = df.select(F.col("y").cast("double").alias("label"), F.col("k").cast("double").alias("prediction"))
    for c in range(5):
        want = MulticlassClassificationEvaluator(metricName="falsePositiveRateByLabel",
                                                 metricLabel=float(c)).evaluate(ev)
        assert abs(fpr[c] - want) < 1e-12


def test_auc_matches_evaluator_and_symmetry(spark):
    df = _preds(spark)
    aucs = {r["class_idx"]: r["auc"] for r in M.auc_by_class(df).collect()}
    for c in range(5):
        b = df.select(F.col("p")[c].alias("s"), (F.col("y") == c).cast("double").alias("label"))
        rows = [(Vectors.dense([1 - r["s"], r["s"]]), r["label"]) for r in b.collect()]
        bdf = spark.createDataFrame(rows, ["rawPrediction", "label"])
        want = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0).evaluate(bdf)
        assert abs(aucs[c] - want) < 1e-9
    neg = df.withColumn("p", F.transform("p", lambda x: -x))
    for r in M.auc_by_class(neg).collect():
        assert abs(r["auc"] - (1 - aucs[r["class_idx"]])) < 1e-12


def test_absent_class_auc_is_null(spark):
    df = spark.createDataFrame([(0, [0.9, 0.1]), (0, [0.8, 0.2])], "y int, p array<double>")
    aucs = {r["class_idx"]: r["auc"] for r in M.auc_by_class(df).collect()}
    assert aucs == {0: None, 1: None}
    m = M.macro_auc(M.auc_by_class(df)).first()
    assert m["macro_auc"] is None and m["n_undefined"] == 2


def test_roc_curve_endpoints(spark):
    df = _preds(spark, n=200)
    roc = M.roc_curve(df)
    last = roc.groupBy("class_idx").agg(F.max("fpr").alias("f"), F.max("tpr").alias("t")).collect()
    assert all(abs(r["f"] - 1) < 1e-12 and abs(r["t"] - 1) < 1e-12 for r in last)


def test_class_report_rows(spark):
    df = _preds(spark)
    rep = {r["key"]: r for r in M.class_report(M.confusion(df, "y", "k")).collect()}
    assert set(rep) == {"0", "1", "2", "3", "4", "accuracy", "macro avg", "weighted avg"}
    assert rep["accuracy"]["support"] == 600


def test_latency_population_std(spark):
    df = spark.createDataFrame([(0.5,)], "value double")
    r = M.latency_stats(df).first()
    assert r["std_time"] == 0.0 and r["average_time"] == 0.5


def test_best_epoch_ties_and_zero(spark):
    h = spark.createDataFrame([(1, 0.5), (2, 0.7), (3, 0.7), (4, 0.6)], "epoch int, valid_acc double")
    assert M.best_epoch(h).first()["best_epoch"] == 2
    assert [r["epoch"] for r in M.improvement_epochs(h).orderBy("epoch").collect()] == [1, 2]
    z = spark.createDataFrame([(1, 0.0), (2, 0.0)], "epoch int, valid_acc double")
    assert M.best_epoch(z).first()["best_epoch"] is None


def _corners_brute(y, scores, c):
    """Distinct thresholds descending, cumulative counts, then keep first, last
    and every point where either count's second difference is non-zero."""
    import numpy as np

    pairs = sorted(zip(scores, y), key=lambda t: -t[0])
    th, tps, fps = [], [], []
    tp = fp = 0
    for i, (s, yy) in enumerate(pairs):
        tp += int(yy == c)
        fp += int(yy != c)
        if i == len(pairs) - 1 or pairs[i + 1][0] != s:
            th.append(s), tps.append(tp), fps.append(fp)
    keep = np.where(np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True])[0]
    return [(th[i], fps[i] / fps[-1], tps[i] / tps[-1]) for i in keep]


def test_roc_corners_brute_force_and_same_area(spark):
    rng = random.Random(11)
    # coarse scores: many ties and long straight runs
    rows = [(rng.randrange(3), [rng.randrange(5) / 4.0 for _ in range(3)]) for _ in range(300)]
    df = spark.createDataFrame(rows, "y int, p array<double>")
    got = M.roc_curve(df, drop_intermediate=True).collect()
    full = M.roc_curve(df).collect()
    for c in range(3):
        want = _corners_brute([r[0] for r in rows], [r[1][c] for r in rows], c)
        mine = sorted(((r["threshold"], r["fpr"], r["tpr"]) for r in got if r["class_idx"] == c),
                      key=lambda t: -t[0])
        assert [(a, round(b, 12), round(d, 12)) for a, b, d in mine] == \
               [(a, round(b, 12), round(d, 12)) for a, b, d in want]

        def area(points):
            pts = [(0.0, 0.0)] + sorted(((f, t) for _, f, t in points))
            return sum((x2 - x1) * (y1 + y2) / 2 for (x1, y1), (x2, y2) in zip(pts, pts[1:]))
        all_pts = [(r["threshold"], r["fpr"], r["tpr"]) for r in full if r["class_idx"] == c]
        assert abs(area(mine) - area(all_pts)) < 1e-12
        assert len(mine) <= len(all_pts)


def test_binned_auc(spark):
    rng = random.Random(4)
    grid = [(rng.randrange(2), [rng.randrange(4) / 4.0, rng.randrange(4) / 4.0]) for _ in range(200)]
    g = spark.createDataFrame(grid, "y int, p array<double>")
    exact = {r["class_idx"]: r["auc"] for r in M.auc_by_class(g).collect()}
    binned = {r["class_idx"]: r["auc"] for r in M.auc_by_class(g, bins=4).collect()}
    assert all(abs(exact[c] - binned[c]) < 1e-12 for c in exact)  # scores already on the grid
    fine = [(rng.randrange(2), [rng.random(), rng.random()]) for _ in range(400)]
    f = spark.createDataFrame(fine, "y int, p array<double>")
    exact = {r["class_idx"]: r["auc"] for r in M.auc_by_class(f).collect()}
    binned = {r["class_idx"]: r["auc"] for r in M.auc_by_class(f, bins=1000).collect()}
    assert all(abs(exact[c] - binned[c]) < 0.01 for c in exact)
    assert M.score_counts(f, bins=10).count() <= 2 * 10


def _scored(spark, rows, parts=5):
    return spark.createDataFrame(rows, "y int, p array<double>").repartition(parts)


def _plain_curves(rows, classes):
    """{class: [(threshold, positives so far, negatives so far)]} by falling score."""
    out = {}
    for c in range(classes):
        steps = {}
        for y, p in rows:
            s = steps.setdefault(p[c], [0, 0])
            s[y != c] += 1
        pos = neg = 0
        out[c] = []
        for score in sorted(steps, reverse=True):
            pos, neg = pos + steps[score][0], neg + steps[score][1]
            out[c].append((score, pos, neg))
    return out


def _random_rows(seed, n, classes=3, grid=None):
    r = random.Random(seed)
    cut = (lambda x: round(x * grid) / grid) if grid else (lambda x: x)
    return [(r.randrange(classes), [cut(r.random()) for _ in range(classes)]) for _ in range(n)]


@pytest.mark.parametrize("n,grid", [(400, None), (400, 20), (5, None), (1, None), (60, 1)])
def test_auc_merged_from_ranges_is_the_area_of_the_whole_curve(spark, n, grid):
    rows = _random_rows(n, n, grid=grid)
    got = {r.class_idx: r.auc for r in M.auc_by_class(_scored(spark, rows)).collect()}
    for c, curve in _plain_curves(rows, 3).items():
        area, before = 0.0, (0, 0)
        for _, pos, neg in curve:
            area += (neg - before[1]) * (pos + before[0]) / 2
            before = (pos, neg)
        P, N = before
        assert got[c] == (None if P * N == 0 else pytest.approx(area / (P * N), abs=1e-12))


def test_auc_joins_nothing_with_the_score_rows(spark):
    plan = M.auc_by_class(_scored(spark, _random_rows(1, 30)))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


@pytest.mark.parametrize("partitions", [1, 8, 40])
@pytest.mark.parametrize("n,grid", [(300, None), (300, 12), (2, None)])
def test_corners_are_found_across_the_ends_of_ranges(spark, partitions, n, grid):
    rows = _random_rows(n + 1, n, grid=grid)
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = {}
        for r in M.roc_curve(_scored(spark, rows), drop_intermediate=True).collect():
            got.setdefault(r.class_idx, set()).add(r.threshold)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    for c, curve in _plain_curves(rows, 3).items():
        points = [(0, 0), *[(p, q) for _, p, q in curve]]
        want = {s for i, (s, p, q) in enumerate(curve) if i in (0, len(curve) - 1)
                or (points[i + 2][0] - p, points[i + 2][1] - q) != (p - points[i][0], q - points[i][1])}
        assert got[c] == want
