"""Evaluation metrics as DataFrames.

Row-level data is touched once per metric family: the confusion counts (one
hash aggregation, at most classes^2 rows) feed accuracy, precision, recall,
F1, the class report and false-positive rates; one explode + aggregation to
(class, score) feeds the ROC curves, whose running sums use the
range-partitioned prefix sums of ``ranking.running_totals`` instead of a
per-class window (which would give one task per class), and the AUCs, which
merge one summary per range of scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from utterspark.operators.ranking import running_totals
from utterspark.session import ship_package, shuffle_partitions


def accuracy(df: DataFrame, y: str = "y", k: str = "pred_idx") -> DataFrame:
    return df.agg(F.avg((F.col(y) == F.col(k)).cast("double")).alias("accuracy"))


def accuracy_from_confusion(cm: DataFrame) -> DataFrame:
    """Accuracy from the confusion counts (no second pass over the rows)."""
    return cm.agg((F.sum(F.when(F.col("y") == F.col("k"), F.col("n")).otherwise(F.lit(0)))
                   / F.sum("n")).alias("accuracy"))


def confusion(df: DataFrame, y: str = "y", k: str = "pred_idx") -> DataFrame:
    """Sparse confusion counts ``(y, k, n)``."""
    return df.groupBy(F.col(y).alias("y"), F.col(k).alias("k")).agg(F.count(F.lit(1)).alias("n"))


def dense_confusion(cm: DataFrame, labels: DataFrame) -> DataFrame:
    """Every (y, k) pair of the label dictionary, zero where no row fell."""
    n = labels.count()
    grid = labels.select(F.col("idx").alias("y"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("k"))
    return grid.join(cm, ["y", "k"], "left").select("y", "k", F.coalesce("n", F.lit(0)).alias("n"))


def class_counts(cm: DataFrame) -> DataFrame:
    """Per class present in truth or prediction: tp, true (support), predicted."""
    t = cm.groupBy(F.col("y").alias("c")).agg(F.sum("n").alias("n_true"))
    p = cm.groupBy(F.col("k").alias("c")).agg(F.sum("n").alias("n_pred"))
    tp = cm.filter(F.col("y") == F.col("k")).select(F.col("y").alias("c"), F.col("n").alias("tp"))
    return (t.join(p, "c", "full").join(tp, "c", "left")
             .select("c", F.coalesce("tp", F.lit(0)).alias("tp"),
                     F.coalesce("n_true", F.lit(0)).alias("n_true"),
                     F.coalesce("n_pred", F.lit(0)).alias("n_pred")))


def _safe_div(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def per_class(cm: DataFrame) -> DataFrame:
    """precision, recall, f1 (0 where undefined) and support per present class."""
    cc = class_counts(cm)
    prec = _safe_div(F.col("tp").cast("double"), F.col("n_pred"))
    rec = _safe_div(F.col("tp").cast("double"), F.col("n_true"))
    s = cc.select("c", prec.alias("precision"), rec.alias("recall"), F.col("n_true").alias("support"))
    f1 = _safe_div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return s.withColumn("f1_score", f1)


def weighted_prf(cm: DataFrame) -> DataFrame:
    """Support-weighted precision, recall and F1 over the present classes."""
    pc = per_class(cm)
    tot = F.sum("support")
    return pc.agg(
        (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
        (F.sum(F.col("f1_score") * F.col("support")) / tot).alias("f1_score"))


def macro_prf(cm: DataFrame) -> DataFrame:
    pc = per_class(cm)
    return pc.agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                  F.avg("f1_score").alias("f1_score"))


def class_report(cm: DataFrame) -> DataFrame:
    """Rows ``(key, precision, recall, f1_score, support)``: one per class (key =
    class id as text), then ``accuracy`` (in f1_score), ``macro avg``, ``weighted avg``."""
    pc = per_class(cm)
    rows = pc.select(F.col("c").cast("string").alias("key"), "precision", "recall", "f1_score",
                     F.col("support").cast("long").alias("support"))
    total = F.sum("support").cast("long")
    accuracy_row = class_counts(cm).agg(
        F.lit("accuracy").alias("key"), F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"),
        (F.sum("tp") / F.sum("n_true")).alias("f1_score"), F.sum("n_true").cast("long").alias("support"))
    macro = pc.agg(F.lit("macro avg").alias("key"), F.avg("precision").alias("precision"),
                   F.avg("recall").alias("recall"), F.avg("f1_score").alias("f1_score"),
                   total.alias("support"))
    tot = F.sum("support")
    weighted = pc.agg(F.lit("weighted avg").alias("key"),
                      (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
                      (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
                      (F.sum(F.col("f1_score") * F.col("support")) / tot).alias("f1_score"),
                      total.alias("support"))
    return rows.unionByName(accuracy_row).unionByName(macro).unionByName(weighted)


def false_positive_rate(cm: DataFrame, labels: DataFrame) -> DataFrame:
    """FP / (FP + TN) per dictionary class, 0 when undefined."""
    cc = class_counts(cm)
    total = cm.agg(F.sum("n").alias("total"))
    lab = labels.select(F.col("idx").alias("c"))
    j = (lab.join(cc, "c", "left").na.fill(0, ["tp", "n_true", "n_pred"])
         .withColumn("_j", F.lit(0)).join(F.broadcast(total.withColumn("_j", F.lit(0))), "_j"))
    fp = F.col("n_pred") - F.col("tp")
    tn = F.col("total") - F.col("n_pred") - F.col("n_true") + F.col("tp")
    return j.select(F.col("c").alias("class_idx"), _safe_div(fp.cast("double"), fp + tn).alias("fpr"))


def score_counts(df: DataFrame, y: str = "y", p: str = "p", bins: int | None = None) -> DataFrame:
    """``(c, score, n_pos, n_neg)``: per class and distinct score, one-vs-rest counts.

    With ``bins`` a score in [0, 1] is first cut down to ``floor(score * bins) / bins``
    (1.0 goes to the last bin), so the table holds at most classes x bins rows
    whatever the data size: the approximate curve for very large sets.
    """
    e = df.select(F.col(y).alias("_y"), F.posexplode(p).alias("c", "score"))
    if bins:
        cut = F.least(F.floor(F.col("score") * F.lit(float(bins))), F.lit(bins - 1)) / F.lit(float(bins))
        e = e.withColumn("score", cut.cast("double"))
    pos = (F.col("_y") == F.col("c"))
    return e.groupBy(F.col("c").cast("int").alias("c"), "score").agg(
        F.sum(pos.cast("long")).alias("n_pos"), F.sum((~pos).cast("long")).alias("n_neg"))


def _desc_running(counts: DataFrame, with_next: bool = False) -> DataFrame:
    neg = counts.withColumn("_neg_score", -F.col("score"))
    return running_totals(neg, ["_neg_score"], ["n_pos", "n_neg"], partition_cols=["c"], next_cols=["n_pos", "n_neg"] if with_next else ())


def _drop_collinear(r: DataFrame) -> DataFrame:
    """Keep a curve's first and last point and every corner: a point after which the curve goes on in another
    direction than it came, that is, whose next step has other counts than its own. So a point needs
    its successor's counts only (``next``), no rank and no join with the other points."""
    first = (F.col("cum_n_pos") == F.col("n_pos")) & (F.col("cum_n_neg") == F.col("n_neg"))
    last = F.col("next").isNull()
    turns = (F.col("next.n_pos") != F.col("n_pos")) | (F.col("next.n_neg") != F.col("n_neg"))
    return r.filter(first | last | turns)


def _range_task(batches):
    """One row per class of a range of scores in falling order: positives, negatives and the area that the
    range's own steps span (negatives times the positives above them, half of those beside them)."""
    pid = TaskContext.get().partitionId()
    held: dict[int, list] = {}
    for b in batches:
        c, p, n = (b.column(k).to_numpy() for k in ("c", "n_pos", "n_neg"))
        cuts = np.flatnonzero(np.diff(c, prepend=-1)).tolist() if len(c) else []  # rows come by class
        for lo, hi in zip(cuts, [*cuts[1:], len(c)]):
            pos, neg = p[lo:hi].astype(float), n[lo:hi].astype(float)
            s = held.setdefault(int(c[lo]), [0, 0, 0.0])
            s[2] += float((neg * (s[0] + np.cumsum(pos) - pos / 2)).sum())
            s[0], s[1] = s[0] + int(p[lo:hi].sum()), s[1] + int(n[lo:hi].sum())
    rows = [(pid, c, *s) for c, s in held.items()]
    yield pa.RecordBatch.from_pydict({"pid": pa.array([r[0] for r in rows], pa.int32()), "c": pa.array([r[1] for r in rows], pa.int32()),
                                      "p": pa.array([r[2] for r in rows], pa.int64()), "n": pa.array([r[3] for r in rows], pa.int64()),
                                      "area": pa.array([r[4] for r in rows], pa.float64())})


def score_ranges(counts: DataFrame) -> DataFrame:
    """``(pid, c, p, n, area)``: the score counts summed up per range of falling scores and class. Ranges merge in
    order of ``pid``: an area grows by the negatives of a range times the positives of all before it."""
    ship_package(counts.sparkSession)
    ordered = counts.select("c", (-F.col("score")).alias("_down"), "n_pos", "n_neg").where("c is not null")
    ordered = ordered.repartitionByRange(shuffle_partitions(counts.sparkSession), "c", "_down").sortWithinPartitions("c", "_down")
    return ordered.select("c", "n_pos", "n_neg").mapInArrow(_range_task, "pid int, c int, p long, n long, area double")


def roc_curve(df: DataFrame, y: str = "y", p: str = "p", drop_intermediate: bool = False,
              bins: int | None = None) -> DataFrame:
    """ROC points per class, one per distinct score.

    ``(class_idx, threshold, fpr, tpr)``; rates are NULL when a class has no
    positives (tpr) or no negatives (fpr). The (0, 0) origin is implied. With
    ``drop_intermediate`` collinear points are left out (the curve and its
    area are unchanged), as common ROC tools do by default.
    """
    r = _desc_running(score_counts(df, y, p, bins), with_next=drop_intermediate)
    if drop_intermediate:
        r = _drop_collinear(r)
    fpr = F.when(F.col("total_n_neg") > 0, F.col("cum_n_neg") / F.col("total_n_neg"))
    tpr = F.when(F.col("total_n_pos") > 0, F.col("cum_n_pos") / F.col("total_n_pos"))
    return r.select(F.col("c").alias("class_idx"), F.col("score").alias("threshold"),
                    fpr.alias("fpr"), tpr.alias("tpr"))


def auc_by_class(df: DataFrame, y: str = "y", p: str = "p", bins: int | None = None) -> DataFrame:
    """Trapezoid AUC of each one-vs-rest curve (ties count one half); NULL if
    undefined. ``bins`` gives the approximate form (see :func:`score_counts`)."""
    ranges = score_ranges(score_counts(df, y, p, bins))
    # one row per (range, class): what is merged is the size of the cluster, not of the scores
    before = F.coalesce(F.sum("p").over(Window.partitionBy("c").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    merged = ranges.withColumn("_s", F.col("area") + F.col("n") * before)
    g = merged.groupBy("c").agg(F.sum("_s").alias("_s"), F.sum("p").alias("P"), F.sum("n").alias("N"))
    auc = F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("_s") / (F.col("P") * F.col("N")))
    return g.select(F.col("c").alias("class_idx"), auc.alias("auc"))


def macro_auc(aucs: DataFrame) -> DataFrame:
    """Mean over classes with a defined AUC, and how many were undefined."""
    return aucs.agg(F.avg("auc").alias("macro_auc"),
                    F.sum(F.col("auc").isNull().cast("long")).alias("n_undefined"))


def latency_stats(df: DataFrame, col: str = "value", by: list[str] | None = None) -> DataFrame:
    """Mean, population standard deviation, min and max of recorded timings."""
    aggs = [F.avg(col).alias("average_time"), F.stddev_pop(col).alias("std_time"),
            F.min(col).alias("min_time"), F.max(col).alias("max_time"),
            F.count(col).alias("n")]
    return df.groupBy(*(by or [])).agg(*aggs)


def summary(acc: DataFrame, wprf: DataFrame, mauc: DataFrame, digits: int = 4) -> DataFrame:
    """Headline metrics rounded for the report (all one-row inputs)."""
    one = (acc.withColumn("_j", F.lit(0))
           .join(F.broadcast(wprf.withColumn("_j", F.lit(0))), "_j")
           .join(F.broadcast(mauc.select("macro_auc").withColumn("_j", F.lit(0))), "_j"))
    return one.select(*[F.round(c, digits).alias(c)
                        for c in ("accuracy", "precision", "recall", "f1_score", "macro_auc")])


# Training-loss style metrics -------------------------------------------------

def row_loss(z: str = "z", y: str = "y"):
    """Cross-entropy of one row from its logits: logsumexp(z) - z[y]."""
    zc = F.col(z)
    m = F.array_max(zc)
    shifted = F.zip_with(zc, F.array_repeat(m, F.size(zc)), lambda v, mm: F.exp(v - mm))
    lse = m + F.log(F.aggregate(shifted, F.lit(0.0).cast("double"), lambda a, b: a + b))
    return lse - F.element_at(zc, F.col(y) + 1)


def log_loss(df: DataFrame, z: str = "z", y: str = "y") -> DataFrame:
    return df.agg(F.avg(row_loss(z, y)).alias("log_loss"))


def sample_weight(flag, negative_weight: float = 1.5):
    return F.when(flag, F.lit(negative_weight)).otherwise(F.lit(1.0))


def batch_loss(df: DataFrame, loss: str = "loss", w: str = "w", batch: list[str] | None = None) -> DataFrame:
    """Per batch: mean loss x mean sample weight, and the plain mean accuracy."""
    keys = batch or ["batch_id"]
    return df.groupBy(*keys).agg((F.avg(loss) * F.avg(w)).alias("weighted_loss"),
                                 F.avg(loss).alias("mean_loss"),
                                 F.avg(F.col("correct").cast("double")).alias("mean_acc"))


def epoch_metrics(df: DataFrame) -> DataFrame:
    """Training history from row-level (epoch, split, batch_id, loss, w, correct).

    Train loss per batch is weighted (mean loss x mean weight); every epoch
    figure is the plain mean of its batch means, as a batch loop reports it.
    """
    b = batch_loss(df, batch=["epoch", "split", "batch_id"])
    is_t, is_v = F.col("split") == "train", F.col("split") == "valid"
    return b.groupBy("epoch").agg(
        F.avg(F.when(is_t, F.col("weighted_loss"))).alias("train_loss"),
        F.avg(F.when(is_t, F.col("mean_acc"))).alias("train_acc"),
        F.avg(F.when(is_v, F.col("mean_loss"))).alias("valid_loss"),
        F.avg(F.when(is_v, F.col("mean_acc"))).alias("valid_acc"))


def best_epoch(history: DataFrame) -> DataFrame:
    """First epoch whose validation accuracy beats every earlier one and 0.

    One row; ``best_epoch`` is NULL when no epoch ever exceeds 0.
    """
    ok = history.filter(F.col("valid_acc") > 0)
    return ok.agg(F.max_by("epoch", F.struct(F.col("valid_acc"), -F.col("epoch"))).alias("best_epoch"),
                  F.max("valid_acc").alias("best_valid_acc"))


def improvement_epochs(history: DataFrame) -> DataFrame:
    """Every epoch at which a new best validation accuracy is reached (history
    has one row per epoch, so the unpartitioned window is epoch-sized)."""
    prev = F.max("valid_acc").over(Window.orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1))
    h = history.withColumn("_prev", F.coalesce(prev, F.lit(0.0)))
    return h.filter(F.col("valid_acc") > F.col("_prev")).select("epoch", "valid_acc")


def accuracy_by_split(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.avg(F.col("correct").cast("double")).alias("accuracy"),
                                 F.count(F.lit(1)).alias("n"))
