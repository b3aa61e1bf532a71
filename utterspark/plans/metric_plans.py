"""Evaluation-metric plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from utterspark.operators import metrics as M
from utterspark.plans.registry import register
from utterspark.session import materialize
from utterspark.plans.sql_fixtures import UTTERANCES, evaluated_sql, scored_split_sql
from utterspark.sources.tables import (evaluated, history_rows, scored, scored_labels, scored_split,
                                       table, utterances)


def _r6(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _cm(spark, sf_dir):
    # aggregate the scored rows once; every derived metric reads this small table
    return materialize(M.confusion(evaluated(spark, sf_dir), "y", "k"))


@register("accuracy", f"""
WITH {evaluated_sql()}
SELECT round(avg(CASE WHEN y = k THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM evaluated
""")
def accuracy(spark, sf_dir):
    return _r6(M.accuracy(evaluated(spark, sf_dir), "y", "k"))


@register("confusion", f"""
WITH {evaluated_sql()}
SELECT y, k, CAST(n AS BIGINT) AS n FROM cm
""")
def confusion(spark, sf_dir):
    return _cm(spark, sf_dir)


@register("confusion_dense", f"""
WITH {evaluated_sql()}
SELECT a.idx AS y, b.idx AS k, CAST(coalesce(cm.n, 0) AS BIGINT) AS n
FROM (SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS idx FROM (SELECT DISTINCT label FROM embeddings) x) a
CROSS JOIN (SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS idx FROM (SELECT DISTINCT label FROM embeddings) x) b
LEFT JOIN cm ON cm.y = a.idx AND cm.k = b.idx
""")
def confusion_dense(spark, sf_dir):
    """Every pair of dictionary classes, zero where no row fell."""
    return M.dense_confusion(_cm(spark, sf_dir), materialize(scored_labels(spark, sf_dir))).select(
        "y", "k", F.col("n").cast("long").alias("n"))


@register("weighted_prf", f"""
WITH {evaluated_sql()}
SELECT round(sum(precision * support) / sum(support), 6) AS precision,
       round(sum(recall * support) / sum(support), 6) AS recall,
       round(sum(f1_score * support) / sum(support), 6) AS f1_score
FROM pcf
""")
def weighted_prf(spark, sf_dir):
    return _r6(M.weighted_prf(_cm(spark, sf_dir)))


@register("class_report", f"""
WITH {evaluated_sql()}
SELECT CAST(c AS VARCHAR) AS key, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1_score, 6) AS f1_score, CAST(support AS BIGINT) AS support FROM pcf
UNION ALL
SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(n_true), 6), CAST(sum(n_true) AS BIGINT) FROM cls
UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1_score), 6),
       CAST(sum(support) AS BIGINT) FROM pcf
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1_score * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM pcf
""")
def class_report(spark, sf_dir):
    return _r6(M.class_report(_cm(spark, sf_dir)))


@register("false_positive_rate", f"""
WITH {evaluated_sql()},
tot AS (SELECT sum(n) AS total FROM cm),
j AS (SELECT n.idx AS c, coalesce(cls.tp, 0) AS tp, coalesce(cls.n_true, 0) AS n_true,
             coalesce(cls.n_pred, 0) AS n_pred, tot.total
      FROM names n LEFT JOIN cls ON n.idx = cls.c, tot)
SELECT c AS class_idx,
       round(CASE WHEN (n_pred - tp) + (total - n_pred - n_true + tp) > 0
                  THEN (n_pred - tp) / ((n_pred - tp) + (total - n_pred - n_true + tp)) ELSE 0.0 END, 6) AS fpr
FROM j
""")
def false_positive_rate(spark, sf_dir):
    return _r6(M.false_positive_rate(_cm(spark, sf_dir), scored_labels(spark, sf_dir)))


ROC_SQL = """,
g AS (SELECT CAST(c AS INTEGER) AS c, p AS score, sum(CASE WHEN y = c THEN 1 ELSE 0 END) AS n_pos,
             sum(CASE WHEN y = c THEN 0 ELSE 1 END) AS n_neg
      FROM prob GROUP BY c, p),
r AS (SELECT *, sum(n_pos) OVER (PARTITION BY c ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_pos,
             sum(n_neg) OVER (PARTITION BY c ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_neg,
             sum(n_pos) OVER (PARTITION BY c) AS P, sum(n_neg) OVER (PARTITION BY c) AS N
      FROM g),
auc AS (SELECT c, CASE WHEN max(P) > 0 AND max(N) > 0
                      THEN sum(n_neg * (cum_pos - n_pos / 2.0)) / (max(P) * max(N)) END AS auc
        FROM r GROUP BY c)"""


@register("roc_curve", f"""
WITH {evaluated_sql()}{ROC_SQL}
SELECT c AS class_idx, round(score, 6) AS threshold,
       round(CASE WHEN N > 0 THEN cum_neg / N END, 6) AS fpr, round(CASE WHEN P > 0 THEN cum_pos / P END, 6) AS tpr
FROM r
""")
def roc_curve(spark, sf_dir):
    return _r6(M.roc_curve(scored(spark, sf_dir)))


@register("roc_curve_corners", f"""
WITH {evaluated_sql()}{ROC_SQL},
nb AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY c) AS m,
              lag(cum_pos) OVER w AS pp, lead(cum_pos) OVER w AS np,
              lag(cum_neg) OVER w AS pn, lead(cum_neg) OVER w AS nn
       FROM r WINDOW w AS (PARTITION BY c ORDER BY score DESC))
SELECT c AS class_idx, round(score, 6) AS threshold,
       round(CASE WHEN N > 0 THEN cum_neg / N END, 6) AS fpr, round(CASE WHEN P > 0 THEN cum_pos / P END, 6) AS tpr
FROM nb WHERE i = 1 OR i = m OR pn - 2 * cum_neg + nn <> 0 OR pp - 2 * cum_pos + np <> 0
""")
def roc_curve_corners(spark, sf_dir):
    return _r6(M.roc_curve(scored(spark, sf_dir), drop_intermediate=True))


@register("auc_by_class", f"""
WITH {evaluated_sql()}{ROC_SQL}
SELECT c AS class_idx, round(auc, 6) AS auc FROM auc
""")
def auc_by_class(spark, sf_dir):
    return _r6(M.auc_by_class(scored(spark, sf_dir)))


AUC_BINS = 100
BINNED_SQL = ROC_SQL.replace("c, p AS score,", f"c, least(floor(p * {AUC_BINS}), {AUC_BINS - 1}) / {AUC_BINS} AS score,") \
                    .replace("GROUP BY c, p)", f"GROUP BY c, least(floor(p * {AUC_BINS}), {AUC_BINS - 1}) / {AUC_BINS})")


@register("auc_by_class_binned", f"""
WITH {evaluated_sql()}{BINNED_SQL}
SELECT c AS class_idx, round(auc, 6) AS auc FROM auc
""")
def auc_by_class_binned(spark, sf_dir):
    return _r6(M.auc_by_class(scored(spark, sf_dir), bins=AUC_BINS))


@register("macro_auc", f"""
WITH {evaluated_sql()}{ROC_SQL}
SELECT round(avg(auc), 6) AS macro_auc, CAST(sum(CASE WHEN auc IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_undefined
FROM auc
""")
def macro_auc(spark, sf_dir):
    return _r6(M.macro_auc(M.auc_by_class(scored(spark, sf_dir))))


@register("latency_stats", """
SELECT round(avg(value), 6) AS average_time, round(stddev_pop(value), 6) AS std_time,
       round(min(value), 6) AS min_time, round(max(value), 6) AS max_time, CAST(count(value) AS BIGINT) AS n
FROM events
""")
def latency_stats(spark, sf_dir):
    return _r6(M.latency_stats(table(spark, sf_dir, "events").select("value")))


@register("metrics_summary", f"""
WITH {evaluated_sql()}{ROC_SQL}
SELECT round((SELECT avg(CASE WHEN y = k THEN 1.0 ELSE 0.0 END) FROM evaluated), 4) AS accuracy,
       round((SELECT sum(precision * support) / sum(support) FROM pcf), 4) AS precision,
       round((SELECT sum(recall * support) / sum(support) FROM pcf), 4) AS recall,
       round((SELECT sum(f1_score * support) / sum(support) FROM pcf), 4) AS f1_score,
       round((SELECT avg(auc) FROM auc), 4) AS macro_auc
""")
def metrics_summary(spark, sf_dir):
    cm = _cm(spark, sf_dir)
    return M.summary(M.accuracy_from_confusion(cm), M.weighted_prf(cm),
                     M.macro_auc(M.auc_by_class(scored(spark, sf_dir))))


@register("sample_weight", f"""
WITH {UTTERANCES}
SELECT source_file, row_pos, CASE WHEN is_negative THEN 1.5 ELSE 1.0 END AS w FROM utterances
""")
def sample_weight(spark, sf_dir):
    return utterances(spark, sf_dir).select("source_file", "row_pos", M.sample_weight(F.col("is_negative")).alias("w"))


@register("log_loss", f"""
WITH {scored_split_sql()}
SELECT round(avg(loss), 6) AS log_loss FROM row_loss
""")
def log_loss(spark, sf_dir):
    return _r6(M.log_loss(scored(spark, sf_dir), "z", "y"))


@register("batch_weighted_loss", f"""
WITH {scored_split_sql()}
SELECT split, batch_id, round(avg(loss) * avg(w), 6) AS weighted_loss, round(avg(loss), 6) AS mean_loss,
       round(avg(CASE WHEN k = y THEN 1.0 ELSE 0.0 END), 6) AS mean_acc
FROM eval_rows GROUP BY split, batch_id
""")
def batch_weighted_loss(spark, sf_dir):
    return _r6(M.batch_loss(scored_split(spark, sf_dir), batch=["split", "batch_id"]))


@register("epoch_metrics", f"""
WITH {scored_split_sql()}
SELECT epoch, round(train_loss, 6) AS train_loss, round(train_acc, 6) AS train_acc,
       round(valid_loss, 6) AS valid_loss, round(valid_acc, 6) AS valid_acc FROM history
""")
def epoch_metrics(spark, sf_dir):
    return _r6(M.epoch_metrics(history_rows(spark, sf_dir)))


@register("best_epoch", f"""
WITH {scored_split_sql()}
SELECT arg_max(epoch, (valid_acc, -epoch)) AS best_epoch, round(max(valid_acc), 6) AS best_valid_acc
FROM history WHERE valid_acc > 0
""")
def best_epoch(spark, sf_dir):
    return _r6(M.best_epoch(M.epoch_metrics(history_rows(spark, sf_dir))))


@register("improvement_epochs", f"""
WITH {scored_split_sql()}
SELECT epoch, round(valid_acc, 6) AS valid_acc FROM (
  SELECT epoch, valid_acc, coalesce(max(valid_acc) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING
                                                          AND 1 PRECEDING), 0.0) AS prev
  FROM history) h WHERE valid_acc > prev
""")
def improvement_epochs(spark, sf_dir):
    return _r6(M.improvement_epochs(M.epoch_metrics(history_rows(spark, sf_dir))))


@register("accuracy_by_split", f"""
WITH {scored_split_sql()}
SELECT split, round(avg(CASE WHEN k = y THEN 1.0 ELSE 0.0 END), 6) AS accuracy, CAST(count(*) AS BIGINT) AS n
FROM eval_rows GROUP BY split
""")
def accuracy_by_split(spark, sf_dir):
    return _r6(M.accuracy_by_split(scored_split(spark, sf_dir)))
