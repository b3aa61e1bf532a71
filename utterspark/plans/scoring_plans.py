"""Scoring and decision plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from utterspark.functions.arrays import sigmoid_normalised
from utterspark.operators import decide as D
from utterspark.operators.labels import index_of
from utterspark.plans.registry import register
from utterspark.plans.sql_fixtures import scored_sql
from utterspark.sources.tables import scored, scored_labels


def _r6(c):
    return F.round(c, 6)


def _per_class(df, arr, name):
    return df.select("vec_id", F.posexplode(arr).alias("class_idx", name)).select(
        "vec_id", F.col("class_idx").cast("int").alias("class_idx"), _r6(F.col(name)).alias(name))


@register("linear_logits", f"""
WITH {scored_sql(1.0)}
SELECT vec_id, CAST(c AS INTEGER) AS class_idx, round(z, 6) AS z FROM logit
""")
def linear_logits(spark, sf_dir):
    return _per_class(scored(spark, sf_dir, scale=1.0), "z", "z")


@register("softmax", f"""
WITH {scored_sql()}
SELECT vec_id, CAST(c AS INTEGER) AS class_idx, round(p, 6) AS p FROM prob
""")
def softmax_plan(spark, sf_dir):
    return _per_class(scored(spark, sf_dir), "p", "p")


@register("argmax", f"""
WITH {scored_sql()}
SELECT vec_id, y, pred_idx, round(p_max, 6) AS p_max FROM pred
""")
def argmax_plan(spark, sf_dir):
    return scored(spark, sf_dir).select("vec_id", "y", "pred_idx", _r6(F.col("p_max")).alias("p_max"))


@register("threshold_invalid", f"""
WITH {scored_sql()}
SELECT vec_id, y, pred_idx,
       CASE WHEN p_max < 0.6 THEN (SELECT idx FROM names WHERE label = 'INVALID') ELSE pred_idx END AS eval_idx
FROM pred
""")
def threshold_invalid(spark, sf_dir):
    inv = index_of(scored_labels(spark, sf_dir), "INVALID")
    return D.apply_threshold(scored(spark, sf_dir), inv).select("vec_id", "y", "pred_idx", "eval_idx")


@register("threshold_index0", f"""
WITH {scored_sql()}
SELECT vec_id, y, pred_idx, CASE WHEN p_max < 0.6 THEN 0 ELSE pred_idx END AS eval_idx FROM pred
""")
def threshold_index0(spark, sf_dir):
    """The published evaluation's option: low confidence counts as index 0,
    whatever label that is."""
    return D.apply_threshold(scored(spark, sf_dir), 0).select("vec_id", "y", "pred_idx", "eval_idx")


def _decision_sql(t: float) -> str:
    return f"""
WITH {scored_sql()},
named AS (SELECT pr.*, n.label AS top_label FROM pred pr JOIN names n ON pr.pred_idx = n.idx),
acc AS (
  SELECT p.vec_id, n.label, p.p AS probability,
         row_number() OVER (PARTITION BY p.vec_id ORDER BY p.p DESC, p.c) AS rank
  FROM prob p JOIN names n ON p.c = n.idx
  WHERE p.p >= {t!r} AND n.label <> 'INVALID'),
dec AS (
  SELECT vec_id, 1 AS rank, 'UNKNOWN' AS label, 0.0 AS probability,
         CASE WHEN p_max < {t!r} THEN 'low_confidence' ELSE 'invalid_intent' END AS reason
  FROM named WHERE p_max < {t!r} OR top_label = 'INVALID'
  UNION ALL
  SELECT a.vec_id, a.rank, a.label, a.probability, CAST(NULL AS VARCHAR) AS reason
  FROM acc a JOIN named m ON a.vec_id = m.vec_id WHERE NOT (m.p_max < {t!r} OR m.top_label = 'INVALID')
  UNION ALL
  SELECT m.vec_id, 1, 'UNKNOWN', 0.0, 'no_valid_prediction' FROM named m
  WHERE NOT (m.p_max < {t!r} OR m.top_label = 'INVALID')
    AND NOT EXISTS (SELECT 1 FROM acc a WHERE a.vec_id = m.vec_id))
SELECT vec_id, CAST(rank AS INTEGER) AS rank, label, round(probability, 6) AS probability, reason FROM dec
"""


def _decisions(spark, sf_dir, t):
    d = D.decide(scored(spark, sf_dir), scored_labels(spark, sf_dir), threshold=t)
    e = d.select("vec_id", F.posexplode("decision").alias("pos", "d"))
    return e.select("vec_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("d.label").alias("label"),
                    _r6(F.col("d.probability")).alias("probability"), F.col("d.reason").alias("reason"))


@register("decide", _decision_sql(0.6))
def decide_plan(spark, sf_dir):
    return _decisions(spark, sf_dir, 0.6)


@register("accepted_labels", _decision_sql(0.2))
def accepted_labels(spark, sf_dir):
    """Multi-label case: at t = 0.2 several labels can be accepted for one row."""
    return _decisions(spark, sf_dir, 0.2)


@register("top_k", f"""
WITH {scored_sql()}
SELECT p.vec_id, CAST(rank AS INTEGER) AS rank, CAST(p.c AS INTEGER) AS class_idx, n.label,
       round(p.p, 6) AS probability
FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, c) AS rank FROM prob) p
JOIN names n ON p.c = n.idx WHERE rank <= 3
""")
def top_k_plan(spark, sf_dir):
    t = D.with_top_k(scored(spark, sf_dir), scored_labels(spark, sf_dir), k=3)
    e = t.select("vec_id", F.posexplode("top").alias("pos", "t"))
    return e.select("vec_id", (F.col("pos") + 1).cast("int").alias("rank"),
                    F.col("t.idx").cast("int").alias("class_idx"), F.col("t.label").alias("label"),
                    _r6(F.col("t.probability")).alias("probability"))


@register("ovr_probability", f"""
WITH {scored_sql(1.0)},
sig AS (SELECT vec_id, c, 1.0 / (1.0 + exp(-z)) AS s FROM logit)
SELECT vec_id, CAST(c AS INTEGER) AS class_idx, round(s / sum(s) OVER (PARTITION BY vec_id), 6) AS p_ovr FROM sig
""")
def ovr_probability(spark, sf_dir):
    s = scored(spark, sf_dir, scale=1.0)
    return _per_class(s.withColumn("p_ovr", sigmoid_normalised("z")), "p_ovr", "p_ovr")
