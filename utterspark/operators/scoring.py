"""Linear scoring heads over vector columns.

A model is a *long* table ``(class_idx INT, w ARRAY<DOUBLE>, b DOUBLE)``, one
row per class. Scoring attaches the weight matrix to each row with a
broadcast join; the matrix is cut into class blocks of at most
``MAX_BROADCAST_CELLS`` weights, so what is broadcast is bounded whatever the
model size, and the per-block logits are concatenated in class order.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterspark.functions.arrays import argmax, dot_rows, softmax
from utterspark.session import materialize

MAX_BROADCAST_CELLS = 2_000_000


def centroid_model(df: DataFrame, vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Class centroids as a linear model: ``w_c = mean of vectors of class c``, ``b = 0``.

    Averages run per (class, dim) with map-side partial aggregation, so a class
    holding a third of all rows is still combined in every task first.
    """
    cells = df.select(F.col(label_col).cast("int").alias("class_idx"),
                      F.posexplode(vec_col).alias("dim", "v"))
    means = cells.groupBy("class_idx", "dim").agg(F.avg(F.col("v").cast("double")).alias("m"))
    # one row per class holding D (dim, mean) pairs: bounded by the dimension
    rows = means.groupBy("class_idx").agg(F.array_sort(F.collect_list(F.struct("dim", "m"))).alias("dm"))
    return rows.select("class_idx", F.transform("dm", lambda s: s["m"]).alias("w"),
                       F.lit(0.0).alias("b"))


def _blocks(model: DataFrame) -> list[tuple[int, int]]:
    stats = model.agg(F.min("class_idx").alias("lo"), F.max("class_idx").alias("hi"),
                      F.count(F.lit(1)).alias("n"), F.max(F.size("w")).alias("d")).first()
    if stats["n"] == 0:
        raise ValueError("empty model")
    lo, hi, d = int(stats["lo"]), int(stats["hi"]), max(int(stats["d"]), 1)
    if hi - lo + 1 != stats["n"]:
        raise ValueError("model class_idx must be dense")
    per_block = max(1, MAX_BROADCAST_CELLS // d)
    n_blocks = math.ceil((hi - lo + 1) / per_block)
    return [(lo + i * per_block, min(hi, lo + (i + 1) * per_block - 1)) for i in range(n_blocks)]


def linear_logits(df: DataFrame, model: DataFrame, vec_col: str = "embedding",
                  out: str = "z", scale: float = 1.0) -> DataFrame:
    """Adds ``out = scale * (W . x + b)`` as ARRAY<DOUBLE> in class order."""
    x = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    cur = df.withColumn("_x", x)
    parts = []
    # the model has one row per class: written once, then read by the size
    # check and by every block instead of being recomputed from its inputs
    model = materialize(model)
    for i, (lo, hi) in enumerate(_blocks(model)):
        block = (model.filter((F.col("class_idx") >= lo) & (F.col("class_idx") <= hi))
                 .agg(F.array_sort(F.collect_list(F.struct("class_idx", "w", "b"))).alias("_wb"))
                 .select(F.lit(i).alias("_blk"),
                         F.transform("_wb", lambda s: s["w"]).alias(f"_W{i}"),
                         F.transform("_wb", lambda s: s["b"]).alias(f"_B{i}")))
        # block holds at most MAX_BROADCAST_CELLS weights: a proven bound
        cur = (cur.withColumn("_blk", F.lit(i)).join(F.broadcast(block), "_blk").drop("_blk"))
        zb = F.zip_with(dot_rows(f"_W{i}", "_x"), F.col(f"_B{i}"), lambda a, b: a + b)
        cur = cur.withColumn(f"_Z{i}", zb).drop(f"_W{i}", f"_B{i}")
        parts.append(f"_Z{i}")
    z = F.concat(*[F.col(p) for p in parts]) if len(parts) > 1 else F.col(parts[0])
    if scale != 1.0:
        z = F.transform(z, lambda v: v * F.lit(float(scale)))
    return cur.withColumn(out, z).drop("_x", *parts)


def with_probabilities(df: DataFrame, z_col: str = "z") -> DataFrame:
    """Adds ``p`` (softmax), ``pred_idx`` (first arg-max) and ``p_max``."""
    return (df.withColumn("p", softmax(z_col))
              .withColumn("pred_idx", argmax("p"))
              .withColumn("p_max", F.array_max("p")))
