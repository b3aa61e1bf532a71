"""Exact global ranks and running sums without a single-partition sort.

Rows are range-partitioned on the full sort key (so one hot value of a
leading column is still split across tasks by the tie-breaking columns),
frozen with a reliable checkpoint so partition ids cannot move on a retry,
numbered or summed locally, and shifted by per-partition prefix offsets that
come from a table with at most one row per (partition, group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from utterspark.session import ensure_checkpoint_dir, shuffle_partitions

# Offset tables hold one row per (range partition, group): at most partitions +
# groups rows. Up to this many rows they are broadcast; beyond it (very many
# small groups) the join shuffles.
MAX_BROADCAST_OFFSETS = 2_000_000


def _attach(rows: DataFrame, offsets: DataFrame, keys: Sequence[str], grouped: bool) -> DataFrame:
    if not grouped:
        # at most one row per range partition: a proven bound
        return rows.join(F.broadcast(offsets), list(keys))
    offsets = offsets.checkpoint(eager=True)
    small = offsets.count() <= MAX_BROADCAST_OFFSETS
    # null-safe: rows whose group is NULL form a group of their own
    right = offsets.select(*[F.col(c).alias(f"_g_{c}") if c in keys else F.col(c) for c in offsets.columns])
    on = [rows[c].eqNullSafe(right[f"_g_{c}"]) for c in keys]
    return rows.join(F.broadcast(right) if small else right, on).drop(*[f"_g_{c}" for c in keys])


def _ranged(df: DataFrame, keys: Sequence[str], num_partitions: int | None) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or shuffle_partitions(spark)
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)


def global_rank(df: DataFrame, order_cols: Sequence[str], partition_cols: Sequence[str] = (),
                rank_col: str = "rank", size_col: str | None = "group_size",
                num_partitions: int | None = None) -> DataFrame:
    """1-based position of each row in ``order_cols`` order within ``partition_cols``.

    ``order_cols`` must identify a row within its group (append a unique id to
    break ties). Adds ``rank_col`` and, if given, ``size_col`` (group row count).
    """
    part = list(partition_cols)
    keys = part + list(order_cols)
    r = (_ranged(df, keys, num_partitions)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id())
         .checkpoint(eager=True))
    counts = r.groupBy("_pid", *part).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
    before = Window.partitionBy(*part).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid", *part, "_first",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy(*part)).alias("_size"))
    out = _attach(r, offsets, ["_pid", *part], bool(part))
    cols = [c for c in df.columns]
    extra = [(F.col("_off") + (F.col("_mid") - F.col("_first")) + 1).alias(rank_col)]
    if size_col:
        extra.append(F.col("_size").alias(size_col))
    return out.select(*cols, *extra)


def running_totals(df: DataFrame, order_cols: Sequence[str], value_cols: Sequence[str],
                   partition_cols: Sequence[str] = (), prefix: str = "cum_",
                   total_prefix: str | None = "total_",
                   num_partitions: int | None = None, next_cols: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sums of ``value_cols`` in ``order_cols`` order per group.

    ``order_cols`` must be unique within a group. Adds ``{prefix}{c}`` and, if
    ``total_prefix`` is set, the group totals ``{total_prefix}{c}``. With ``next_cols`` also a struct
    ``next`` of these columns of the row that follows in the group (NULL for the last): the local
    window sees it, and across a range's end it comes from the first row of the group's next range.
    """
    part = list(partition_cols)
    keys = part + list(order_cols)
    r = (_ranged(df, keys, num_partitions)
         .withColumn("_pid", F.spark_partition_id())
         .checkpoint(eager=True))
    w = (Window.partitionBy("_pid", *part).orderBy(*order_cols)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    lead = Window.partitionBy("_pid", *part).orderBy(*order_cols)
    ahead = [F.lead(F.struct(*next_cols)).over(lead).alias("_ahead")] if next_cols else []
    local = r.select("*", *[F.sum(c).over(w).alias(f"_loc_{c}") for c in value_cols], *ahead)
    head = [F.min_by(F.struct(*next_cols), F.struct(*order_cols)).alias("_head")] if next_cols else []
    totals = r.groupBy("_pid", *part).agg(*[F.sum(c).alias(f"_tot_{c}") for c in value_cols], *head)
    before = Window.partitionBy(*part).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*part)
    off_cols = []
    for c in value_cols:
        off_cols.append(F.coalesce(F.sum(f"_tot_{c}").over(before), F.lit(0)).alias(f"_off_{c}"))
        if total_prefix:
            off_cols.append(F.sum(f"_tot_{c}").over(whole).alias(f"_all_{c}"))
    if next_cols:
        off_cols.append(F.lead("_head").over(Window.partitionBy(*part).orderBy("_pid")).alias("_beyond"))
    offsets = totals.select("_pid", *part, *off_cols)
    out = _attach(local, offsets, ["_pid", *part], bool(part))
    extra = [(F.col(f"_off_{c}") + F.col(f"_loc_{c}")).alias(f"{prefix}{c}") for c in value_cols]
    if total_prefix:
        extra += [F.col(f"_all_{c}").alias(f"{total_prefix}{c}") for c in value_cols]
    if next_cols:
        extra.append(F.coalesce("_ahead", "_beyond").alias("next"))
    return out.select(*df.columns, *extra)


def hashed_rank(df: DataFrame, key: str, tie_cols: Sequence[str] = (), rank_col: str = "rank",
                size_col: str | None = "group_size", num_partitions: int | None = None) -> DataFrame:
    """Exact global rank in ``(key, *tie_cols)`` order for a key that is a
    lowercase hex digest (md5, sha): uniform, and ordered like its leading digits.

    Range buckets are a pure function of the key (its first 8 hex digits scaled
    to ``num_partitions``), so no bounds are sampled and nothing needs freezing:
    a retried task recomputes the same bucket for every row. Per-bucket counts
    (one row per bucket) give broadcast offsets; a window partitioned by the
    bucket numbers each slice, and uniform keys keep the slices even.
    """
    n = num_partitions or shuffle_partitions(df.sparkSession)
    # right-padded, so a shorter hex string still orders like its value
    prefix = F.conv(F.rpad(F.substring(F.col(key), 1, 8), 8, "0"), 16, 10).cast("double")
    bucket = F.least(F.floor(prefix * F.lit(float(n)) / F.lit(4294967296.0)), F.lit(n - 1)).cast("int")
    b = df.withColumn("_b", bucket)
    counts = b.groupBy("_b").agg(F.count(F.lit(1)).alias("_cnt"))
    # at most num_partitions rows: the unpartitioned window sorts a bucket-sized table
    offsets = counts.select(
        "_b", F.coalesce(F.sum("_cnt").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)),
                         F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy()).alias("_size"))
    local = F.row_number().over(Window.partitionBy("_b").orderBy(key, *tie_cols))
    out = b.withColumn("_loc", local).join(F.broadcast(offsets), "_b")
    extra = [(F.col("_off") + F.col("_loc")).cast("long").alias(rank_col)]
    if size_col:
        extra.append(F.col("_size").alias(size_col))
    return out.select(*df.columns, *extra)
