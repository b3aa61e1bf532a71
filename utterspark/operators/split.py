"""Reproducible shuffle order, exact positional split and mini-batch ids.

The order is a pure function of (seed, row identity): ``md5(seed|id...)``.
It does not depend on partitioning, so the split is the same on 1 or 1000
executors, and no physical shuffle of the data is needed to define it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterspark.operators.ranking import global_rank, hashed_rank
from utterspark.session import materialize

# The canonical split and batching parameters.
DEFAULT_SEED = 42
TRAIN_RATIO = 0.7
VALID_RATIO = 0.15
BATCH_SIZE = 32
ID_COLS = ("source_file", "row_pos")


def shuffle_key(seed: int | str, id_cols: Sequence[str] = ID_COLS):
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in id_cols]))


def with_shuffle_key(df: DataFrame, seed: int | str = DEFAULT_SEED,
                     id_cols: Sequence[str] = ID_COLS) -> DataFrame:
    return df.withColumn("shuffle_key", shuffle_key(seed, id_cols))


def split_corpus(df: DataFrame, train_ratio: float = TRAIN_RATIO, valid_ratio: float = VALID_RATIO,
                 seed: int | str = DEFAULT_SEED, id_cols: Sequence[str] = ID_COLS) -> DataFrame:
    """Adds ``shuffle_key``, ``rank`` (1-based position in shuffled order) and ``split``.

    ``n_train = floor(n * train_ratio)`` and ``n_valid = floor(n * valid_ratio)``
    in DOUBLE arithmetic; the rest is ``test``.
    """
    keyed = with_shuffle_key(df, seed, id_cols)
    # the md5 order key is uniform: buckets by its leading digits, no sampling
    ranked = hashed_rank(keyed, "shuffle_key", id_cols, size_col="_n")
    n = F.col("_n").cast("double")
    n_train = F.floor(n * F.lit(float(train_ratio)))
    n_valid = F.floor(n * F.lit(float(valid_ratio)))
    split = (F.when(F.col("rank") <= n_train, F.lit("train"))
              .when(F.col("rank") <= n_train + n_valid, F.lit("valid"))
              .otherwise(F.lit("test")))
    return ranked.withColumn("split", split).drop("_n")


# Rows of the two deciding buckets that are sorted on the driver; larger buckets are counted more finely.
MAX_LAST_BUCKET = 10_000
_DIGITS = 3  # hex digits a histogram resolves: at most 4,096 rows reach the driver


def rows_at(keys: DataFrame, positions: Sequence[int], order_cols: Sequence[str]) -> list:
    """The rows at 1-based ``positions`` of ``keys`` in the order of its columns ``order_cols``, of which the
    first is a lowercase hex digest (uniform). None for a position outside.

    Distributed selection: a histogram over the digest's first digits names the bucket that holds a
    position, the next digits are counted in that bucket only, and so on until it is small; only its rows
    are sorted. No exchange of rows, only of counts.
    """
    key = order_cols[0]
    out = []
    known: dict[str, list] = {}
    for p in positions:
        prefix, before = "", 0
        while True:
            if prefix not in known:
                inside = keys.where(F.substring(key, 1, len(prefix)) == prefix) if prefix else keys
                digits = F.substring(key, 1, len(prefix) + _DIGITS).alias("b")
                known[prefix] = sorted(tuple(r) for r in inside.groupBy(digits).agg(F.count(F.lit(1)).alias("n")).collect())
            bucket = None
            for b, n in known[prefix]:
                if before < p <= before + n:
                    bucket = (b, n)
                    break
                before += n
            if bucket is None:
                out.append(None)
                break
            prefix, n = bucket
            if n <= MAX_LAST_BUCKET or len(prefix) >= 32:
                rows = keys.where(F.substring(key, 1, len(prefix)) == prefix).select(*order_cols).orderBy(*order_cols).limit(p - before)
                out.append(rows.collect()[-1])
                break
    return out


def split_by_selection(df: DataFrame, train_ratio: float = TRAIN_RATIO, valid_ratio: float = VALID_RATIO,
                       seed: int | str = DEFAULT_SEED, id_cols: Sequence[str] = ID_COLS) -> DataFrame:
    """``df`` with ``split`` as :func:`split_corpus` gives it, without ranks: only the two rows where the
    split changes are looked up (``rows_at``, over the ids and digests, written once); every other row is
    compared with them where it lies, so the corpus is neither shuffled nor sorted.
    """
    order = ["shuffle_key", *id_cols]
    keys = materialize(with_shuffle_key(df, seed, id_cols).select(*order))
    n = float(keys.count())
    n_train, n_valid = int(n * train_ratio), int(n * valid_ratio)
    last_train, last_valid = rows_at(keys, [n_train, n_train + n_valid], order)
    types = {f.name: f.dataType for f in keys.schema.fields}

    def upto(row):
        if row is None:
            return F.lit(False)
        return F.struct(*order) <= F.struct(*[F.lit(row[c]).cast(types[c]).alias(c) for c in order])

    keyed = with_shuffle_key(df, seed, id_cols)
    split = F.when(upto(last_train), F.lit("train")).when(upto(last_valid), F.lit("valid")).otherwise(F.lit("test"))
    return keyed.withColumn("split", split).drop("shuffle_key")


def with_batch_id(df: DataFrame, batch_size: int = BATCH_SIZE, order_cols: Sequence[str] = ("rank",),
                  partition_cols: Sequence[str] = ("split",), epoch_seed: int | str | None = None,
                  id_cols: Sequence[str] = ID_COLS) -> DataFrame:
    """Fixed-size mini-batches in order within each split.

    With ``epoch_seed`` the order is re-drawn (a per-epoch shuffle, as for
    training batches) from ``md5(epoch_seed|id)``.
    """
    order = list(order_cols)
    if epoch_seed is None and order == ["rank"] and list(partition_cols) == ["split"]:
        # ranks are exact and a split is a contiguous range of them: a projection
        # over one row per split, no sort and no copy of the corpus
        first = df.groupBy(F.col("split").alias("_s")).agg(F.min("rank").alias("_first"))
        return (df.join(F.broadcast(first), F.col("split") == F.col("_s"))
                  .withColumn("batch_id", F.floor((F.col("rank") - F.col("_first")) / F.lit(batch_size)).cast("long"))
                  .drop("_s", "_first"))
    if epoch_seed is not None:
        df = df.withColumn("_bkey", shuffle_key(epoch_seed, id_cols))
        order = ["_bkey", *id_cols]
    pos = global_rank(df, order, partition_cols, rank_col="_bpos", size_col=None)
    out = pos.withColumn("batch_id", F.floor((F.col("_bpos") - 1) / F.lit(batch_size)).cast("long"))
    return out.drop("_bpos", "_bkey")
