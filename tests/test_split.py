import random

import pytest

from pyspark.sql import functions as F

from utterspark.operators import split as S
from utterspark.operators.ranking import global_rank, running_totals
from utterspark.operators.split import split_corpus, with_batch_id


def _rows(spark, n):
    return spark.createDataFrame([("f", i) for i in range(n)], "source_file string, row_pos long")


def test_split_sizes_use_double_arithmetic(spark):
    # int(90 * 0.7) == 62 in Python; a decimal literal would give 63
    s = split_corpus(_rows(spark, 90))
    sizes = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert sizes == {"train": 62, "valid": 13, "test": 15}


def test_split_independent_of_partitioning(spark):
    base = _rows(spark, 1000)
    results = []
    for n in (1, 4, 16):
        s = split_corpus(base.repartition(n))
        results.append(sorted((r["row_pos"], r["split"], r["rank"]) for r in s.collect()))
    assert results[0] == results[1] == results[2]
    ranks = [r[2] for r in results[0]]
    assert sorted(ranks) == list(range(1, 1001))


def test_global_rank_with_hot_leading_value(spark):
    random.seed(1)
    vals = [0] * 3000 + [random.randint(1, 50) for _ in range(6000)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "k int, id long").repartition(7)
    r = global_rank(df, ["k", "id"], size_col="n")
    got = {row["id"]: row["rank"] for row in r.collect()}
    expect = {i: pos + 1 for pos, (_, i) in enumerate(sorted((v, i) for i, v in enumerate(vals)))}
    assert got == expect
    assert r.select(F.max("n")).first()[0] == 9000


def test_global_rank_within_groups(spark):
    df = spark.createDataFrame([(g, i) for g in ("a", "b") for i in range(50)], "g string, id long")
    r = global_rank(df, ["id"], ["g"], size_col=None, num_partitions=5)
    assert all(row["rank"] == row["id"] + 1 for row in r.collect())


def test_running_totals_brute_force(spark):
    random.seed(2)
    rows = [(c, float(s), random.randint(0, 3)) for c in range(3) for s in random.sample(range(500), 200)]
    df = spark.createDataFrame(rows, "c int, s double, v long")
    r = running_totals(df, ["s"], ["v"], partition_cols=["c"], num_partitions=6).collect()
    for row in r:
        want = sum(v for c, s, v in rows if c == row["c"] and s <= row["s"])
        total = sum(v for c, s, v in rows if c == row["c"])
        assert row["cum_v"] == want and row["total_v"] == total


def test_batches_of_32_within_split(spark):
    s = with_batch_id(split_corpus(_rows(spark, 200)))
    sizes = {(r["split"], r["batch_id"]): r["count"] for r in s.groupBy("split", "batch_id").count().collect()}
    assert sizes[("train", 0)] == 32
    assert sum(v for (sp, _), v in sizes.items() if sp == "train") == 140
    e1 = with_batch_id(split_corpus(_rows(spark, 200)), epoch_seed=1)
    e2 = with_batch_id(split_corpus(_rows(spark, 200)), epoch_seed=2)
    b1 = {r["row_pos"]: r["batch_id"] for r in e1.collect()}
    b2 = {r["row_pos"]: r["batch_id"] for r in e2.collect()}
    assert b1 != b2


def test_hashed_rank_independent_of_buckets_and_input(spark):
    from pyspark.sql import functions as F

    from utterspark.operators.ranking import hashed_rank

    base = spark.range(500).select(F.col("id"), F.md5(F.col("id").cast("string")).alias("k"))
    # add rows that share the key prefix (same bucket) and a tie on the key itself
    extra = spark.createDataFrame([(1000 + i, "00000000" + f"{i:024x}") for i in range(20)] + [(2000, "ffff"), (2001, "ffff")],
                                  "id long, k string")
    df = base.unionByName(extra)
    want = {r["id"]: i + 1 for i, r in enumerate(sorted(df.collect(), key=lambda r: (r["k"], r["id"])))}
    for parts, buckets in [(1, 1), (4, 3), (16, 17)]:
        got = hashed_rank(df.repartition(parts), "k", ["id"], num_partitions=buckets).collect()
        assert {r["id"]: r["rank"] for r in got} == want
        assert {r["group_size"] for r in got} == {len(want)}


def _utterances(spark, n, parts=3):
    return spark.range(n).select(F.col("id").alias("row_pos"), F.concat(F.lit("f"), (F.col("id") % 3).cast("string")).alias("source_file"),
                                 F.lit("text").alias("text")).repartition(parts)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 100, 1_000])
@pytest.mark.parametrize("last", [10_000, 3])
def test_selection_gives_the_split_of_the_ranks(spark, monkeypatch, n, last):
    monkeypatch.setattr(S, "MAX_LAST_BUCKET", last)
    monkeypatch.setattr(S, "_DIGITS", 1 if last == 3 else 3)
    df = _utterances(spark, n)
    want = {(r.source_file, r.row_pos): r.split for r in S.split_corpus(df).collect()}
    got = S.split_by_selection(df)
    assert got.columns == [*df.columns, "split"]
    assert {(r.source_file, r.row_pos): r.split for r in got.collect()} == want and len(want) == n


def test_selection_does_not_exchange_the_corpus(spark, tmp_dir):
    _utterances(spark, 200).write.parquet(f"{tmp_dir}/u")
    plan = S.split_by_selection(spark.read.parquet(f"{tmp_dir}/u"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan


def test_selection_with_repeated_and_null_ids(spark):
    df = spark.createDataFrame([("f", None, "a"), (None, 1, "b"), (None, None, "c")] * 5 + [("f", 2, "d")] * 30, "source_file string, row_pos long, text string")
    got = S.split_by_selection(df).groupBy("split").count().collect()
    assert sum(r["count"] for r in got) == 45
