"""Broadcast bounds and the shared checkpoint folder."""

from utterspark.session import _row_bytes, broadcast_if_bounded, ensure_checkpoint_dir


def _broadcast_planned(spark, small):
    big = spark.range(3)
    j = big.join(small, big.id == small.i, "left")
    return "ResolvedHint (strategy=broadcast)" in j._jdf.queryExecution().analyzed().toString()


def test_broadcast_needs_row_and_byte_bounds(spark):
    df = spark.createDataFrame([("a" * 1000, [1.0, 2.0], i) for i in range(10)],
                               "s string, v array<double>, i long")
    assert _broadcast_planned(spark, broadcast_if_bounded(df, 100, 1 << 20))
    assert not _broadcast_planned(spark, broadcast_if_bounded(df, 5, 1 << 20))    # too many rows
    assert not _broadcast_planned(spark, broadcast_if_bounded(df, 100, 5_000))    # too many bytes


def test_checkpoint_dir_is_kept_when_configured(spark):
    current = spark.sparkContext.getCheckpointDir()
    assert current
    assert ensure_checkpoint_dir(spark) == current


def test_nested_values_count_what_they_hold(spark):
    kind = "a array<string>, b array<struct<s:string,i:int>>, m map<string,array<string>>, t struct<x:string,y:array<long>>, n array<long>, z long"
    long = "x" * 1000
    rows = [([long, long], [(long, 1)], {long: [long, None]}, (long, [1, 2]), [1, 2, 3], 1), (None, None, None, None, None, None), ([None], [None], {}, (None, None), [], 0)]
    sizes = [r[0] for r in spark.createDataFrame(rows, kind).select(_row_bytes(spark.createDataFrame(rows, kind))).collect()]
    assert 6_000 < sizes[0] < 6_600 and sizes[1] < 250 and sizes[2] < 300
    df = spark.createDataFrame([([long] * 10, i) for i in range(10)], "a array<string>, i long")
    assert not _broadcast_planned(spark, broadcast_if_bounded(df, 100, 50_000))
    assert _broadcast_planned(spark, broadcast_if_bounded(df, 100, 200_000))
