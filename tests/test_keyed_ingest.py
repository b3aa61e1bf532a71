"""Stream de-duplication against keys in files: restarts, repeated batches, merging, pruning."""

import pytest
from pyspark.sql import functions as F

from utterspark.operators.corpus import UTTERANCE_KEY
from utterspark.streaming import keyed as K

KIND = "text string, intent string, is_negative boolean, source_file string, row_pos long"


def rows(n, start=0, distinct=37):
    out = [(f"t{i % distinct}", ["A", None][i % 5 == 0], [False, None][i % 7 == 0], [f"f{i % 3}", None][i % 11 == 0], i) for i in range(start, start + n)]
    return out + [(None, "A", False, "f", 1), (None, "A", False, None, None)]


def stage(spark, folder, batches):
    for i, b in enumerate(batches):
        spark.createDataFrame(b, KIND).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        if i == 0:
            schema = spark.read.parquet(f"{folder}/in").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


def keys_of(df):
    return sorted((tuple(r) for r in df.select(*UTTERANCE_KEY).collect()), key=repr)


def distinct(*batches):
    return sorted({r[:3] for b in batches for r in b}, key=repr)


def test_a_stream_keeps_one_row_per_key(spark, tmp_dir):
    batches = [rows(60), rows(50, 30, 41), rows(10, 5)]
    out = K.ingest_keyed(stage(spark, tmp_dir, batches), "t", folder=f"{tmp_dir}/out")
    assert keys_of(out) == distinct(*batches)
    assert out.columns == [f.split()[0] for f in KIND.split(", ")]


def test_a_stream_goes_on_after_a_failure_in_mid_batch(spark, tmp_dir, monkeypatch):
    batches = [rows(40), rows(40, 20, 53), rows(40, 10, 61)]
    stream = stage(spark, tmp_dir, batches)
    whole, calls = K.KeyTable.append, []

    def fails_once(self, keys, batch_id):
        calls.append(batch_id)
        if len(calls) == 2:  # the second batch has written its rows, not its keys
            raise OSError("executor lost")
        whole(self, keys, batch_id)

    monkeypatch.setattr(K.KeyTable, "append", fails_once)
    with pytest.raises(Exception, match="executor lost"):
        K.ingest_keyed(stream, "t", folder=f"{tmp_dir}/out")
    out = K.ingest_keyed(stream, "t", folder=f"{tmp_dir}/out")
    assert keys_of(out) == distinct(*batches)
    assert len(calls) == 4


def test_a_batch_that_runs_twice_gives_the_same_rows(spark, tmp_dir):
    keys = K.KeyTable(spark, f"{tmp_dir}/keys")
    a, b = (spark.createDataFrame(rows(30, s, d), KIND) for s, d in ((0, 17), (9, 23)))
    for batch_id, df in ((0, a), (1, b), (0, a), (1, b), (1, b)):
        K.ingest_batch(df, batch_id, f"{tmp_dir}/out", keys)
    out = K.read_sink(spark, f"{tmp_dir}/out", a.schema)
    assert keys_of(out) == distinct(rows(30, 0, 17), rows(30, 9, 23))


def test_merged_keys_are_those_of_the_batches(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(K, "COMPACT_EVERY", 2)
    keys = K.KeyTable(spark, f"{tmp_dir}/keys")
    for i in range(5):
        K.ingest_batch(spark.createDataFrame(rows(20, 13 * i, 90), KIND), i, f"{tmp_dir}/out", keys)
    assert [f.rsplit("/", 1)[1] for f in keys.folders(5)] == ["upto=3", "batch=4"]
    assert [f.rsplit("/", 1)[1] for f in keys.folders(3)] == ["upto=1", "batch=2"]
    every = distinct(*[rows(20, 13 * i, 90) for i in range(5)])
    assert keys_of(K.read_sink(spark, f"{tmp_dir}/out", spark.createDataFrame([], KIND).schema)) == every
    assert keys.read(5).distinct().count() == keys.read(5).count() == len(every)


def test_only_touched_buckets_are_read(spark, tmp_dir):
    keys = K.KeyTable(spark, f"{tmp_dir}/keys")
    keys.append(spark.range(500).select(F.sha2(F.col("id").cast("string"), 256).alias("_key")), 0)
    plan = keys.read(1, ["0a", "ff"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan
    some = {r[0] for r in keys.read(1, ["0a", "ff"]).collect()}
    assert some and {k[:2] for k in some} <= {"0a", "ff"}


def test_first_row_of_a_key_and_an_empty_batch(spark, tmp_dir):
    df = spark.createDataFrame([("a", "A", False, "g", 1), ("a", "A", False, "f", 9), ("a", "A", False, "f", 3)], KIND)
    assert [tuple(r)[1:] for r in K.first_of_each_key(df, UTTERANCE_KEY, ["source_file", "row_pos"]).collect()] == [("a", "A", False, "f", 3)]
    keys = K.KeyTable(spark, f"{tmp_dir}/keys")
    K.ingest_batch(df.limit(0), 0, f"{tmp_dir}/out", keys)
    K.ingest_batch(df, 1, f"{tmp_dir}/out", keys)
    assert K.read_sink(spark, f"{tmp_dir}/out", df.schema).count() == 1
    assert K.read_sink(spark, f"{tmp_dir}/nowhere", df.schema).count() == 0


def test_state_store_is_on_disk(spark, tmp_dir):
    from utterspark.streaming import ingest_stream, run_available_now

    out = run_available_now(ingest_stream(stage(spark, tmp_dir, [rows(30), rows(30)])).select(*UTTERANCE_KEY), "t-rocks")
    assert keys_of(out) == distinct(rows(30))
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
