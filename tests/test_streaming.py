import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF0001
from utterspark.operators.scoring import centroid_model, linear_logits, with_probabilities
from utterspark.operators.decide import decide
from utterspark.sources.tables import scored_labels, table
from utterspark.streaming import ingest_stream, run_available_now, score_stream


def _stage(spark, tmp_dir, rows, schema, n_files):
    df = spark.createDataFrame(rows, schema)
    path = f"{tmp_dir}/stage"
    df.repartitionByRange(n_files, "id").write.parquet(path)
    return path, df.schema


def test_ingest_dedups_across_micro_batches(spark, tmp_dir):
    rows = [(i, f"t{i % 7}", "A", False) for i in range(40)]
    path, schema = _stage(spark, tmp_dir, rows, "id long, text string, intent string, is_negative boolean", 5)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = run_available_now(ingest_stream(stream).select("text", "intent", "is_negative"), "t-ingest")
    assert sorted(r["text"] for r in out.collect()) == [f"t{i}" for i in range(7)]


def test_ingest_with_watermark_ntz_time(spark, tmp_dir):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, f"t{i % 3}", "A", False, base + dt.timedelta(seconds=i)) for i in range(30)]
    path, schema = _stage(spark, tmp_dir, rows,
                          "id long, text string, intent string, is_negative boolean, ts timestamp_ntz", 3)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = run_available_now(ingest_stream(stream, event_time="ts", delay="1 hour")
                            .select("text", "intent", "is_negative"), "t-ingest-wm")
    assert sorted(r["text"] for r in out.collect()) == ["t0", "t1", "t2"]


def test_score_stream_equals_batch(spark):
    emb = table(spark, SF0001, "embeddings")
    model = centroid_model(emb.select("embedding", F.col("label").cast("int").alias("y")), "embedding", "y")
    labels = scored_labels(spark, SF0001)
    stream = (spark.readStream.schema(emb.schema).option("pathGlobFilter", "embeddings.parquet")
              .parquet(SF0001))
    s = run_available_now(score_stream(stream.select("vec_id", "embedding"), model, labels, scale=128.0)
                          .select("vec_id", F.col("decision")[0]["label"].alias("label")), "t-score")
    batch = decide(with_probabilities(linear_logits(emb.select("vec_id", "embedding"), model, scale=128.0)),
                   labels).select("vec_id", F.col("decision")[0]["label"].alias("label"))
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, batch.collect()))
    assert s.count() == emb.count()


def test_text_stream_equals_batch(spark, tmp_dir):
    from utterspark.operators.corpus import valid_inputs
    from utterspark.operators.training import score
    from utterspark.plans.model_plans import _weighted_model
    from utterspark.streaming import score_text_stream

    model, _, labels = _weighted_model(spark, SF0001)
    conv = table(spark, SF0001, "conversations").filter(F.col("role") == "user").select("conv_id", "turn", "text")
    path = f"{tmp_dir}/turns"
    conv.repartitionByRange(3, "conv_id", "turn").write.parquet(path)
    stream = spark.readStream.schema(conv.schema).option("maxFilesPerTrigger", 1).parquet(path)
    flat = lambda df: df.select("conv_id", "turn", F.to_json("decision").alias("d"))
    got = run_available_now(flat(score_text_stream(stream, model, labels)), "t-text-stream")
    want = flat(decide(score(model, valid_inputs(conv)), labels))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() > 0
