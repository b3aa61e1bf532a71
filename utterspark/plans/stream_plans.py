"""Streaming plans: each runs a real Structured Streaming
query over the tables (or files Spark derives from them) and returns its sink;
the oracle is the batch answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from utterspark.operators import corpus as C
from utterspark.operators.scoring import centroid_model
from utterspark.plans.registry import register
from utterspark.plans.scoring_plans import _decision_sql
from utterspark.plans.sql_fixtures import RAW_UTTERANCES
from utterspark.session import scratch_path, shuffle_partitions
from utterspark.sources.tables import SCORE_SCALE, scored_labels, sheet_rows, table
from utterspark.streaming import ingest_keyed, ingest_stream, run_available_now, score_stream, score_text_stream

# A stream reads its files in about this many micro-batches, whatever their
# number: the batch count does not grow with the data.
MICRO_BATCHES = 4


def stream_table(spark, sf_dir, name):
    """The given table as a stream: a folder of part files is read whole, a
    single Parquet file is picked out of its folder by name."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    batch = spark.read.parquet(path)
    reader = spark.readStream.schema(batch.schema)
    if not fs.getFileStatus(jpath).isDirectory():
        return reader.option("maxFilesPerTrigger", 1).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    n_files = fs.getContentSummary(jpath).getFileCount()
    per_trigger = max(1, -(-n_files // MICRO_BATCHES))
    return reader.option("maxFilesPerTrigger", per_trigger).option("recursiveFileLookup", "true").parquet(path)


@register("score_stream", _decision_sql(0.6))
def score_stream_plan(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    model = centroid_model(emb.select("embedding", F.col("label").cast("int").alias("y")), "embedding", "y")
    stream = stream_table(spark, sf_dir, "embeddings")
    dec = score_stream(stream.select("vec_id", "embedding"), model, scored_labels(spark, sf_dir),
                       scale=SCORE_SCALE)
    out = dec.select("vec_id", F.posexplode("decision").alias("pos", "d")).select(
        "vec_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("d.label").alias("label"),
        F.round("d.probability", 6).alias("probability"), F.col("d.reason").alias("reason"))
    return run_available_now(out, "score-stream")


def _utterance_stream(spark, sf_dir):
    """Cleaned sheet rows written as several files, and the stream that reads some of them a micro-batch."""
    rows = C.to_utterances(sheet_rows(spark, sf_dir))
    stage = scratch_path(spark, "ingest-stage")
    # balanced, deterministic files (range on the row identity, not on a hot
    # sheet), as many as the session's shuffle width
    n_files = max(MICRO_BATCHES, shuffle_partitions(spark))
    rows.repartitionByRange(n_files, "source_file", "row_pos").write.parquet(stage)
    per_trigger = max(1, -(-n_files // MICRO_BATCHES))
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", per_trigger).parquet(stage)


@register("ingest_keyed", f"""
WITH {RAW_UTTERANCES}
SELECT DISTINCT intent, is_negative, md5(text) AS text_md5 FROM raw_utterances WHERE text IS NOT NULL
""")
def ingest_keyed_plan(spark, sf_dir):
    """The same stream against a key table in files instead of a state store."""
    out = ingest_keyed(_utterance_stream(spark, sf_dir), "ingest-keyed")
    return out.select("intent", "is_negative", F.md5("text").alias("text_md5"))


@register("ingest_stream", f"""
WITH {RAW_UTTERANCES}
SELECT DISTINCT intent, is_negative, md5(text) AS text_md5 FROM raw_utterances WHERE text IS NOT NULL
""")
def ingest_stream_plan(spark, sf_dir):
    """Cleaned sheet rows land as several files; the stream reads one file per
    micro-batch and keeps only utterances never seen before."""
    stream = _utterance_stream(spark, sf_dir)
    out = ingest_stream(stream).select("intent", "is_negative", F.md5("text").alias("text_md5"))
    return run_available_now(out, "ingest-stream")


@register("score_text_stream")
def score_text_stream_plan(spark, sf_dir):
    """The prediction loop as a stream: the weighted model is fitted on the
    corpus (batch), then user turns arrive from the conversations file and
    every micro-batch gets the UNKNOWN / accepted-labels decision."""
    from utterspark.plans.model_plans import _weighted_model

    model, _, labels = _weighted_model(spark, sf_dir)
    stream = stream_table(spark, sf_dir, "conversations")
    turns = stream.filter(F.col("role") == "user").select("conv_id", "turn", "text")
    dec = score_text_stream(turns, model, labels)
    out = dec.select("conv_id", "turn", F.posexplode("decision").alias("pos", "d")).select(
        "conv_id", "turn", (F.col("pos") + 1).cast("int").alias("rank"), F.col("d.label").alias("label"),
        F.round("d.probability", 6).alias("probability"), F.col("d.reason").alias("reason"))
    return run_available_now(out, "score-text-stream")
