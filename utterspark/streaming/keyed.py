"""Exact de-duplication of a stream against every key ever seen, with the keys in files.

``ingest_stream`` keeps its keys in a state store, which grows with the stream. Here the keys seen so far
are a table in the shared folder: digests, cut into buckets by their first digits, one folder per
micro-batch. A micro-batch is written once, cut to one row per key, and joined only with the buckets it
touches (Spark prunes the rest by folder; inside a file a Bloom filter per column chunk answers most
digests without reading it); what is new goes to the sink and its digests to the key table. Every
``COMPACT_EVERY`` batches the folders are merged into one, so a batch reads few files.

Idempotent by batch id: a batch reads only keys of earlier batches and overwrites its own folders, so a
restart in mid-batch, or a batch that ran twice, gives the answer of one run. Nothing is kept in executor
memory between batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from utterspark.operators.corpus import UTTERANCE_KEY
from utterspark.session import scratch_path

BUCKET_DIGITS = 2  # 256 buckets
COMPACT_EVERY = 50
_KEY = "_key string"


def key_digest(key: Sequence[str] = UTTERANCE_KEY):
    """sha256 of the key columns; NULL differs from every value and equals itself."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in key]), {"ignoreNullFields": "false"}), 256)


class KeyTable:
    """Digests seen in earlier batches: ``batch=<id>`` folders and ``upto=<id>`` folders of merged ones, each
    with sub-folders per bucket. A folder counts once it is complete (Spark's _SUCCESS)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _complete(self, kind: str) -> list[int]:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}=*/_SUCCESS"))
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in (found or []))

    def folders(self, before: int) -> list[str]:
        """The folders that together hold the keys of all batches before ``before``."""
        merged = [u for u in self._complete("upto") if u < before]
        start = merged[-1] if merged else -1
        return ([f"{self.path}/upto={start}"] if merged else []) + [f"{self.path}/batch={b}" for b in self._complete("batch") if start < b < before]

    def read(self, before: int, buckets: list[str] | None = None) -> DataFrame:
        """(_key) of batches before ``before``, in the given buckets only."""
        schema = StructType.fromDDL(f"{_KEY}, bucket string")
        out = None
        for folder in self.folders(before):
            part = self.spark.read.schema(schema).parquet(folder)
            out = part if out is None else out.unionByName(part)
        out = self.spark.createDataFrame([], schema) if out is None else out
        return (out if buckets is None else out.where(F.col("bucket").isin(buckets))).select("_key")

    def _write(self, keys: DataFrame, folder: str) -> None:
        bucket = F.substring("_key", 1, BUCKET_DIGITS).alias("bucket")
        (keys.select("_key", bucket).repartition("bucket").sortWithinPartitions("bucket", "_key").write.mode("overwrite")
         .option("parquet.bloom.filter.enabled#_key", "true").partitionBy("bucket").parquet(folder))

    def append(self, keys: DataFrame, batch_id: int) -> None:
        self._write(keys, f"{self.path}/batch={batch_id}")

    def merge(self, batch_id: int) -> None:
        """One folder for all batches up to and with ``batch_id``; the old ones stay, unread."""
        self._write(self.read(batch_id + 1), f"{self.path}/upto={batch_id}")


def first_of_each_key(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order`` and then by its whole content. A key that a third of the rows
    share costs one partial row per task."""
    kept = F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"_r{i}") for i, c in enumerate(rows.columns)])
    g = rows.groupBy(key_digest(key).alias("_key")).agg(F.min(kept).alias("_row"))
    return g.select("_key", *[F.col("_row")[f"_r{i}"].alias(c) for i, c in enumerate(rows.columns)])


def ingest_batch(rows: DataFrame, batch_id: int, sink: str, keys: KeyTable, key: Sequence[str] = UTTERANCE_KEY, order: Sequence[str] = ("source_file", "row_pos")) -> None:
    """Write the rows of a micro-batch whose key no earlier batch had: the body of ``foreachBatch``."""
    spark = rows.sparkSession
    once = f"{sink.rstrip('/')}/_stage/batch={batch_id}"
    first_of_each_key(rows, key, order).write.mode("overwrite").parquet(once)
    batch = spark.read.parquet(once)
    bucket = F.substring("_key", 1, BUCKET_DIGITS)
    touched = [r[0] for r in batch.select(bucket.alias("b")).distinct().collect()]  # at most 256
    new = batch.join(keys.read(batch_id, touched), "_key", "left_anti")
    new.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/rows/batch={batch_id}")
    keys.append(spark.read.parquet(f"{sink.rstrip('/')}/rows/batch={batch_id}").select("_key"), batch_id)
    if batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
        keys.merge(batch_id)


def ingest_keyed(stream: DataFrame, name: str, key: Sequence[str] = UTTERANCE_KEY, order: Sequence[str] = ("source_file", "row_pos"),
                 folder: str | None = None) -> DataFrame:
    """Run ``stream`` to its present end and return the sink as a batch DataFrame: the rows of ``stream`` whose
    key was never seen, the first of each key. ``folder`` (shared) holds sink, keys and offsets; given
    again, the stream goes on where it stopped."""
    spark = stream.sparkSession
    folder = (folder or scratch_path(spark, name)).rstrip("/")
    keys = KeyTable(spark, f"{folder}/keys")
    q = (stream.writeStream.option("checkpointLocation", f"{folder}/offsets").trigger(availableNow=True)
         .foreachBatch(lambda rows, batch_id: ingest_batch(rows, batch_id, folder, keys, key, order)).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_sink(spark, folder, stream.schema)


def read_sink(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/rows")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/rows").select(*schema.names)
