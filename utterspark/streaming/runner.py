"""Run a streaming query over everything available and read its sink back."""

from __future__ import annotations

from pyspark.sql import DataFrame

from utterspark.session import scratch_path


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_available_now(stream_df: DataFrame, name: str, output_mode: str = "append",
                      timeout_s: float | None = None) -> DataFrame:
    """Write ``stream_df`` to a Parquet sink in the shared folder with an
    ``availableNow`` trigger (all input, in as many micro-batches as the source
    options ask for), then return the sink as a batch DataFrame.

    Sink and checkpoint are in the cluster's checkpoint folder, so a restarted
    query resumes from its offsets and state. ``timeout_s`` stops a query that
    runs longer; by default a healthy stream runs as long as it needs.
    """
    spark = stream_df.sparkSession
    out = scratch_path(spark, f"{name}-out")
    ckpt = scratch_path(spark, f"{name}-ckpt")
    # state beyond executor memory: RocksDB keeps it on disk and its changes in the checkpoint
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    q = (stream_df.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).outputMode(output_mode)
         .trigger(availableNow=True).start())
    finished = q.awaitTermination(timeout_s) if timeout_s else (q.awaitTermination() or True)
    if not finished:
        q.stop()
        raise TimeoutError(f"streaming query {name} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(stream_df.schema).parquet(out)
