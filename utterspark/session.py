"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "utterspark",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session tuned for this library: AQE on, UI off, UTC clock."""
    master = master or os.environ.get("SPARK_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster's ``spark.checkpoint.dir`` wins; only when nothing is set
    (local runs and tests) a private folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="utterspark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark application.

    Functions that run in workers are pickled by reference, so a worker that does not start in the
    repository folder must find the package among the files Spark distributes.
    """
    sc = spark.sparkContext
    if getattr(sc, "_utterspark_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="utterspark-zip-"), "utterspark_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)  # copied by Spark's own file server; the local zip is only its source
    sc._utterspark_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def materialize(df):
    """Cut lineage at a fan-out point: a reliable checkpoint in the shared folder.

    Later branches read the written rows instead of recomputing the plan, and a
    lost executor cannot force a recomputation from the sources.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df, *past):
    """:func:`materialize` for a step of a long run: the shuffle files behind the written rows go as soon as they
    are written, and so do those of ``past``, settled tables that nothing reads any more. Left to the driver's
    garbage collection, every step's files stay until the run ends."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        out = df.checkpoint(eager=True)
        out.schema  # noqa: B018 - resolved while the setting holds
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP_CONF)
        else:
            spark.conf.set(SHUFFLE_CLEANUP_CONF, before)
    for old in past:
        forget(old)
    return out


def forget(df) -> None:
    """Delete the written rows of a settled table; another table is left alone."""
    sc, plan = df.sparkSession.sparkContext, df._jdf.queryExecution().logical()
    written = plan.rdd().getCheckpointFile() if plan.getClass().getSimpleName() == "LogicalRDD" else None
    if written is not None and written.isDefined():
        path = sc._jvm.org.apache.hadoop.fs.Path(written.get())
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


# Broadcast budget: a table is broadcast only when a pass over it proves it
# holds at most this many bytes (estimated from string octets and array widths).
MAX_BROADCAST_BYTES = 256 << 20


def _value_bytes(c, kind):
    """Size estimate of a value: strings and binaries by their octets, arrays, maps and structs by what they
    hold (fixed-width elements at 8 bytes without looking at them), everything else 8 bytes."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("long")
    if isinstance(kind, ArrayType):
        if not isinstance(kind.elementType, (StringType, BinaryType, ArrayType, MapType, StructType)):
            return F.lit(16) + F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)).cast("long") * 8
        held = F.aggregate(c, F.lit(16).cast("long"), lambda acc, x: (acc + 16 + _value_bytes(x, kind.elementType)).cast("long"))
        return F.coalesce(held, F.lit(16).cast("long"))
    if isinstance(kind, StructType):
        total = F.lit(16).cast("long")
        for f in kind.fields:
            total = total + _value_bytes(c[f.name], f.dataType)
        return total
    if isinstance(kind, MapType):
        entry = StructType().add("key", kind.keyType).add("value", kind.valueType)
        return _value_bytes(F.map_entries(c), ArrayType(entry))
    return F.lit(8).cast("long")


def _row_bytes(df):
    """Per-row size estimate: what the values hold, plus a fixed per-row overhead."""
    from pyspark.sql import functions as F

    total = F.lit(32).cast("long")
    for f in df.schema.fields:
        total = total + _value_bytes(F.col(f"`{f.name}`"), f.dataType)
    return total


def broadcast_if_bounded(df, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES):
    """Broadcast hint only behind a checked bound on rows *and* bytes; larger
    tables are joined with a shuffle (AQE splits skewed keys)."""
    from pyspark.sql import functions as F

    # a plain partial aggregate: no limit that would funnel rows into one task
    probe = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).first()
    n, b = int(probe["n"]), int(probe["b"] or 0)
    return F.broadcast(df) if n <= max_rows and b <= max_bytes else df
