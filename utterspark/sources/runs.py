"""Runs: everything a training run leaves behind, in one folder that counts only when it is complete.

A run folder holds tables (label dictionary, vectors, ROC curves, dense confusion matrix, history), fitted
models and the metrics document. ``finish`` writes the manifest last, under a temporary name that is then
renamed, so a run that was killed half-way has no manifest and no reader ever sees it. The folder is on the
file system Spark uses (the shared checkpoint folder, or any path given).
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.classification import OneVsRestModel
from pyspark.sql import DataFrame, SparkSession

MANIFEST = "manifest.json"
LOADERS = {"PipelineModel": PipelineModel, "OneVsRestModel": OneVsRestModel}


class EmptyCorpus(ValueError):
    """There is nothing to train or score; the message says what was looked for."""


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``df``, or an :class:`EmptyCorpus` that ends the run if it has no row."""
    if df.isEmpty():
        raise EmptyCorpus(f"no {what}: the run ends here")
    return df


class _Files:
    """The few file operations a run needs, on Spark's file system."""

    def __init__(self, spark: SparkSession, base: str):
        self.jvm = spark._jvm
        self.fs = self.path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def exists(self, p: str) -> bool:
        return self.fs.exists(self.path(p))

    def write_last(self, p: str, text: str) -> None:
        """The file appears whole or not at all."""
        unfinished = self.path(f"{p}.{uuid.uuid4().hex}.tmp")
        out = self.fs.create(unfinished, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not self.fs.rename(unfinished, self.path(p)):
            raise OSError(f"cannot write {p}")

    def read(self, p: str) -> str:
        stream = self.fs.open(self.path(p))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def children(self, p: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(p))) if self.exists(p) else []


class Run:
    """A run being written, or a finished one that is read."""

    def __init__(self, spark: SparkSession, folder: str, manifest: dict | None = None):
        self.spark, self.folder, self.manifest = spark, folder.rstrip("/"), manifest
        self._files = _Files(spark, self.folder)
        self._parts: dict[str, str] = dict(manifest["parts"]) if manifest else {}

    @classmethod
    def start(cls, spark: SparkSession, base: str) -> "Run":
        """A new run in ``base``; names sort by the time they were started."""
        return cls(spark, f"{base.rstrip('/')}/run-{time.strftime('%Y%m%d-%H%M%S')}-{time.time_ns() % 10**9:09d}-{uuid.uuid4().hex[:6]}")

    def _part(self, name: str, kind: str) -> str:
        if self.manifest is not None:
            raise ValueError("a finished run does not change")
        if name in self._parts:
            raise ValueError(f"{name!r} is already part of the run")
        self._parts[name] = kind
        return f"{self.folder}/{name}"

    def add_table(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table of any size; returns the written rows."""
        path = self._part(name, "table")
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def add_model(self, name: str, model) -> None:
        kind = type(model).__name__
        if kind not in LOADERS:
            raise ValueError(f"unknown kind of model {kind}")
        model.write().save(self._part(name, kind))

    def add_document(self, name: str, document: DataFrame) -> None:
        """A one-row document (see ``store.metrics_document``)."""
        document.coalesce(1).write.text(self._part(name, "document"))

    def finish(self, **about) -> "Run":
        """Make the run visible. ``about`` goes into the manifest."""
        self.manifest = {"parts": self._parts, "about": about, "finished": time.strftime("%Y-%m-%dT%H:%M:%S")}
        self._files.write_last(f"{self.folder}/{MANIFEST}", json.dumps(self.manifest, sort_keys=True))
        return self

    def _of(self, name: str, *kinds: str) -> str:
        if self._parts.get(name) not in kinds:
            raise KeyError(f"the run has no {name!r} of this kind")
        return f"{self.folder}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._of(name, "table"))

    def model(self, name: str):
        path = self._of(name, *LOADERS)
        return LOADERS[self._parts[name]].load(path)

    def document(self, name: str) -> dict:
        return json.loads(self.spark.read.text(self._of(name, "document")).first()[0])


def finished_runs(spark: SparkSession, base: str) -> list[Run]:
    """The complete runs of ``base``, oldest first."""
    files, base = _Files(spark, base), base.rstrip("/")
    out = []
    for name in files.children(base):
        manifest = f"{base}/{name}/{MANIFEST}"
        if name.startswith("run-") and files.exists(manifest):
            out.append(Run(spark, f"{base}/{name}", json.loads(files.read(manifest))))
    return out


def latest_run(spark: SparkSession, base: str) -> Run:
    runs = finished_runs(spark, base)
    if not runs:
        raise FileNotFoundError(f"no finished run in {base}")
    return runs[-1]
