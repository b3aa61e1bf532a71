"""Plan registry: name -> (builder(spark, sf_dir) -> DataFrame, oracle SQL or None)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

_BUILDERS: dict[str, Builder] = {}
_ORACLES: dict[str, str] = {}

_MODULES = (
    "utterspark.plans.corpus_plans",
    "utterspark.plans.split_plans",
    "utterspark.plans.scoring_plans",
    "utterspark.plans.metric_plans",
    "utterspark.plans.feature_plans",
    "utterspark.plans.model_plans",
    "utterspark.plans.stream_plans",
    "utterspark.plans.sheet_plans",
    "utterspark.plans.piece_plans",
)


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in _BUILDERS:
            raise ValueError(f"plan {name!r} registered twice")
        _BUILDERS[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn
    return deco


def _load():
    for m in _MODULES:
        importlib.import_module(m)


def all_queries() -> dict[str, Builder]:
    _load()
    return dict(_BUILDERS)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
