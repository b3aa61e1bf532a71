"""Registered plans: one Spark DataFrame builder per operator, each paired
with the DuckDB SQL that states the same result independently."""

from utterspark.plans.registry import all_oracles, all_queries  # noqa: F401
