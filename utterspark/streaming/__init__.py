"""Structured Streaming operators: continuous scoring and incremental ingest."""

from utterspark.streaming.score import score_stream, score_text_stream  # noqa: F401
from utterspark.streaming.ingest import ingest_stream  # noqa: F401
from utterspark.streaming.runner import run_available_now  # noqa: F401
from utterspark.streaming.keyed import ingest_keyed  # noqa: F401
