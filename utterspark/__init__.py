"""Spark-native utterance-intent corpus, scoring and evaluation library.

Everything here is expressed with the DataFrame API so Catalyst can prune,
push down and plan the work; Python code runs on executors only where a
built-in expression cannot state the semantics (sheet parsing).
"""

__version__ = "0.1.0"
