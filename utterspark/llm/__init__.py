"""Operators of a training-data pipeline, one module each.

``queries.QUERIES`` holds the registered ``opN_<name>`` queries and
``queries.ORACLES`` their DuckDB SQL where SQL can express them.
"""
