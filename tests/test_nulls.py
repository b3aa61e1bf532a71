"""Rows with NULL sources, positions and keys survive de-duplication and increments."""

import itertools

import pytest

from utterspark.operators import corpus as C

KIND = "text string, intent string, is_negative boolean, source_file string, row_pos long"


def frame(spark, rows):
    return spark.createDataFrame(rows, KIND).repartition(3)


def first_rows(rows):
    """The first row of every key: NULL sources first, NULL positions last."""
    order = lambda r: (r[3] is not None, r[3] or "", r[4] is None, r[4] or 0)
    best = {}
    for r in sorted(rows, key=order):
        best.setdefault(r[:3], r)
    return sorted(best.values(), key=repr)


def test_texts_without_source_or_position_stay(spark):
    rows = [("a", "x", False, "f", 1), ("b", "x", False, None, 2), ("c", "x", False, "f", None), ("d", "x", False, None, None)]
    for scope in ("file", "intent", "corpus"):
        assert sorted((tuple(r) for r in C.dedup(frame(spark, rows), scope).collect()), key=repr) == sorted(rows, key=repr)


@pytest.mark.parametrize("broadcast", [True, False])
def test_all_combinations_of_nulls(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(C, "MAX_BROADCAST_KEYS", 0)
    rows = list(itertools.product(["t", None], ["i", None], [True, None], ["f", "g", None], [None, 0, -5, 2**63 - 1, -(2**63)]))
    got = sorted((tuple(r) for r in C.dedup(frame(spark, rows * 2), "corpus").collect()), key=repr)
    assert got == first_rows(rows) and len(got) == 8


def test_first_row_by_file_and_position(spark):
    rows = [("a", "x", False, f, p) for f in ("g", "f") for p in (7, None, 3)] + [("a", "y", True, "g", None), ("a", "y", True, "h", 1)]
    got = sorted((tuple(r) for r in C.dedup(frame(spark, rows), "intent").collect()), key=repr)
    assert got == first_rows(rows) == [("a", "x", False, "f", 3), ("a", "y", True, "g", None)]


def test_increment_keeps_null_sources_and_knows_null_keys(spark):
    corpus = frame(spark, [("a", "x", False, "f", 1), (None, "x", None, "f", 2)])
    batch = frame(spark, [("a", "x", False, None, 9), ("b", "x", False, None, None), ("c", None, False, "g", 1), (None, "x", None, None, 3), ("b", "x", False, None, None)])
    got = sorted((tuple(r) for r in C.increment(corpus, batch).collect()), key=repr)
    want = [("a", "x", False, "f", 1), (None, "x", None, "f", 2), ("b", "x", False, None, None), ("c", None, False, "g", 1)]
    assert got == sorted(want, key=repr)


def test_aggregate_still_hashes(spark):
    plan = C.dedup(frame(spark, [("a", "x", False, "f", 1)]), "corpus")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
