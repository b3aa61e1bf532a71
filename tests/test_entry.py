"""Driver contract: entry() runs, and every plan with an oracle agrees with
DuckDB on the smallest scale factor."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF0001

SLOW = {"word_vectors", "ovr_fit", "weighted_fit", "score_batch", "model_roundtrip", "metrics_document"}


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def n(v):
        return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(n(r[i]) for i in order) for r in rows), key=repr)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["intent", "is_negative", "n"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents labels embeddings conversations events benchmark pages").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_plan_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF0001)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), ocols)
