"""What tasks and the driver hold, and how often the corpus is built, does not follow the rows."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.conftest import SF0001
from utterspark.functions.slices import cuts_of
from utterspark.operators import epochs as EP
from utterspark.operators import pieces as P
from utterspark.operators import subwords as S
from utterspark.operators import training as T


def peak_of(run) -> int:
    tracemalloc.start()
    run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak


def test_cuts():
    assert cuts_of(np.array([0, 3, 3, 9, 10, 11]), 5) == [(0, 2), (2, 3), (3, 5)]
    assert cuts_of(np.array([0]), 5) == [] and cuts_of(np.array([7, 7, 7]), 5) == [(0, 2)]


def test_a_gradient_task_unpacks_a_part_of_a_batch_at_a_time():
    n, each = 4_000, 1_000
    idx = pa.ListArray.from_arrays(pa.array(np.arange(0, n * each + 1, each), pa.int32()), pa.array(np.tile(np.arange(each), n).astype(np.int32)))
    val = pa.ListArray.from_arrays(idx.offsets, pa.array(np.ones(n * each)))
    batch = pa.RecordBatch.from_pydict({"idx": idx, "val": val, "y": pa.array(np.arange(n) % 3, pa.int32()), "w": pa.array(np.ones(n)),
                                        "split": pa.array(["valid"] * n), "batch_id": pa.array(np.arange(n) // 32)})
    for task in (EP._gradient_task(np.zeros((3, each + 1))), EP._metric_task(np.zeros((3, each + 1)), 1)):
        assert peak_of(lambda: list(task([batch]))) < 8 * n * each  # less than one number a value


def test_the_first_round_of_a_part_makes_its_rows_once():
    words, dim = 20_000, 64
    keys = np.arange(words)
    none = pa.nulls(words, pa.list_(pa.float32()))
    rows = {"kind": [S._WORD, S._OUT], "n": [np.ones(words, np.int64)] * 2}
    needed = pa.table({"kind": pa.array(np.repeat(rows["kind"], words).astype(np.int32)), "key": pa.array(np.tile(keys, 2)), "n": pa.array(np.concatenate(rows["n"])),
                       "grams": pa.array([[]] * (2 * words), pa.list_(pa.int64())), "vec": pa.chunked_array([none, none])})
    texts = pa.table({"seq": pa.array([1]), "keys": pa.array([keys[:50].tolist()], pa.list_(pa.int64()))})
    cfg = {"dim": dim, "window": 3, "negative": 5, "rate": 0.025, "last_rate": 0.0001, "sample": 0.0, "epochs": 1, "seed": 42, "total": 50.0, "rounds": [[0]]}
    pool = (keys[:10], np.zeros((10, dim), np.float32))
    got = []
    peak = peak_of(lambda: got.append(S._part_task(SimpleNamespace(value=pool), cfg, 0)((pa.scalar(0),), texts, needed)))
    assert peak < 3 * 2 * words * dim * 4
    out = got[0].to_pandas()
    untouched = out[(out.kind == S._WORD) & (out.key >= 50)]
    assert len(out) == 2 * words and np.array_equal(np.stack(untouched.vec), S.first_vectors(untouched.key.to_numpy(), dim, 42))


def test_word_vectors_are_a_distributed_table(spark):
    df = spark.createDataFrame([(["a", "b", "a", "c"],), (["c", "d"],), ([],)], "tokens array<string>")
    model, vectors = T.fit_word_vectors(df, vector_size=6, max_iter=2)
    assert isinstance(model, S.SubwordModel) and model.grams.count() == 0
    assert dict(vectors.dtypes)["vec"] == "array<double>"
    assert {r.token: len(r.vec) for r in vectors.collect()} == {"a": 6, "b": 6, "c": 6, "d": 6}


def test_no_more_words_are_cut_than_ids_are_kept(spark):
    class Few:
        def cut(self, words):
            assert len(words) <= 6, "words behind the last id that is kept"
            return np.arange(len(words)) + 10, np.arange(len(words) + 1)

    df = spark.createDataFrame([(1, [f"w{i}" for i in range(500)]), (2, ["", "a"]), (3, None)], "i int, words array<string>").repartition(3)
    got = {r.i: r.input_ids for r in P.encode_pieces(df, ["i"], F.col("words"), SimpleNamespace(value=Few()), 8).collect()}
    assert [len(got[i]) for i in (1, 2, 3)] == [8, 8, 8]
    assert got[1][0] == P.BEGIN_ID and got[1][-1] == P.END_ID
    assert got[2][2:] == [P.END_ID] + [0] * 5 and got[3] == [P.BEGIN_ID, P.END_ID] + [0] * 6


def test_the_corpus_of_the_models_is_built_once(spark):
    from utterspark.plans.model_plans import HASHED_DIM, _encoded, _hashed_rows

    enc, labels = _encoded(spark, SF0001)
    assert not any("parquet" in d._jdf.queryExecution().toString().lower() for d in (enc, labels))
    rows, _ = _hashed_rows(spark, SF0001, HASHED_DIM)
    assert rows.count() == enc.count() == rows.select("uid").distinct().count()


def test_mean_vectors_meet_a_large_table_once_per_token_and_part(spark, monkeypatch):
    from collections import Counter

    from pyspark.sql import functions as F

    from utterspark.operators import features as FT

    monkeypatch.setattr(FT, "VECTOR_BROADCAST_BYTES", 0)
    monkeypatch.setattr(FT, "PART_CELLS", 40)
    wanted = []
    by_parts = FT._sums_by_parts
    monkeypatch.setattr(FT, "_sums_by_parts", lambda texts, vectors, dim: wanted.append(dim) or by_parts(texts, vectors, dim))
    texts = [(i % 40, " ".join(f"t{(i * k) % 13}" for k in range(i % 9))) for i in range(60)] + [(None, "t1 t2 x"), (None, "t1"), (99, None), (100, "none known"), (101, "")]
    table = [(f"t{k}", [float(k), 1.0 - k]) for k in range(9)] + [("t3", [7.0, 7.0]), ("t5", None), (None, [1.0, 1.0])]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    vectors = spark.createDataFrame(table, "token string, vec array<double>")
    tokens = F.filter(F.split("text", " "), lambda t: t != "")
    got = {r["doc_id"]: r["vector"] for r in FT.mean_vectors(docs, "doc_id", tokens, vectors, 2).collect()}
    assert wanted == [2]
    sums, count = {}, Counter()
    for i, text in texts:
        s = sums.setdefault(i, [0.0, 0.0])
        for t in (text or "").split():
            for token, vec in table:
                if token == t and vec is not None:
                    s[0], s[1], count[i] = s[0] + vec[0], s[1] + vec[1], count[i] + 1
    assert set(got) == set(sums)
    for i, s in sums.items():
        assert all(abs(a - b / max(count[i], 1)) < 1e-12 for a, b in zip(got[i], s))
