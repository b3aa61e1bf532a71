import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import awkward_docs, docs_frame, empty, prose, write_tables
from utterspark.llm import importance, queries

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    w = WORD.findall((text or "").translate(AZ))
    return [" ".join(w[i:i + m]) for m in (1, 2, 3) for i in range(len(w) - m + 1)], len(w)


def counts(texts):
    n = [0] * 10_000
    for t in texts:
        for f in features(t)[0]:
            n[zlib.crc32(f.encode()) % 10_000] += 1
    return n


def brute(docs, target):
    """Rows (doc_id, n_features, weight, score, rank), plainly."""
    s, t = counts(x for _, x in docs), counts(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10_000) / ((a + 1) * (sum(t) + 10_000)))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text in docs:
        f, words = features(text)
        weight = sum(gain[zlib.crc32(x.encode()) % 10_000] for x in f)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = able[:5 * len(able) // 100]
    out = [(*r[:4], i + 1) for i, r in enumerate(drawn)]
    for r in drawn:
        rows.remove(r)
    return out + [(*r[:4], None) for r in rows]


def items(spark, texts):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "item_id long, text string, bucket int, n long").repartition(2)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aB1 é中-\U0001F600"), max_size=60), st.text(st.sampled_from("ab "), min_size=60, max_size=400)), max_size=5))
def test_buckets_are_the_crc32_of_the_ngrams(texts):
    bucket, row, words = importance.feature_buckets(pa.array(texts, pa.string()), importance.Crc32(), 10_000, 3)
    for i, t in enumerate(texts):
        f, n = features(t)
        assert sorted(bucket[row == i].tolist()) == sorted(zlib.crc32(x.encode()) % 10_000 for x in f) and words[i] == n


def test_very_long_words():
    texts = ["x" * n + " y " + "zé" * n for n in (63, 64, 65, 127, 128, 1000, 70_001)]
    bucket, row, _ = importance.feature_buckets(pa.array(texts), importance.Crc32(), 10_000, 3)
    for i, t in enumerate(texts):
        assert sorted(bucket[row == i].tolist()) == sorted(zlib.crc32(x.encode()) % 10_000 for x in features(t)[0])


def test_query_matches_brute_force(spark, tmp_dir):
    docs = awkward_docs() + [(500 + i, prose(500 + i % 90, 15 + i % 30), "en", "s") for i in range(200)] + [(600, prose(600, 40), "en", "s")] * 3
    target = [prose(500, 40), prose(501, 30).upper(), None, "", "x", prose(777, 50)]
    write_tables(spark, tmp_dir, docs, benchmark=items(spark, target))
    got = [tuple(r) for r in queries.op12_importance_resampling(spark, tmp_dir).collect()]
    want = brute([d[:2] for d in docs], target)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 1 + 5 * sum(features(d[1])[1] >= 20 for d in docs) // 100))


def test_copies_of_one_row_fill_the_draw(spark):
    docs = [(7, prose(7, 25), "en", "s")] * 300 + [(i, prose(i, 25), "en", "s") for i in range(20, 60)]
    target = [prose(7, 25)]
    got = importance.resample(docs_frame(spark, docs), items(spark, target)).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 18))
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got), key=repr) == sorted(brute([d[:2] for d in docs], target), key=repr)


@pytest.mark.parametrize("accuracy", [1, 7, 10_000])
@pytest.mark.parametrize("k", [1, 50, 999, 1000])
def test_bracket_is_validated_by_exact_counts(spark, accuracy, k):
    rng = np.random.default_rng(k)
    values = np.concatenate([rng.integers(0, 40, 500), rng.integers(0, 10**9, 500)]).tolist()
    rows = spark.createDataFrame([(int(v),) for v in values], "score long").repartition(4)
    low, high, above = importance.bracket(rows, "score", k, len(values), accuracy)
    values.sort(reverse=True)
    assert low <= values[k - 1] <= high and above == sum(v > high for v in values) < k


def test_empty_tables_and_no_draw(spark):
    docs = docs_frame(spark)
    assert importance.resample(empty(docs), items(spark, ["a b"])).collect() == []
    got = importance.resample(docs.limit(5), empty(items(spark, ["a"]))).collect()
    assert len(got) == 5 and all(r["rank"] is None for r in got)
    none = importance.bucket_gains(importance.bucket_counts(empty(docs)), importance.bucket_counts(empty(docs)))
    assert none.tolist() == [0] * 10_000


def test_rows_are_the_same_for_other_partitions(spark):
    docs = [(i, prose(i % 50, 30), "en", "s") for i in range(400)]
    runs = [sorted(map(tuple, importance.resample(docs_frame(spark, docs).repartition(p), items(spark, [prose(3, 30)])).select(
        "doc_id", "score", F.coalesce("rank", F.lit(-1))).collect())) for p in (1, 7)]
    assert runs[0] == runs[1]
