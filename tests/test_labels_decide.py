import math

import pytest
from pyspark.sql import functions as F

from utterspark.functions.arrays import argmax, softmax, top_k
from utterspark.operators import decide as D
from utterspark.operators import labels as L


def _labels(spark, names):
    return L.fit_labels(spark.createDataFrame([(n,) for n in names], "intent string"))


def test_fit_labels_sorted_like_python(spark):
    names = ["Volume_up", "INVALID", "Ask_a_question_need_photo", "拍照", "😀", "Battery_check", "INVALID"]
    got = {r["label"]: r["idx"] for r in _labels(spark, names).collect()}
    assert got == {n: i for i, n in enumerate(sorted(set(names)))}
    # the invalid class is not index 0 with these labels
    assert got["INVALID"] == 2


def test_encode_unseen_policies(spark):
    labels = _labels(spark, ["a", "b"])
    df = spark.createDataFrame([("a",), ("c",)], "intent string")
    with pytest.raises(ValueError):
        L.encode_labels(df, labels, unseen="error")
    assert L.encode_labels(df, labels, unseen="skip").count() == 1
    assert L.encode_labels(df, labels, unseen="keep").filter(F.col("label_idx").isNull()).count() == 1


def test_decode(spark):
    labels = _labels(spark, ["a", "b"])
    df = spark.createDataFrame([(1,)], "pred_idx int")
    assert L.decode_labels(df, labels).first()["pred_label"] == "b"


def _scored(spark, rows):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(rows)], "id int, p array<double>")
    return df.withColumn("pred_idx", argmax("p")).withColumn("p_max", F.array_max("p"))


def test_softmax_sums_to_one_and_argmax_first_tie(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([1000.0, -1000.0, 0.0],)], "z array<double>")
    out = df.select(softmax("z").alias("p")).withColumn("k", argmax("p")).collect()
    for r in out:
        assert math.isclose(sum(r["p"]), 1.0, rel_tol=1e-12)
    assert out[0]["k"] == 1
    assert out[1]["k"] == 0


def test_top_k_ties_lower_index(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4, 0.0],)], "p array<double>")
    t = df.select(top_k("p", 3).alias("t")).first()["t"]
    assert [x["idx"] for x in t] == [1, 2, 0]


def test_decision_rules(spark):
    labels = _labels(spark, ["INVALID", "a", "b"])  # INVALID=0, a=1, b=2
    rows = [[0.1, 0.6, 0.3],    # exactly the threshold: accepted
            [0.7, 0.2, 0.1],    # INVALID arg-max, confident
            [0.5, 0.3, 0.2],    # INVALID arg-max, below threshold -> low confidence wins
            [0.2, 0.45, 0.35]]  # low confidence
    d = D.decide(_scored(spark, rows), labels, threshold=0.6)
    out = {r["id"]: r["decision"] for r in d.collect()}
    assert [(x["label"], x["probability"]) for x in out[0]] == [("a", 0.6)]
    assert out[1][0]["label"] == "UNKNOWN" and out[1][0]["reason"] == D.REASON_INVALID
    assert out[2][0]["reason"] == D.REASON_LOW_CONFIDENCE
    assert out[3][0]["probability"] == 0.0


def test_multi_label_at_low_threshold(spark):
    labels = _labels(spark, ["INVALID", "a", "b"])
    d = D.decide(_scored(spark, [[0.25, 0.3, 0.45]]), labels, threshold=0.2)
    assert [x["label"] for x in d.first()["decision"]] == ["b", "a"]


def test_threshold_uses_dictionary_index(spark):
    labels = _labels(spark, ["Ask", "Battery", "INVALID"])
    inv = L.index_of(labels, "INVALID")
    assert inv == 2
    out = D.apply_threshold(_scored(spark, [[0.5, 0.3, 0.2]]), inv).first()
    assert out["eval_idx"] == 2
    compat = D.apply_threshold(_scored(spark, [[0.5, 0.3, 0.2]]), 0).first()
    assert compat["eval_idx"] == 0
