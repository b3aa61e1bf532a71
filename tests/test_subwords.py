"""Character n-grams and subword vectors against brute-force Python."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from utterspark.functions.text import bounded_word, char_ngrams
from utterspark.operators import features as FT


def py_ngrams(word, lo=3, hi=6):
    w = f"<{word}>"
    return [w[i:i + n] for n in range(lo, hi + 1) for i in range(len(w) - n + 1)]


EDGE = ["a", "ab", "aaaa", "Café", "déjà-vu", "你好世界", "x🙂y", "Phone_call_[contact_name]", "", "abcdefghij"]


def _grams(spark, words, lo=3, hi=6):
    df = spark.createDataFrame([(w,) for w in words], "token string").withColumn("_w", bounded_word("token"))
    return {r["token"]: r["g"] for r in df.select("token", char_ngrams("_w", lo, hi).alias("g")).collect()}


def test_char_ngrams_edge_words(spark):
    got = _grams(spark, EDGE)
    for w in EDGE:
        assert got[w] == py_ngrams(w), repr(w)
    assert got["a"] == ["<a>"]
    assert got["aaaa"].count("aaa") == 2  # repeats are kept


def test_char_ngrams_other_lengths(spark):
    got = _grams(spark, ["hello"], 1, 2)
    assert got["hello"] == py_ngrams("hello", 1, 2)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=12), min_size=1,
                max_size=8))
def test_char_ngrams_property(spark, words):
    got = _grams(spark, list(dict.fromkeys(words)))
    for w in set(words):
        assert got[w] == py_ngrams(w)


def test_token_vectors_brute_force(spark):
    vocab = {"hello": [1.0, 0.0], "help": [0.0, 1.0], "world": [2.0, 2.0]}
    words = spark.createDataFrame([(k, v) for k, v in vocab.items()], "token string, vec array<double>")
    tokens = spark.createDataFrame([(t,) for t in ["hello", "helping", "zzz", "worldly", "help"]],
                                   "token string")
    grams = FT.fit_subword_vectors(words)
    got = {r["token"]: r["vec"] for r in FT.token_vectors(tokens, words, grams).collect()}

    # brute force: n-gram vector = mean over (word, occurrence); unseen token =
    # mean over its n-gram occurrences that have a vector
    table = {}
    for w, v in vocab.items():
        for g in py_ngrams(w):
            table.setdefault(g, []).append(v)
    gvec = {g: np.mean(vs, axis=0) for g, vs in table.items()}
    for t in ["helping", "worldly"]:
        hits = [gvec[g] for g in py_ngrams(t) if g in gvec]
        assert np.allclose(got[t], np.mean(hits, axis=0)), t
    assert "zzz" not in got  # no known n-gram: no vector
    assert got["hello"] == [1.0, 0.0] and got["help"] == [0.0, 1.0]


def test_mean_vectors_with_subwords(spark):
    vocab = {"hello": [1.0, 0.0], "world": [0.0, 3.0]}
    words = spark.createDataFrame([(k, v) for k, v in vocab.items()], "token string, vec array<double>")
    docs = spark.createDataFrame([(1, "hello worldly"), (2, "qqq"), (3, "hello hello qqq")],
                                 "doc_id long, text string")
    toks = docs.select(F.explode(F.split("text", " ")).alias("token"))
    tv = FT.token_vectors(toks, words, FT.fit_subword_vectors(words))
    mv = {r["doc_id"]: r["vector"] for r in FT.mean_vectors(docs, "doc_id", F.split("text", " "), tv, 2).collect()}
    worldly = [0.0, 3.0]  # every known n-gram of "worldly" comes from "world"
    assert np.allclose(mv[1], [(1.0 + worldly[0]) / 2, (0.0 + worldly[1]) / 2])
    assert mv[2] == [0.0, 0.0]
    assert np.allclose(mv[3], [1.0, 0.0]) and not any(math.isnan(x) for x in mv[3])


def test_encode_brute_force(spark):
    vocab = {"a": 2, "b": 3, "c": 4}
    v = spark.createDataFrame(list(vocab.items()), "token string, id long")
    texts = {1: "a b zz c", 2: "", 3: "c c c c c c c", 4: "zz", 5: "b"}
    df = spark.createDataFrame(list(texts.items()), "rid long, text string")
    tokens = F.filter(F.split("text", " "), lambda t: t != "")
    got = {r["rid"]: (r["input_ids"], r["attention_mask"])
           for r in FT.encode(df, ["rid"], tokens, v, max_length=5).collect()}
    enc = {k: [vocab.get(t, FT.UNK_ID) for t in s.split()][:5] for k, s in texts.items()}
    width = min(5, max(len(x) for x in enc.values()))
    for k, ids in enc.items():
        pad = width - len(ids)
        assert got[k] == (ids + [FT.PAD_ID] * pad, [1] * len(ids) + [0] * pad), k
