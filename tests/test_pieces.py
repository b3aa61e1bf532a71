"""Longest-match-first pieces against plain Python over five scripts."""

import base64
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from utterspark.functions.text import tokenize_mixed
from utterspark.operators import pieces as P

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def vocabulary():
    out = {}
    for line in open(PATH, "rb"):
        token, rank = line.split()
        try:
            t = base64.b64decode(token).decode()
        except UnicodeDecodeError:
            continue
        key = (t[1:], False) if t.startswith(" ") else (t, True)
        if key[0]:
            out[key] = min(out.get(key, 1 << 60), int(rank) + 4)
    return out


def plain(word, vocab):
    if not word or len(word) > 100:
        return [1] if word else []
    out, at = [], 0
    while at < len(word):
        for end in range(len(word), at, -1):
            if (word[at:end], at > 0) in vocab:
                out.append(vocab[word[at:end], at > 0])
                at = end
                break
        else:
            return [1]
    return out


VOCAB = vocabulary()
TRIE = P.Trie([k[0] for k in VOCAB], np.array([k[1] for k in VOCAB]), np.array(list(VOCAB.values())))
TEXTS = ["The quick brown foxes were uncharacteristically jumping", "Быстрая коричневая лисица перепрыгнула", "他们正在学习自然语言处理 and deep学习",
         "الثعلب البني السريع يقفز فوق", "तेज भूरी लोमड़ी कूदती है", "Größenordnung ÉTÉ naïveté x²", "γρήγορη καφέ αλεπού", "", None, " \n", "!?", "a" * 101, "a" * 100, "𝒜𝒷𐍈 x" * 3]


def cut(words, trie=TRIE):
    ids, off = trie.cut(pa.array(words, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])]


def test_words_of_five_scripts():
    r = random.Random(3)
    letters = "etaoinshrdluößéñ" + "оеаинтсрвлкмдп" + "的一是不了人我在有他" + "المنتيربوع" + "कखगचजटडतनपमयरलवसहािीे" + "αβγδεζηθλμ" + "0159"
    words = [w for t in TEXTS if t for w in t.split()] + ["".join(r.choice(letters) for _ in range(r.randrange(1, 14))) for _ in range(3_000)]
    assert cut(words) == [plain(w, VOCAB) for w in words]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text("abc中", min_size=1, max_size=4), st.booleans()), max_size=12, unique=True), st.lists(st.text("abcd中", max_size=12), max_size=8))
def test_any_vocabulary(pieces, words):
    vocab = {p: i + 4 for i, p in enumerate(pieces)}
    trie = P.Trie([p[0] for p in pieces], np.array([p[1] for p in pieces], bool), np.arange(4, 4 + len(pieces)))
    assert cut(words, trie) == [plain(w, vocab) for w in words]


@pytest.fixture(scope="module")
def shared(spark):
    return P.piece_trie(P.read_pieces(spark, PATH))


def test_vocabulary_is_read_as_the_file_says(spark):
    got = {(r.piece, r.continues): r.id for r in P.read_pieces(spark, PATH).collect()}
    assert got == VOCAB


def test_encoded_rows(spark, shared):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100, "word " * 300)]
    df = spark.createDataFrame(rows, "i int, text string").repartition(3).withColumn("words", tokenize_mixed("text"))
    words = {r.i: r.words or [] for r in df.collect()}
    for limit in (64, 7, 2):
        got = {r.i: (r.input_ids, r.attention_mask) for r in P.encode_pieces(df, ["i"], F.col("words"), shared, limit).collect()}
        want = {i: [2, *[x for w in ws for x in plain(w, VOCAB)][:limit - 2], 3] for i, ws in words.items()}
        longest = max(map(len, want.values()))
        assert longest == limit
        assert got == {i: (x + [0] * (longest - len(x)), [1] * len(x) + [0] * (longest - len(x))) for i, x in want.items()}


def test_encoding_does_not_shuffle_texts(spark, shared, tmp_dir):
    spark.createDataFrame([(1, "a b")], "i int, text string").write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    plan = df.select("i", P.piece_ids(tokenize_mixed("text"), shared).alias("p"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_piece_counts_and_empty_input(spark, shared):
    df = spark.createDataFrame([("the the 中",), (None,)], "text string")
    want = {VOCAB["the", False]: 2, VOCAB.get(("中", False), 1): 1}
    assert {r.id: r.n for r in P.piece_counts(df, tokenize_mixed("text"), shared).collect()} == want
    assert P.piece_counts(df.limit(0), tokenize_mixed("text"), shared).count() == 0
    assert P.encode_pieces(df.withColumn("i", F.lit(1)).limit(0), ["i"], tokenize_mixed("text"), shared).count() == 0
