import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import awkward_docs, docs_frame, empty, prose, write_tables
from utterspark.llm import bpe, langid, order_minhash, queries, token_spans

RANKS = bpe.read_ranks(queries.vocabulary_path())
CODEC = bpe.Codec(RANKS)
TIK = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


# --- byte-level BPE

def test_perfect_hash_is_minimal_and_perfect():
    assert sorted(CODEC.hash.slot_key.tolist()) == list(range(len(RANKS)))
    tokens = CODEC.tokens[::97]
    assert (CODEC.hash.lookup(tokens) == np.arange(0, len(RANKS), 97)).all()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("ab 's'trevlmd\n\t\r1é-\xa0中٣²\U0001F600 "), max_size=40), st.text(max_size=30)), max_size=6))
def test_encoding_and_decoding_match_the_library(texts):
    texts = [t if t is None or t.isprintable() or all(ord(c) < 0xD800 or ord(c) > 0xDFFF for c in t) else "x" for t in texts]
    ids, n = CODEC.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(n)
    for t, a, b in zip(texts, ends - n, ends):
        assert ids[a:b].tolist() == TIK.encode_ordinary(t or "")
    data, off = CODEC.decode(ids, n)
    assert [data[a:b].tobytes().decode() for a, b in zip(off[:-1], off[1:])] == [t or "" for t in texts]


def test_bpe_query(spark, tmp_dir):
    write_tables(spark, tmp_dir)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op6_byte_bpe(spark, tmp_dir).collect())
    want = []
    for i, t, *_ in awkward_docs():
        ids = TIK.encode_ordinary(t or "")
        want.append((-1 if i is None else i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)


# --- language ID

def test_prediction_is_the_maximum_of_the_whole_posterior():
    """Two close letter distributions and a prior against the rare one: long texts still decide."""
    rng = np.random.default_rng(8)
    letters = np.array(list("abcdef"))
    common, rare = np.array([20, 18, 17, 16, 15, 14.0]), np.array([14, 15, 16, 17, 18, 20.0])

    def text(p, words=400):
        return " ".join("".join(rng.choice(letters, 5, p=p / p.sum())) for _ in range(words))

    def buckets(texts):
        return np.bincount(langid.ngram_rows(pa.array(texts))[0], minlength=langid.BUCKETS) + langid.SMOOTHING

    counts = np.stack([buckets([text(p) for _ in range(60)]) for p in (common, rare)])
    model = langid.Model(["common", "rare"], np.log([0.995, 0.005]), np.log(counts / counts.sum(axis=1, keepdims=True)))
    texts = [text(rare) for _ in range(30)] + [text(common) for _ in range(30)]
    best, score = model.predict(pa.array(texts))
    full = []
    for t in texts:
        b = langid.ngram_rows(pa.array([t]))[0]
        full.append(int(np.argmax([lp[b].sum() + prior for lp, prior in zip(model.logp, model.prior)])))
    assert best.tolist() == full and sum(best[:30] == 1) >= 28 and sum(best[30:] == 0) >= 28
    assert np.all((score >= 0) & (score <= 1))


def test_language_id(spark, tmp_dir):
    rows = awkward_docs() + [(1000 + i, " ".join(["der", "die", "und"][(i + j) % 3] for j in range(30)), "de", "s") for i in range(40)]
    rows += [(2000 + i, " ".join(["the", "and", "of"][(i + j) % 3] for j in range(30)), "en", "s") for i in range(40)]
    write_tables(spark, tmp_dir, rows)
    got = queries.op3_language_id(spark, tmp_dir).collect()
    assert len(got) == len(rows)
    text = {}
    for i, t, lang, _ in rows:
        text[i] = (t, lang)
    for r in got:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 4 == 2)
        assert 0.0 <= r.score <= 1.0
        t = text[r.doc_id][0]
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in t or ""))
        if r.doc_id is not None and r.doc_id >= 1000:
            assert r.lang_pred == text[r.doc_id][1]


def test_language_id_without_training_rows(spark):
    df = docs_frame(spark)
    model = langid.fit(empty(df))
    assert {r.x for r in langid.predict(df, model, out="p").select(F.col("p.lang").alias("x")).collect()} == {"und"}
    assert langid.predict(empty(df), langid.fit(df), out="p").count() == 0


def test_ngrams_match_a_plain_count():
    texts = ["Ab c", None, "", "ÉÉ 中", "1 2"]
    bucket, row, letters = langid.ngram_rows(pa.array(texts))
    assert letters.tolist() == [3, 0, 0, 3, 0]
    want = []
    for t in texts:
        s = "".join(c.lower() if c.isalpha() else " " for c in t or "")
        want.append(sum(any(x != " " for x in s[i:i + k]) for k in (1, 2, 3) for i in range(len(s) - k + 1)))
    assert np.bincount(row, minlength=5).tolist() == want


# --- Order MinHash

def test_fingerprints(spark):
    rows = awkward_docs()
    got = order_minhash.fingerprints(docs_frame(spark, rows)).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    assert len(got) == len(rows)
    want = {}
    for i, r in enumerate(order):
        text, nxt = r[1] or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        want.setdefault((r[0], len(text)), set()).add(hashlib.sha256(edited.encode()).hexdigest())
    prints = {}
    for r in got:
        assert r.edited_sha256 in want[r.doc_id, r.n_chars]
        assert 0.0 <= r.near_edited <= 1.0 and 0.0 <= r.near_next <= 1.0
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(i, set()).add(" ".join((t or "").split()))
    assert all(len(prints[i]) == len(texts[i]) for i in texts)
    assert prints[100] == prints[101] == prints[102] == {""}


def test_signature_is_order_sensitive_and_matches_brute_force(spark):
    """The selection by numbered k-mers, replayed in Python on the signature's own k-mer hashes."""
    texts = {"a": prose(1, 400), "b": prose(1, 400) + " tail", "rep": "x y z " * 50, "short": "one two", "none": ""}
    w = texts["a"].split()
    texts["swapped"] = " ".join(w[200:] + w[:200])
    df = spark.createDataFrame(list(texts.items()), "id string, text string")
    sig = {r.id: r.s for r in order_minhash.with_signature(df, F.col("text"), "s").collect()}
    assert sig["none"] == [] and len(sig["short"]) == 1
    assert len(sig["rep"]) > 40  # repeated k-mers are told apart by their occurrence number

    def like(x, y):
        return len(set(sig[x]) & set(sig[y])) / len({s >> 32 for s in sig[x]} | {s >> 32 for s in sig[y]})

    assert like("a", "b") > 0.9
    # the swapped halves have nearly the same k-mers, but about half of the pairs change order
    assert 0.2 < like("a", "swapped") < 0.8
    one = {r.id: r.s for r in order_minhash.with_signature(df, F.col("text"), "s", size=1).collect()}
    assert len(set(one["a"]) & set(one["swapped"])) / 64 > 0.9


def test_next_document_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(order_minhash, "ROWS_PER_RANGE", 5)
    monkeypatch.setattr(order_minhash, "FAN", 3)
    rows = [(i * i, f"t{i}", "en", "s") for i in range(60)]
    d = docs_frame(spark, rows).select("doc_id", "text")
    got = {r.doc_id: r.next_text for r in order_minhash.with_next(d, ["text"]).collect()}
    assert got == {i * i: f"t{(i - 1) % 60}" for i in range(60)}
    assert order_minhash.fingerprints(empty(docs_frame(spark))).count() == 0


# --- token spans

@pytest.mark.parametrize("rows", [awkward_docs()])
def test_section_tokens_add_up(spark, rows):
    rows = rows + [(500, "a\n\nbb  \n   \nccc ddd\n", "en", "s")]
    shared = bpe.codec(spark, queries.vocabulary_path())
    got = token_spans.section_tokens(docs_frame(spark, rows), shared).collect()
    total = {}
    for r in got:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.n_tokens
    want = {}
    for i, t, *_ in rows:
        want[i] = want.get(i, 0) + len(TIK.encode_ordinary(t or ""))
    assert total == want
    lines = sorted((r.section, r.start, r.end) for r in got if r.doc_id == 500 and r.section is not None)
    assert lines == [(0, 0, 1), (1, 3, 7), (2, 8, 11), (3, 12, 19)]


def test_attribution_matches_brute_force(spark):
    rows = [(1, "héllo wörld 中文 again and again", [(3, 9), (0, 3), (9, 9), (11, 90), (8, 12), None]), (2, None, None), (3, "x", []), (4, "abc", [(None, 2)])]
    df = spark.createDataFrame(rows, "doc_id long, text string, sp array<struct<start:long,end:long>>")
    got = {(r.doc_id, r.section): r.n_tokens for r in token_spans.section_tokens(df, bpe.codec(spark, queries.vocabulary_path()), spans_col="sp").collect()}
    text = rows[0][1]
    spans = [(0, 3), (3, 9), (9, 12), (12, 12), (12, len(text))]
    byte = [(len(text[:a].encode()), len(text[:b].encode())) for a, b in spans]
    want, at = {}, 0
    for t in TIK.encode_ordinary(text):
        n = len(TIK.decode_single_token_bytes(t))
        shared = [min(at + n, b) - max(at, a) for a, b in byte]
        k = max(range(len(spans)), key=lambda i: (shared[i], -i))
        want[k] = want.get(k, 0) + 1
        at += n
    # (8, 12) gives way to the earlier (3, 9); spans that end up empty count nothing
    by_span = [got[1, i] for i in range(5)]
    assert sum(by_span) == sum(want.values()) and got[2, None] == 0 and got[3, None] == len(TIK.encode_ordinary("x")) and got[4, None] == len(TIK.encode_ordinary("abc"))
    assert by_span[0] == want.get(0, 0) and by_span[1] == want.get(1, 0)
