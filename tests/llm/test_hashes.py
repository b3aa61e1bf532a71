"""Texts that a polynomial hash modulo 2**64 cannot tell apart, through the operators that hash spans."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tests.llm.helpers import docs_frame
from utterspark.llm import bpe, ngram_join, queries, toxicity
from utterspark.llm.common import SpanHasher

RANKS = bpe.read_ranks(queries.vocabulary_path())
TIK = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def thue_morse(n, letters="ab"):
    return "".join(letters[bin(i).count("1") & 1] for i in range(n))


@pytest.mark.parametrize("n", [256, 1024, 2048, 4096])
def test_thue_morse_words_have_different_hashes(n):
    data = np.frombuffer((thue_morse(n) + thue_morse(n, "ba")).encode(), np.uint8)
    h = SpanHasher()
    h.load(data)
    a, b = h.spans(np.array([0, n]), np.array([n, 2 * n]))
    assert a != b


def test_equal_spans_agree_wherever_they_lie():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 30_000).astype(np.uint8)
    starts = np.sort(rng.integers(0, 29_000, 5_000))
    ends = starts + rng.integers(0, 900, 5_000)
    h = SpanHasher()
    h.load(data)
    got, seen, raw = h.spans(starts, ends), {}, data.tobytes()
    for a, b, x in zip(starts.tolist(), ends.tolist(), got.tolist()):
        assert seen.setdefault(raw[a:b], x) == x
    assert len(set(seen.values())) == len(seen)


def test_codec_keeps_thue_morse_texts_apart():
    texts = [thue_morse(n, x) for n in (1024, 2048, 4096) for x in ("ab", "ba")]
    c = bpe.Codec(RANKS)
    ids, n = c.encode(pa.array(texts))
    ends = np.cumsum(n)
    assert [ids[a:b].tolist() for a, b in zip(ends - n, ends)] == [TIK.encode_ordinary(t) for t in texts]


class _Weak(SpanHasher):
    """Six bits under the first two seeds, so pre-tokens collide within a slice and with the memo."""

    def spans(self, starts, ends):
        x = super().spans(starts, ends)
        return x & np.uint64(63) if int(self.seed) < 9 else x


def test_codec_compares_bytes_when_hashes_collide(monkeypatch):
    monkeypatch.setattr(bpe, "SpanHasher", _Weak)
    c = bpe.Codec(RANKS)
    for texts in (["one"], ["two three"], [" ".join(f"word{i} x{i * 7}" for i in range(300)), "", None]):
        ids, n = c.encode(pa.array(texts, pa.string()))
        ends = np.cumsum(n)
        assert [ids[a:b].tolist() for a, b in zip(ends - n, ends)] == [TIK.encode_ordinary(t or "") for t in texts]
    assert int(c.spans.seed) == 9


def test_near_duplicates_do_not_link_thue_morse_texts(spark):
    rows = [(i, f"{thue_morse(2048, x)} same words follow here", "en", "s") for i, x in enumerate(("ab", "ba"))]
    rows += [(2, thue_morse(1024), "en", "s"), (3, thue_morse(1024, "ba"), "en", "s")]
    out = ngram_join.jaccard_components(docs_frame(spark, rows))
    assert {r.doc_id: r.component_id for r in out.collect()} == {0: 0, 1: 1, 2: 2, 3: 3}


def test_terms_of_toxicity_keep_thue_morse_words_apart():
    t, row = toxicity.term_rows(pa.array([thue_morse(1024), thue_morse(1024, "ba")]), SpanHasher())
    whole = t[:2]
    assert row[:2].tolist() == [0, 1] and whole[0] != whole[1]
