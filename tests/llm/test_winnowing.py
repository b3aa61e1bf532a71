import hashlib
import random
import re

import numpy as np
import pytest

from tests.llm.helpers import awkward_docs, docs_frame, empty, prose, write_tables
from utterspark.llm import queries, winnowing

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id string, text string, id long, n_words string, prints int, kind int"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(AZ))


def brute(docs, items, window=10):
    """(id, n_words, n_hit, item ids) by comparing every window with every position."""
    wins = set()
    for item_id, text in items:
        w = words(text)
        m = min(len(w), window)
        wins |= {(tuple(w[p:p + m]), item_id) for p in range(len(w) - m + 1) if m}
    by = {}
    for win, item_id in wins:
        by.setdefault(win, set()).add(item_id)
    lens, out = {len(x) for x in by}, []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for m in lens:
            for p in range(len(w) - m + 1):
                found = by.get(tuple(w[p:p + m]))
                if found:
                    hit |= set(range(p, p + m))
                    ids |= found
        out.append((doc_id, len(w), len(hit), tuple(sorted(x for x in ids if x is not None))))
    return sorted(out, key=repr)


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, 1, "n", 2, 3) for i, t in items], ITEMS).repartition(2)


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in df.collect()), key=repr)


def fixture():
    item = prose(1001, 30)
    items = [("a", item), ("b", "Short one here"), ("c", None), ("d", ""), ("e", "?!"), ("f", prose(1002, 9)), ("g", prose(1003, 10)), ("a", item),
             (None, prose(1004, 12)), ("h", "lone"), ("i", "x y " * 12), ("j", item[:120] + " and then " + prose(1005, 11)), ("k", "É中文 ß")]
    w = item.split()
    docs = [(r[0], r[1]) for r in awkward_docs()]
    docs += [(200, prose(7, 40) + " " + " ".join(w[5:15]) + " " + prose(8, 40)), (201, " ".join(w[5:14])), (202, item.upper().replace(" ", ", ")),
             (203, "a short ONE here. lone; lone"), (204, prose(1002, 9)), (205, " ".join(prose(1002, 9).split()[:8])), (206, prose(1003, 10) * 1),
             (207, "pre " + prose(1004, 12)), (208, "x y " * 9 + "z " + "y x " * 5), (209, prose(5, 9000) + " " + " ".join(w[12:27]) + " " + prose(6, 9000)),
             (210, " ".join(w[:12]) + " gap " + " ".join(w[10:])), (211, "é中文 ß É中文 ß"), (212, item), (212, item), (None, item)]
    return docs, items


def test_hits_match_brute_force(spark):
    docs, items = fixture()
    frame = docs_frame(spark, [(*d, "en", "s") for d in docs])
    got = winnowing.contaminated_words(frame, items_frame(spark, items))
    assert rows_of(got) == brute(docs, items)


@pytest.mark.parametrize("window,k", [(10, 1), (10, 10), (6, 4), (1, 1)])
def test_any_window_and_gram(spark, window, k):
    docs, items = fixture()
    frame = docs_frame(spark, [(*d, "en", "s") for d in docs])
    got = winnowing.contaminated_words(frame, items_frame(spark, items), window=window, k=k)
    assert rows_of(got) == brute(docs, items, window)


def test_random_texts_of_few_words(spark):
    r = random.Random(5)
    text = lambda n: " ".join(r.choice("ab") for _ in range(n))
    docs = [(i, text(r.randrange(60))) for i in range(80)]
    items = [(f"i{j}", text(r.choice([3, 10, 11, 14, 20]))) for j in range(12)]
    got = winnowing.contaminated_words(docs_frame(spark, [(*d, "en", "s") for d in docs]), items_frame(spark, items))
    assert rows_of(got) == brute(docs, items)


def test_every_window_keeps_a_fingerprint_on_both_sides():
    rng = np.random.default_rng(4)
    w = rng.integers(0, 3, 4_000).astype(np.uint64)
    h = winnowing.gram_hashes(w, 5, 0)
    kept = winnowing.winnow(h, np.full(len(h), len(h)), 6)
    assert np.all([np.any((kept >= p) & (kept < p + 6)) for p in range(len(h) - 5)])
    assert len(kept) < len(h)


def test_a_passage_that_a_third_of_the_documents_share(spark):
    shared = prose(55, 60)
    docs = [(i, prose(3000 + i, 30) + (" " + shared if i % 3 == 0 else "")) for i in range(300)]
    items = [(f"i{j}", prose(9000 + j, 6) + " " + shared) for j in range(40)]
    got = winnowing.contaminated_words(docs_frame(spark, [(*d, "en", "s") for d in docs]), items_frame(spark, items))
    assert rows_of(got) == brute(docs, items)


def test_without_a_broadcast_the_rows_are_the_same(spark, monkeypatch):
    docs, items = fixture()
    frame = docs_frame(spark, [(*d, "en", "s") for d in docs])
    want = rows_of(winnowing.contaminated_words(frame, items_frame(spark, items)))
    monkeypatch.setattr(winnowing, "bounded_broadcast", lambda df: df)
    assert rows_of(winnowing.contaminated_words(frame, items_frame(spark, items))) == want


def test_empty_tables(spark):
    docs, items = fixture()
    frame = docs_frame(spark, [(*d, "en", "s") for d in docs])
    clean = winnowing.contaminated_words(frame, empty(items_frame(spark, items))).collect()
    assert len(clean) == len(docs) and all(r.n_hit == 0 and r["items"] == [] and r.spans == [] for r in clean)
    assert winnowing.contaminated_words(empty(frame), items_frame(spark, items)).collect() == []


def test_query(spark, tmp_dir):
    docs, items = fixture()
    write_tables(spark, tmp_dir, [(*d, "en", "s") for d in docs], benchmark=items_frame(spark, items))
    got = sorted((tuple(r) for r in queries.op11_winnowing(spark, tmp_dir).collect()), key=repr)
    want = [(i, n, h, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), h > 0) for i, n, h, ids in brute(docs, items)]
    assert got == sorted(want, key=repr)
