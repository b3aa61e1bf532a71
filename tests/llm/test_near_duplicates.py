import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import awkward_docs, docs_frame, empty, prose
from utterspark.llm import ngram_join as N
from utterspark.llm.components import connected_components


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset([tuple(w)] if 0 < len(w) < k else (tuple(w[i:i + k]) for i in range(len(w) - k + 1)))


def brute(rows, k=4, num=85, den=100):
    sets = [(i, shingles(t, k)) for i, t, *_ in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, s in sets:
        for b, t in sets:
            if a is not None and b is not None and s and t and den * len(s & t) >= num * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted(((i, len(s), None if i is None else find(i) if s else i) for i, s in sets), key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def edited(text, n, seed):
    w, r = text.split(), random.Random(seed)
    for _ in range(n):
        w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
    return " ".join(w)


def test_components_match_brute_force(spark):
    rows = awkward_docs()
    for i in range(30):
        base = prose(1000 + i % 5, 120)
        rows.append((200 + i, edited(base, i % 4, i), "en", "s0"))
        rows.append((300 + i, prose(2000 + i, 6 + i), "en", "s0"))
        rows.append((400 + i, edited(prose(2000 + i, 6 + i), 1, i), "en", "s0"))
    df = docs_frame(spark, rows)
    for k, num, den in ((4, 85, 100), (5, 80, 100)):
        assert found(N.jaccard_components(df, words=k, num=num, den=den)) == brute(rows, k, num, den)


def test_large_groups_are_tiled(spark):
    rows = [(i, edited(prose(1, 200), i % 9, i), "en", "s") for i in range(90)]
    whole = found(N.jaccard_components(docs_frame(spark, rows)))
    assert found(N.jaccard_components(docs_frame(spark, rows), tile_shingles=1500)) == whole == brute(rows)


def test_n_links_counts_all_links(spark):
    """Every link counts, copies and repeated rows included, however a group is cut into tiles."""
    rows = [(i, edited(prose(1, 200), i % 9, i % 40), "en", "s") for i in range(60)]
    rows += [(100 + i, prose(2, 30), "en", "s") for i in range(5)] + [rows[3], (None, rows[0][1], "en", "s"), (7, prose(2, 30), "en", "s"), (200, "", "en", "s")]
    sets = [(i, shingles(t, 4)) for i, t, *_ in rows]
    want = sorted(((i, 0 if i is None else sum(100 * len(s & t) >= 85 * len(s | t) for j, t in sets if j is not None and s and t) - bool(s)) for i, s in sets), key=repr)
    for tile in (N.TILE_SHINGLES, 1500):
        got = N.jaccard_components(docs_frame(spark, rows), tile_shingles=tile).collect()
        assert sorted(((r.doc_id, r.n_links) for r in got), key=repr) == want


def test_empty_table(spark):
    assert found(N.jaccard_components(empty(docs_frame(spark)))) == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=80), st.integers(0, 8), st.integers(0, 10**6))
def test_linked_sets_share_a_prefix_key(base, changes, seed):
    """Linked sets of any size share a key whatever the frequencies of their shingles are."""
    r = random.Random(seed)
    a = [f"w{x}" for x in base]
    b = list(a)
    for _ in range(changes):
        at = r.randrange(len(b) + 1)
        b[at:at + r.randrange(2)] = [f"y{r.randrange(50)}"] * r.randrange(2)
    x, y = (shingles(" ".join(t), 1) for t in (a, b))
    for num, den in ((85, 100), (80, 100)):
        if not (x and y and den * len(x & y) >= num * len(x | y)):
            continue
        code = {s: (i, r.randrange(4)) for i, s in enumerate(sorted(x | y))}
        shared = [(k, *code[s]) for k, t in enumerate((x, y)) for s in t if s in x and s in y]
        row, short, rank = (np.array(c) for c in zip(*shared))
        size = np.array([len(x), len(y)])
        keys, rows = N.prefix_keys(row, short.astype(np.uint64), rank.astype(np.uint8), size, size - np.bincount(row, minlength=2), num, den)
        assert set(keys[rows == 0].tolist()) & set(keys[rows == 1].tolist())


def test_chunks_do_not_change_the_result(spark, monkeypatch):
    """Many small chunks, and steps between hashes too wide for 32 bits, give the same components."""
    rows = [(i, edited(prose(i % 7, 40 + i % 7), i % 3, i), "en", "s") for i in range(120)]
    want = brute(rows)
    assert found(N.jaccard_components(docs_frame(spark, rows))) == want
    monkeypatch.setattr(N, "CHUNK_ROWS", 5)
    monkeypatch.setattr(N, "row_slices", lambda arr: ((i, i + 1) for i in range(len(arr))))
    assert found(N.jaccard_components(docs_frame(spark, rows), buckets=3)) == want


def test_tile_links_are_a_spanning_forest():
    sets = [np.sort(np.unique(np.random.default_rng(i % 3).integers(0, 2**63, 50, dtype=np.uint64))) for i in range(12)]
    e = N.link_tile(np.arange(12), sets, np.full(12, -1), 85, 100)
    assert len(e) == 9
    cross = N.link_tile(np.arange(12), sets, np.arange(12) % 2, 85, 100)
    assert all(a % 2 != b % 2 for a, b in cross)


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (102, 101), (5, 5), (None, 3), (200, 100), (50, 50)]
    got = {r.id: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(2, 41)}, 101: 100, 102: 100, 200: 100}
