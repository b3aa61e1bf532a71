import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

import corpus_pipeline
from tests.llm.helpers import WORDS, awkward_docs, docs_frame, empty, prose, write_tables
from tests.llm.test_near_duplicates import brute, edited
from pyspark.sql import functions as F

from utterspark.llm import mixing, queries, toxicity


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


# --- mixing

def water(sizes):
    """Targets by repeated resharing of what is above the caps."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, left, done = 1.5 * sum(sizes.values()), dict(weight), {}
    while left:
        rest = total - sum(done.values())
        share = {s: rest * w / sum(left.values()) for s, w in left.items()}
        above = [s for s in left if share[s] > 2 * sizes[s]]
        if not above:
            return done | share
        for s in above:
            done[s] = 2.0 * sizes[s]
            del left[s]
    return done


def test_mix(spark):
    rows = awkward_docs() + [(3000 + i, prose(i, 5 + i % 50), "en", f"s{min(i % 9, 3)}") for i in range(400)]
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += words(t)
    want = water(sizes)
    labels = spark.createDataFrame([(3000 + i, i % 2, 0) for i in range(0, 400, 3)] + [(3000, None, 1), (3000, 1, 0)], "doc_id long, quality int, toxic int")
    results = []
    for bucket_rows in (20_000, 7):
        got = mixing.mix(docs_frame(spark, rows), labels, bucket_rows=bucket_rows).collect()
        results.append(Counter((r.doc_id, r.size, r.source, r.taken) for r in got))
        assert len(got) == len(rows)
        taken = defaultdict(int)
        for r in got:
            assert abs(r.target - want[r.source]) < 1e-5 and r.source_size == sizes[r.source]
            assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
            taken[r.source] += r.taken
        largest = {s: max(words(t) for _, t, _, x in rows if x == s) for s in sizes}
        for s in sizes:
            # complete epochs exactly, then the prefix sum nearest to the rest
            assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1
    assert results[0] == results[1]
    assert mixing.mix(empty(docs_frame(spark)), labels).count() == 0


# --- toxicity

BAD = ["scumword", "trashword", "vileness"]


def toxic_docs(n=400):
    r, docs, labels = random.Random(1), [], []
    for i in range(n):
        t = prose(i, 80).split()
        if i % 5 == 0:
            for _ in range(4):
                t[r.randrange(len(t))] = r.choice(BAD) + r.choice(["", "ing", "ed"])
        docs.append((i, " ".join(t), "en", f"s{i % 3}"))
        if i % 4:
            labels.append((i, 1, int(i % 5 == 0)))
    return docs, labels


def test_toxicity(spark, tmp_dir):
    docs, labels = toxic_docs()
    odd = [(9000 + i, t, "en", "s") for i, t in enumerate([None, "", " ", "scumword", prose(4, 20_000)])] + [(None, "x", None, None), docs[5]]
    write_tables(spark, tmp_dir, docs + odd, labels + [(9001, 0, None), (None, 1, 1), (5, 1, 1)])
    got = queries.op10_toxicity(spark, tmp_dir).collect()
    assert len(got) == len(docs) + len(odd)
    for r in got:
        assert 0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 3 == 1)
        if r.doc_id is not None and r.doc_id < 9000:
            assert r.predicted == int(r.doc_id % 5 == 0)
        if r.predicted:
            assert r.evidence and r.evidence[0].toxic == 1
    assert all(r.predicted == (r.doc_id == 9003) for r in got if r.doc_id is not None and r.doc_id >= 9000)


def test_toxicity_searches_all_terms_of_all_texts(spark):
    """Neighbours and cosines are those of a brute force over every term, whether or not it speaks for
    a class, and whether the norms come from the broadcast table or from a join."""
    docs = [(i, prose(i, 30 + i % 20) + f" only{i}word", "en", "s") for i in range(60)]
    docs += [(100, prose(3, 400) + " only10word", "en", "s"), (101, docs[10][1], "en", "s"), (102, None, "en", "s"), (103, "unheard", "en", "s"), docs[7]]
    labels = [(i, int(i % 3 == 0)) for i in range(30)]

    def bag(t):
        w = re.findall(r"[a-z0-9]+", t or "")
        return Counter(x for y in w for x in [y, *(f"{y[:k]}~" for k in (4, 5) if len(y) > k)])

    bags = [(i, bag(t)) for i, t, *_ in docs]
    df = Counter(x for _, b in bags for x in b)

    def vector(b):
        v = {x: (1 + np.log(n)) * (np.log((1 + len(docs)) / (1 + df[x])) + 1) for x, n in b.items()}
        norm = np.sqrt(sum(x * x for x in v.values()))
        return {x: y / norm for x, y in v.items()}

    unit = {i: vector(b) for i, b in bags}
    frame = docs_frame(spark, docs)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    scores = []
    for terms in (toxicity.TABLE_TERMS, 0):
        model = toxicity.fit(frame, lab, table_terms=terms)
        assert (model.frequencies is None) == (terms > 0)
        got = toxicity.predict(frame, model, out="t")
        assert got.columns == [*frame.columns, "t"]
        rows = got.collect()
        assert len(rows) == len(docs)
        for r in rows:
            cos = sorted(((sum(w * unit[e].get(x, 0) for x, w in unit[r.doc_id].items()), -e) for e, _ in labels), reverse=True)
            want = [c for c, _ in cos[:3] if c > 0]
            assert np.allclose([e.cosine for e in r.t.evidence], want, rtol=0, atol=1e-9)
            if r.doc_id < 30 or r.doc_id == 101:
                assert r.t.evidence[0].example_id == r.doc_id % 91
        scores.append(sorted((r.doc_id, round(r.t.score, 9)) for r in rows))
    assert scores[0] == scores[1]


def test_toxicity_without_both_classes(spark):
    df = docs_frame(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(df, none).base == 0.0
    m = toxicity.fit(df, spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int"))
    assert {r.t.score for r in toxicity.predict(df, m, out="t").select("t").collect()} == {1.0}
    assert toxicity.predict(empty(df), m).count() == 0


def test_block_max_search_is_exact():
    r = np.random.default_rng(2)
    n, terms = 700, 60
    dense = np.where(r.random((n, terms)) < 0.15, r.random((n, terms)), 0.0)
    dense /= np.maximum(np.linalg.norm(dense, axis=1), 1e-12)[:, None]
    dense[5] = dense[6]
    rows = [np.flatnonzero(x) for x in dense]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    index = toxicity.BlockMaxIndex(starts, np.concatenate(rows), np.concatenate([dense[i][x] for i, x in enumerate(rows)]), np.arange(n) * 3, np.arange(n) % 2, terms)
    for q in range(0, n, 13):
        if len(rows[q]) == 0:
            continue
        places, cos = index.nearest(rows[q], dense[q][rows[q]], 10, skip=int(index.place[q]))
        s = dense @ dense[q]
        s[q] = -1
        want = np.lexsort((np.arange(n), -np.round(s, 12)))[:10]
        want = want[s[want] > 0]
        assert index.ids[places].tolist() == (want * 3).tolist()
        assert np.allclose(cos, s[want])


def test_toxic_words_among_many_others_decide(spark):
    """One toxic word in a long text of common and own words: unseen texts are told apart, as the words
    that tell the classes apart weigh more, whether norms come from the broadcast table or from a join."""
    r, docs = random.Random(3), []
    for i in range(300):
        t = prose(i, 300).split() + [f"own{i}x{k}" for k in range(20)]
        if i % 4 == 0:
            t.insert(r.randrange(len(t)), BAD[i // 4 % 3])
        docs.append((i, " ".join(t), "en", "s"))
    frame = docs_frame(spark, docs)
    lab = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    scores = []
    for terms in (toxicity.TABLE_TERMS, 0):
        rows = toxicity.predict(frame, toxicity.fit(frame, lab, table_terms=terms), out="t").collect()
        assert {x.doc_id for x in rows if x.t.score >= 0.7} == {i for i in range(300) if i % 4 == 0}
        scores.append(sorted((x.doc_id, round(x.t.score, 9)) for x in rows))
    assert scores[0] == scores[1]


def test_lists_of_the_other_class_are_left_where_its_bound_is_low(monkeypatch):
    """Vectors of a class lie in terms that the other hardly has: its lists are not read, and the neighbours
    are those of a brute force."""
    monkeypatch.setattr(toxicity, "RANGE", 16)
    monkeypatch.setattr(toxicity, "LONG_LIST", 8)
    monkeypatch.setattr(toxicity, "DENSE_TERMS", 0)
    r = np.random.default_rng(4)
    n, terms = 240, 80
    full = np.where(r.random((n, terms)) < 0.5, r.random((n, terms)), 0.0)
    label = np.arange(n) % 2
    full[label == 1, 0] = 1000.0
    full /= np.linalg.norm(full, axis=1)[:, None]
    rows = [np.flatnonzero(x) for x in full]
    starts = np.append(0, np.cumsum([len(x) for x in rows]))
    index = toxicity.BlockMaxIndex(starts, np.concatenate(rows), np.concatenate([full[i][x] for i, x in enumerate(rows)]), np.arange(n), label, terms)
    merged, calls = index._merged, []
    monkeypatch.setattr(index, "_merged", lambda *a: (calls.append(1), merged(*a))[1])
    index.wide, one = True, 0
    for q in range(n):
        index.asked = 0
        calls.clear()
        places, cos = index.nearest(rows[q], full[q][rows[q]], 10, skip=int(index.place[q]))
        s = full @ full[q]
        s[q] = -1.0
        want = np.lexsort((np.arange(n), -np.round(s, 12)))[:10]
        assert index.ids[places].tolist() == want.tolist() and np.allclose(cos, s[want], atol=1e-12)
        one += len(calls) == 1
        index.wide = True
    assert one == n


def test_examples_that_norms_rule_out_are_not_scored(monkeypatch):
    """Few terms hold most of each vector, as where they tell the classes apart: the long lists of all others are
    looked at for few examples, and the neighbours are those of a brute force, with ties and with vectors
    of no long list, of no other term and of nothing in common."""
    monkeypatch.setattr(toxicity, "RANGE", 16)
    monkeypatch.setattr(toxicity, "LONG_LIST", 8)
    monkeypatch.setattr(toxicity, "DENSE_TERMS", 30)
    r = np.random.default_rng(6)
    n, heavy, light = 800, 30, 300
    full = np.where(r.random((n, heavy + light)) < 0.3, r.random((n, heavy + light)), 0.0)
    full[:, :heavy] *= 20.0
    full[0, heavy:] = 0.0
    full[1, :heavy] = 0.0
    full[2] = full[3]
    full[4] = 0.0
    full = np.hstack([full, np.eye(n)[:, :5] * 3.0])
    full /= np.linalg.norm(full, axis=1)[:, None]
    rows = [np.flatnonzero(x) for x in full]
    starts = np.append(0, np.cumsum([len(x) for x in rows]))
    ids = r.permutation(n).astype(np.int64)
    index = toxicity.BlockMaxIndex(starts, np.concatenate(rows), np.concatenate([full[i][x] for i, x in enumerate(rows)]), ids, np.arange(n) % 2, full.shape[1])
    lists, scored, exact, by_class = [], [], index._exact, index._by_class
    monkeypatch.setattr(index, "_by_class", lambda *a: (lists.append(1), by_class(*a))[1])
    monkeypatch.setattr(index, "_exact", lambda some, *a: (scored.append(len(some)), exact(some, *a))[1])
    for q in range(n):
        for skip in (-1, int(index.place[q])):
            places, cos = index.nearest(rows[q], full[q][rows[q]], 10, skip=skip)
            s = full @ full[q]
            if skip >= 0:
                s[q] = -1.0
            want = np.lexsort((ids, -np.round(s, 12)))[:10]
            want = want[s[want] > 0.0]
            assert index.ids[places].tolist() == ids[want].tolist() and np.allclose(cos, s[want], atol=1e-12)
    assert len(lists) < 0.02 * 2 * n and sum(scored) < 0.1 * 2 * n * n
    places, cos = index.nearest(np.array([full.shape[1] - 1]), np.ones(1), 10)  # one example has it
    assert index.ids[places].tolist() == [ids[4]] and np.allclose(cos, 1.0)


def test_terms_of_null_and_empty():
    t, rows = toxicity.term_rows(pa.array([None, "", "Ab abcdef"]), toxicity.SpanHasher())
    assert rows.tolist() == [2, 2, 2, 2]  # two words, prefixes of 4 and 5 of the longer one
    assert len(set(t.tolist())) == 4


# --- pipeline

def test_pipeline_against_plain_python(spark, tmp_dir):
    docs, labels = toxic_docs()
    for i in range(40):
        docs.append((5000 + i, edited(prose(70_000 + i % 4, 150), i % 3, i), "en", "s0"))
    docs += [(6000, None, "en", "s0"), (6001, "12 34", "en", None), (6002, "", None, "s1"), (1, docs[1][1], "en", "s1")]
    write_tables(spark, tmp_dir, docs, labels)
    d = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "toxicity", "near_duplicates", "mixing", "byte_bpe"]
    rows = [(r.doc_id, r.text) for r in d.collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = d
        path = f"{tmp_dir}/{name}"
        stage(spark, d, tmp_dir).write.parquet(path)
        d = spark.read.parquet(path)
        now = d.collect()
        if name != "byte_bpe":
            assert d.columns == before.columns
        ids = sorted(r.doc_id for r in now)
        if name == "language_id":
            assert ids == sorted(i for i, t in rows if any(c.isalpha() for c in t or ""))
        elif name == "toxicity":
            assert ids == sorted(i for i, _ in rows if not (i < 400 and i % 5 == 0))
        elif name == "near_duplicates":
            # classes by brute force over the stage's own input; repeated ids are one document
            assert ids == sorted({c for _, _, c in brute(rows, 5, 80, 100)})
        elif name == "mixing":
            size = Counter()
            for i, t in rows:
                size[i] = words(t)
            total = sum(size[r.doc_id] for r in now)
            assert set(Counter(ids).values()) <= {1, 2} and abs(total - 1.5 * sum(size.values())) < 400
        else:
            assert ids == sorted(i for i, _ in rows) and all(r.round_trip for r in now)
        rows = [(r.doc_id, r.text) for r in now] if name != "byte_bpe" else rows
    assert corpus_pipeline.run(spark, tmp_dir).count() == len(ids)


def test_language_stage_without_labelled_rows(spark, tmp_dir):
    docs = docs_frame(spark, [(1, "some words", None, "s"), (2, "12 !", None, "s"), (3, None, None, "s"), (4, "é", None, "s"), (5, "", None, "s")])
    out = corpus_pipeline.language_id(spark, docs, tmp_dir)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 4]


def test_near_duplicates_of_clashing_ids(spark, tmp_dir):
    """Each text that has no similar one left stays, also where ids clash; reruns agree."""
    a, b, c = (prose(s, 60) for s in (1, 2, 3))
    rows = [(5, a), (5, b), (3, edited(a, 1, 1)), (4, edited(b, 1, 2)), (9, c), (9, c), (10, c), (None, a), (11, "x"), (11, "y")]
    docs = docs_frame(spark, [(i, t, "en", f"s{k}") for k, (i, t) in enumerate(rows)])
    want = sorted([(3, rows[2][1]), (4, rows[3][1]), (9, c), (None, a), (11, "x"), (11, "y")], key=repr)
    got = [sorted((tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs.repartition(n), tmp_dir).collect()), key=repr) for n in (1, 4)]
    assert sorted(((r[0], r[1]) for r in got[0]), key=repr) == want and got[0] == got[1]


def test_pipeline_of_an_empty_table(spark, tmp_dir):
    write_tables(spark, tmp_dir, [])
    assert os.path.isdir(tmp_dir) and WORDS
    assert corpus_pipeline.run(spark, tmp_dir).count() == 0


def test_mixed_words_equal_the_plan_when_ids_clash(spark, tmp_dir):
    """Rows that share an id, a source and even a size each appear as often as their own row of the plan."""
    docs = [(i % 12 if i % 3 else None, prose(i, 20 + i % 4), "en", f"s{i % 2}") for i in range(90)] + [(1, prose(1, 21), "en", "s1")] * 4 + [(2, None, "en", None)]
    write_tables(spark, tmp_dir, docs, [(i, i % 2, 0) for i in range(6)])
    frame = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    plan = mixing.mix(frame, spark.read.parquet(f"{tmp_dir}/labels.parquet")).collect()
    got = corpus_pipeline.mix_sources(spark, frame, tmp_dir)
    assert got.columns == frame.columns
    rows = got.collect()
    assert len(rows) == sum(r.copies for r in plan)
    assert sum(len((r.text or "").split()) for r in rows) == sum(r.taken for r in plan)
    key = lambda i, s, n: (str(i), str(s), n)
    want = Counter()
    for r in plan:
        want[key(r.doc_id, r.source, r.size)] += r.copies
    assert Counter(key(r.doc_id, r.source, len((r.text or "").split())) for r in rows) == +want


def test_scoring_without_bounds_looks_at_no_cut_and_finds_the_same(monkeypatch):
    import numpy as np

    from utterspark.llm import toxicity as T

    monkeypatch.setattr(T, "RANGE", 16)
    monkeypatch.setattr(T, "LONG_LIST", 8)
    monkeypatch.setattr(T, "DENSE_SHARE", 2)
    rng = np.random.default_rng(5)
    n, terms = 200, 300
    vectors = [np.sort(rng.choice(terms, 40, replace=False, p=np.arange(terms, 0, -1) / np.arange(terms + 1).sum())) for _ in range(n)]
    starts, term = np.append(0, np.cumsum([len(v) for v in vectors])), np.concatenate(vectors)
    weight = rng.random(len(term))
    for i in range(n):
        weight[starts[i]:starts[i + 1]] /= np.sqrt((weight[starts[i]:starts[i + 1]] ** 2).sum())
    ids = rng.permutation(n).astype(np.int64)
    index = T.BlockMaxIndex(starts, term, weight, ids, np.arange(n) % 2, terms)
    full = np.zeros((n, terms))
    full[np.repeat(np.arange(n), np.diff(starts)), term] = weight
    gathered, plain = [], 0
    ragged = T.ragged
    monkeypatch.setattr(T, "ragged", lambda s, size: (gathered.append(int(size.sum())), ragged(s, size))[1])
    for i in range(n):
        gathered.clear()
        t, w = vectors[i], weight[starts[i]:starts[i + 1]]
        places, cosines = index.nearest(t, w, 10)
        exact = full @ full[i]
        best = np.lexsort((ids, -np.round(exact, 12)))[:10]
        assert index.ids[places].tolist() == ids[best].tolist() and np.allclose(cosines, exact[best], atol=1e-12)
        size = np.diff(index.post_of)[t]
        plain += gathered == [size[size < T.LONG_LIST].sum()]
    assert plain > 0.9 * n  # diffuse vectors: short lists are gathered, each once, and no cut is looked at


def test_batches_of_whole_texts_are_bounded_by_bytes(spark):
    import pyarrow as pa

    from utterspark.llm.common import BATCH_BYTES, prepare

    prepare(spark)

    @F.arrow_udf("long")
    def held(texts: pa.Array) -> pa.Array:
        return pa.array([texts.nbytes] * len(texts), pa.int64())

    got = spark.range(0, 3000, 1, 1).select(held(F.repeat(F.lit("x"), 4000)).alias("b")).agg(F.max("b")).first()[0]
    assert got <= BATCH_BYTES + 100_000  # 12 million bytes came at once before
