import random
import re
import zlib
from collections import Counter

import pyarrow as pa

from tests.llm.helpers import awkward_docs, docs_frame, empty, write_tables
from utterspark.llm import queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
KIND = "word string, n long"


def brute_counts(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(AZ)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n):
    """{word: (n, n_near, form, form_n, root)} by comparing all pairs."""
    found, form = {}, {}
    for w in n:
        others = [x for x in n if near(w, x)]
        best = min(others, key=lambda x: (-n[x], x.encode()), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
        found[w] = len(others)
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n[w], found[w], form[w], n[form[w]] if form[w] else None, root)
    return out


def table(rows):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


def vocabulary(seed, size):
    """Words close to one another, with ties of count, doubled letters, accents and long chains."""
    r = random.Random(seed)
    words = {"banana": 3125, "bananas": 625, "bananass": 125, "bananasss": 25, "bananassss": 5, "aaaaaa": 10, "aaaaaaa": 50, "ététéé": 7, "etetee": 35,
             "étetee": 7, "x" * 40: 5, "x" * 41: 30, "x" * 42: 30}
    while len(words) < size:
        w = "".join(r.choice("abcné") for _ in range(r.randrange(6, 10)))
        words[w] = r.choice([5, 5, 6, 30, 31, 200, 1000])
    return words


def test_variants_match_all_pairs(spark):
    n = vocabulary(1, 700)
    got = table(spelling.variants(spark.createDataFrame(list(n.items()), KIND).repartition(3)).collect())
    assert got == brute(n)
    assert got["bananassss"][4] == "banana"


def test_pairs_are_found_whatever_the_groups(spark, monkeypatch):
    n = vocabulary(2, 300)
    want = {(a, b) for a in n for b in n if a < b and near(a, b)}
    for groups in ({1: 2, 2: 3}, {1: 4, 2: 8}):
        monkeypatch.setattr(spelling, "GROUPS", groups)
        got = [tuple(sorted((r.a, r.b))) for r in spelling.near_pairs(spark.createDataFrame(list(n.items()), KIND)).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_dimensions_number_repeated_letters():
    row, letter, occurrence, size = spelling.dimensions(pa.array(["banana", "", "é中é"]))
    assert list(zip(row.tolist(), map(chr, letter.tolist()), occurrence.tolist())) == [
        (0, "a", 0), (0, "a", 1), (0, "a", 2), (0, "b", 0), (0, "n", 0), (0, "n", 1), (2, "é", 0), (2, "é", 1), (2, "中", 0)]
    assert size.tolist() == [6, 0, 3]


def test_words_far_beyond_the_counted_dimensions(spark):
    n = {"中文字漢語言": 5, "中文字漢語": 30, "中文字漢語文": 50, "z" * 3000: 5, "z" * 3001: 26, "z" * 1500 + "y" + "z" * 1500: 200}
    assert table(spelling.variants(spark.createDataFrame(list(n.items()), KIND)).collect()) == brute(n)


def fixture():
    r = random.Random(9)
    words = [w for w in vocabulary(3, 60) if len(w) < 20]
    docs = [(r_[0], r_[1]) for r_ in awkward_docs()]
    docs += [(1000 + i, " ".join(r.choice(words).upper() if i % 7 == 0 else r.choice(words) for _ in range(80))) for i in range(80)]
    docs += [(1005, docs[-1][1]), (None, "banana, bananas; ÉTÉTEE short 12 bananaxbanana"), (3000, " ".join(words * 600))]
    return docs


def test_query_matches_brute_force(spark, tmp_dir):
    docs = fixture()
    write_tables(spark, tmp_dir, [(*d, "en", "s") for d in docs])
    out = queries.op13_spelling_variants(spark, tmp_dir)
    assert dict(out.dtypes) == {"word": "string", "n": "bigint", "n_near": "bigint", "form": "string", "form_n": "bigint", "root": "string"}
    rows = out.collect()
    assert table(rows) == brute(brute_counts(docs)) and len(rows) == len(table(rows))


def test_deletions_follow_the_keyed_rule(spark):
    docs = [(i, " ".join(f"wortlang{chr(97 + i % 26)}{chr(97 + j)}" for j in range(26))) for i in range(100)] * 5
    got = {r.word: r.n for r in spelling.word_counts(docs_frame(spark, [(*d, "en", "s") for d in docs])).collect()}
    want = brute_counts(docs)
    assert got == want and any(len(w) < 10 for w in want)


def test_runs_in_portions_and_very_long_runs(spark, monkeypatch):
    docs = fixture() + [(4000 + i, "É" * 5_000 + " a" + "bc" * 40_000 + "ÀÉ") for i in range(6)] + [(5000 + i, "Ã ã·Ã3Ãx€àbcdéf") for i in range(6)]
    got = [{r.word: r.n for r in spelling.word_counts(docs_frame(spark, [(*d, "en", "s") for d in docs]), every=e).collect()} for e in (199, 1 << 31)]
    assert got[0] == brute_counts(docs) and "àbcdéf" in got[1]


def test_empty_tables(spark):
    docs = docs_frame(spark)
    assert spelling.variants(spelling.word_counts(empty(docs))).collect() == []
    lone = spelling.variants(spark.createDataFrame([("lonely", 9)], KIND)).collect()
    assert table(lone) == {"lonely": (9, 0, None, None, "lonely")}


def test_no_pair_is_emitted_by_the_driver(spark):
    plan = spelling.near_pairs(spark.createDataFrame([("banana", 9)], KIND))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
