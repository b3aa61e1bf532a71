import time
import html as html_lib

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import empty
from utterspark.llm import cross_polytope as X
from utterspark.llm import host_paths as H
from utterspark.llm import queries, revisits


# --- nearest neighbours

def brute(rows, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in ok:
        if i % 20 == 0:
            best = {}
            for j, w in ok:
                if j != i and len(w) == len(v):
                    best[j] = max(best.get(j, -np.inf), sum(a * b for a, b in zip(v, w)))
            out[i] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def vectors(n=700, dim=16, seed=1, spread=False):
    r = np.random.default_rng(seed)
    v = r.normal(size=(n, dim))
    v /= np.linalg.norm(v, axis=1)[:, None]
    if spread:
        v *= r.uniform(0.2, 3.0, n)[:, None]
    return [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(v)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1.0, "x") for i, v in rows], "vec_id long, embedding array<float>, score double, tile string").repartition(3)


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: [(v, s) for _, v, s in sorted(x)] for q, x in out.items()}


def test_all_axes_probed_is_exact(spark):
    """With every axis probed the search is the brute force, ties and bad vectors included."""
    for spread in (False, True):
        rows = vectors(spread=spread)
        rows += [(1000 + i, rows[40][1]) for i in range(60)]  # copies: ties go to the smaller id
        rows += [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16), (2060, [None] * 16), (2080, [1.0, 2.0]), (2100, [float("inf")] * 16), (None, rows[3][1])]
        rows += [rows[60]]
        got = found(X.search(frame(spark, rows), F.col("vec_id") % 20 == 0, 20, least=10**9, tile_rows=50, query_rows=16))
        want = brute([r for r in rows if r[0] is None or r[1] is None or len(r[1]) == 16], 20)
        assert got.keys() == want.keys()
        for q in want:
            assert [v for v, _ in got[q]] == [v for v, _ in want[q]]
            assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-12)


def test_repeated_rows_take_no_places(spark):
    """Every row many times, and two vectors per id: a tile that holds all still returns k ids."""
    rows = vectors(120) + [(i, [-x for x in v]) for i, v in vectors(120, seed=2)]
    want = brute(rows, 20)
    for least, copies in ((10**9, 2), (10**9, 25), (60, 25)):
        got = found(X.search(frame(spark, rows * copies), F.col("vec_id") % 20 == 0, 20, least=least, count=16))
        assert got.keys() == want.keys() and all(len({v for v, _ in got[q]}) == 20 for q in got)
        if least > 60:  # a repeated query id keeps the best scores of its vectors
            one = {q: sorted({(-max(sum(a * b for a, b in zip(x, y)) for i, x in rows if i == q for k, y in rows if k == j), j) for j in range(120) if j != q})[:20] for q in got}
            assert all([v for v, _ in got[q]] == [j for _, j in one[q]] for q in got)


def test_recall_with_production_parameters(spark):
    rows = vectors(9_000, 64, 3)
    got = found(X.search(frame(spark, rows), F.col("vec_id") % 300 == 0, 20))
    v = np.array([x for _, x in rows])
    hits = [len({i for i, _ in got[q]} & set(sorted((j for j in range(len(rows)) if j != q), key=lambda j: -(v[j] @ v[q]))[:20])) for q in got]
    assert len(got) == 30 and np.mean(hits) / 20 >= 0.9


def test_few_rows_and_empty_table(spark):
    got = found(X.search(frame(spark, vectors(5)), F.col("vec_id") % 20 == 0, 20))
    assert len(got[0]) == 4
    assert X.search(empty(frame(spark, vectors(5))), F.col("vec_id") % 20 == 0).count() == 0


def test_pseudo_rotation_keeps_inner_products():
    v = np.array([x for _, x in vectors(20)])
    assert np.allclose(X.rotate(v, 1) @ X.rotate(v, 1).T, v @ v.T)


# --- HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head>
<body class="sidebar-left"><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div id="cookie-notice">We use cookies</div><div class="ad">Buy now, buy, buy</div>
<article class="post-%d"><h1>Title &amp; more</h1><p><b>First&nbsp;&lt;b&gt;   line<br>goes on,
here</b><p>Second &#233; para, with <a href=x>a link</a> in it.<aside>related</aside>
<div class="share-buttons">Share</div><form><input><p>Your mail</p></form></article>
<section id="comments"><p>Nice post, really long comment, longer than everything else on this page by far, yes it is. %s</p></section>
<footer>&copy; 2020</footer></body></html>"""


def test_main_text_leaves_furniture_out(spark):
    rows = [(i, "https://a.example/p%d" % i, PAGE % (i, "word " * 300)) for i in range(3)]
    # the host's path wins where a page's own text is mostly elsewhere
    short = "<html><body><article class='post-9'><p>Tiny.</p></article><div class='box'><p>%s</p></div></body></html>" % ("long box text, " * 40)
    rows += [(3, "https://a.example/short", short), (4, None, None), (5, "::bad", ""), (6, "https://b.example/", short), (0, "https://a.example/p0", PAGE % (0, ""))]
    df = spark.createDataFrame([(*r, "h", "p") for r in rows], "page_id long, url string, html string, host string, path string")
    got = sorted((r.page_id, r.text) for r in H.main_text(df, out="text").collect())
    want = "Title & more\n\nFirst <b> line goes on, here\n\nSecond é para, with a link in it."
    assert [t for i, t in got if i in (0, 1, 2)] == [want] * 4
    assert got[4][1] == "Tiny." and got[5][1] == got[6][1] == ""
    assert H.main_text(empty(df)).count() == 0


def test_only_the_hidden_attribute_hides():
    for attrs in ('style="overflow:hidden"', 'aria-hidden="false"', 'title="the hidden truth"', "data-hidden", 'title="a role=search id=ad"', "data-role=search"):
        assert H.extract(f"<div {attrs}><p>kept</p></div>", None) == "kept", attrs
    for attrs in ("hidden", "HIDDEN", 'class="x" hidden=""', "hidden id=a", 'title="a" role=search', "id='ad'"):
        assert H.extract(f"<div {attrs}><p>gone</p></div><p>kept</p>", None) == "kept", attrs


ARTICLE = "".join(f"<p>Sentence number {i} of an article, with enough words to be its text.</p>" for i in range(12))
BODY = "\n\n".join(f"Sentence number {i} of an article, with enough words to be its text." for i in range(12))


def test_wrappers_with_furniture_words_keep_their_article():
    for tag in ('article class="post comments-open"', 'article class="type-post related"', 'div class="content with-sidebar"', 'div class="layout has-sidebar"',
                'div id="main-form"', 'div class="page no-header"', 'div class="site-header-wrap header"', 'section class="search-result widget"'):
        page = f"<body><nav><a href=/>Home</a></nav><p>Crumb</p><{tag}>{ARTICLE}<div class=comments><p>Me too</p></div></{tag.split()[0]}><footer>f</footer>"
        assert H.extract(page, None).replace("Crumb\n\n", "") == BODY, tag
    inner = f"<div class=modal><div class=sidebar><h1>T</h1>{ARTICLE}</div><div class=ad><p>Buy</p></div></div>"
    assert H.extract(inner, None) == f"T\n\n{BODY}"


def test_furniture_that_outweighs_the_article_still_goes():
    for tag in ('section id="comments"', 'div class="comment-list"', 'div class="cookie-notice"', 'div class="advert"', "aside", "nav"):
        assert H.extract(f"<body><article><p>A short piece, that is all.</p></article><{tag}>{ARTICLE * 3}</{tag.split()[0]}>", None) == "A short piece, that is all.", tag
    links = "".join(f"<li><a href=/{i}>A headline that leads elsewhere {i}</a></li>" for i in range(40))
    assert H.extract(f"<body><article><p>A short piece.</p></article><div class=sidebar><ul>{links}</ul></div>", None) == "A short piece."


def test_stray_end_tags_cost_no_search():
    began = time.perf_counter()
    assert H.extract("<div>" * 20_000 + "</p></section>" * 20_000 + "x", None) == "x"
    assert time.perf_counter() - began < 5


def test_votes_are_sent_in_portions(spark, monkeypatch):
    import pyarrow as pa
    pages = [f"<section class=c{'abcdefghij'[i]}x><p>{'word ' * 30}</p></section>" for i in range(10)]
    batch = pa.RecordBatch.from_pydict({"host": ["h"] * 10, "html": pages})

    def sums(parts):
        out = {}
        for r in (r for b in parts for r in b.to_pylist()):
            out[r["path"]] = out.get(r["path"], 0) + r["votes"]
        return out

    whole = sums(H._vote_task([batch]))
    monkeypatch.setattr(H, "VOTES_HELD", 3)
    parts = list(H._vote_task([batch]))
    assert len(parts) > 3 and sums(parts) == whole


def test_all_paths_of_a_page_vote(spark):
    page = "".join(f"<section class={c}><p>{'word ' * (20 + i)}</p></section>" for i, c in enumerate("abcdefgh"))
    pages = spark.createDataFrame([("h", page)], "host string, html string")
    got = pages.mapInArrow(H._vote_task, "host string, path string, votes long").collect()
    assert {f"section.{c}" for c in "abcdefgh"} <= {r.path for r in got}
    assert abs(sum(r.votes for r in got) - 10**6) < 10


def test_broken_and_deep_pages():
    assert H.extract("<article><p>a<p>b<div>c</article><p>d", ">x") == "a\n\nb\n\nc"
    assert H.extract("plain &lt;text&gt; only <b", None) == "plain <text> only"
    assert H.extract("<div>" * 5000 + "<p>deep</p>", None) == "deep"
    assert H.extract("<p>x<!-- unclosed <p>y", None) == "x"
    assert H.extract("<article><p>one</p><script>never closed <p>z", None) == "one"


def test_registered_page_query(spark, tmp_dir):
    spark.createDataFrame([(1, "http://h/x", "<body><article><p>%s</p></article></body>" % html_lib.escape("a <b> & c"))], "page_id long, url string, html string").write.parquet(f"{tmp_dir}/pages.parquet")
    assert [tuple(r) for r in queries.op8_host_paths(spark, tmp_dir).collect()] == [(1, "http://h/x", "a <b> & c", 9)]


# --- revisits

REC = "record_id long, url string, ts long, kind string, status int, etag string, last_modified string, digest string, headers map<string,string>, period long"


def test_revisits_match_brute_force(spark):
    rng = np.random.default_rng(4)
    urls = ["http://A.example/x?b=2&a=1", "https://www.a.example:443/x/?a=1&b=2&utm_source=f#top", "http://b.example/", "http://b.example#z", None, "HTTP://hot.example/p"]
    rows = []
    for i in range(400):
        kind = ["response", "revisit"][int(rng.integers(2))]
        pick = lambda *x: x[int(rng.integers(len(x)))]
        rows.append((i, pick(*urls, *[urls[-1]] * 6), pick(None, *[int(rng.integers(0, 400_000)) for _ in range(9)]), kind, pick(200, 200, 200, 404) if kind == "response" else 304,
                     pick(None, '"e1"', 'W/"e1"', '"e2"'), pick(None, "m1", "m2"), pick(None, "d1", "d2"),
                     pick(None, {"ETag": "x", "Content-Length": str(i), "Date": f"t{i}"}, {"date": f"u{i}", "X-A": None, "content-encoding": "gzip"})))
    df = spark.createDataFrame([(*r, 1) for r in rows], REC)
    key = {r.record_id: r.k for r in df.select("record_id", revisits.canonical_url(F.col("url")).alias("k")).collect()}
    assert key[next(r[0] for r in rows if r[1] == urls[0])] == key[next(r[0] for r in rows if r[1] == urls[1])] == "a.example/x?a=1&b=2"
    want = []
    for r in rows:
        if r[3] != "revisit":
            continue
        old = [s for s in rows if s[3] == "response" and s[4] == 200 and key[s[0]] is not None and key[s[0]] == key[r[0]] and r[2] is not None and s[2] is not None and s[2] < r[2]]
        if not old:
            want.append((r[0], None, "no_earlier_response", None))
            continue
        s = max(old, key=lambda x: (x[2], x[0]))
        strip = lambda t: t.removeprefix("W/")
        if r[5] and s[5]:
            ok = strip(r[5]) == strip(s[5])
        elif r[6] and s[6]:
            ok = r[6] == s[6]
        else:
            ok = r[7] == s[7] if r[7] and s[7] else None
        merged = None
        if ok:
            merged = {k.lower(): v for k, v in (s[8] or {}).items()}
            merged |= {k.lower(): v for k, v in (r[8] or {}).items() if k.lower() not in revisits.KEPT_FIELDS}
        want.append((r[0], s[0], "no_validator" if ok is None else "resolved" if ok else "validator_mismatch", merged and sorted(merged.items())))
    for period in (100, 86_400):
        got = [(r.record_id, r.source_id, r.outcome, None if r.headers is None else [(h.key, h.value) for h in r.headers] or None) for r in revisits.resolve(df, period).collect()]
        assert sorted(got, key=repr) == sorted([(a, b, c, d or None) for a, b, c, d in want], key=repr)
    assert revisits.resolve(empty(df)).count() == 0


def test_revisits_of_repeated_and_null_ids(spark):
    url, tag = "http://a.example/x", '"e"'
    response = (1, url, 10, "response", 200, tag, None, "d", {"A": "1"}, 1)
    rows = [response, response, (None, "http://n.example/", 10, "response", 200, tag, None, "n", None, 1),
            (2, url, 20, "revisit", 304, tag, None, None, None, 1), (2, url, 30, "revisit", 304, '"other"', None, None, None, 1),
            (None, url, 40, "revisit", 304, tag, None, None, None, 1), (None, url, 5, "revisit", 304, tag, None, None, None, 1),
            (3, "http://n.example/", 20, "revisit", 304, tag, None, None, None, 1), (2, url, 20, "revisit", 304, tag, None, None, None, 1)]
    got = [(r.record_id, r.source_id, r.outcome, r.payload_digest) for r in revisits.resolve(spark.createDataFrame(rows, REC)).collect()]
    want = [(2, 1, "resolved", "d"), (2, 1, "resolved", "d"), (2, 1, "validator_mismatch", None), (None, 1, "resolved", "d"),
            (None, None, "no_earlier_response", None), (3, None, "resolved", "n")]
    assert sorted(got, key=repr) == sorted(want, key=repr)
