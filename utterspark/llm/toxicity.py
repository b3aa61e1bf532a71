"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are lower-cased words and the first 4 and 5 bytes of longer words, as 48-bit hashes (the prefixes
catch inflected and compounded forms). A vector has every term of the whole text: none is selected, and
the norm is over all of them. Document frequencies are counted over all documents; a term of no or one
document counts as in one. Examples are a hash sample of at most ``MAX_EXAMPLES`` labelled rows per
class, one per distinct text; they are the classifier, everything else covers all rows. Words that make a
text toxic are few among hundreds, so a term weighs more the more it tells the classes apart: its weight is
multiplied by 1 + its G-squared among the examples beyond ``CHANCE``. No term weighs less than its TF-IDF.

The terms of the examples are broadcast with the index. The frequencies of the other terms, which count
only in norms, are broadcast up to ``TABLE_TERMS`` terms of two or more documents; beyond that a join in
Spark gives every text its norm, with the same results. Both tables are packed in tasks, in blocks of a
hash range; the driver passes the blocks on and never unpacks them.

Index: of the terms that many examples have, those with most of the weight are a dense block that is multiplied
for many queries at once; the lists of few postings are read whole. Both enter every cosine exactly. What the other,
long lists can add to an example is bounded by the product of the norms over their terms (Cauchy-Schwarz)
and, where that leaves many, by block maxima: examples lie in ranges of ``RANGE`` neighbours, a long list is cut
by range, each cut keeps its largest weight, and the sum of query weight x largest weight bounds the range. The
examples whose bound reaches the k-th best cosine found are scored exactly, from their own postings. Where very
many do, the lists of a whole class are scored at once, and those of the other class only if a bound over it reaches the k-th best. The ``K`` nearest vote with their squared cosine against a constant mass for "nothing
like it"; a logistic curve fitted on the examples' own leave-one-out votes turns the vote into a
probability at the labelled base rate. The nearest examples are returned as evidence.

The examples' term counts (``MAX_EXAMPLE_BYTES`` of texts a class at most) are broadcast packed, once; a worker
builds the index from them. Leave-one-out votes are a job over the examples; scoring is a projection.

Defined results: a text without a term of an example, a null or an empty text has no neighbours, vote 0
and the curve's value there; ties of cosine go to the smaller example id; a document labelled twice counts
as toxic if any label says so; without labelled rows of both classes every score is the share of toxic
labels (0 without any).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from utterspark.llm.common import SpanHasher, give_back, mix64, prepare, ragged, row_slices, unused, utf8, word_spans
from utterspark.session import shuffle_partitions

MAX_EXAMPLES = 5_000
MAX_EXAMPLE_BYTES = 64 << 20  # of texts a class; later examples in hash order are left out
BLOCK_SHIFT = 41  # 128 blocks of the 48-bit term hashes
TABLE_TERMS = 8 << 20
PREFIXES = (4, 5)
K, RANGE, NOTHING = 10, 512, 1.0
DENSE_TERMS, DENSE_SHARE = 512, 64  # at most so many terms, each in one of so many examples at least
CHANCE = 10.83  # G-squared that one term in a thousand exceeds if it tells nothing
LONG_LIST, LONG_SHARE = 32, 32  # postings of a long list: so many and those of one in so many examples
FIRST = 32  # examples scored for a floor under the k-th best
FEW_SHARE = 16  # one in so many examples is scored one by one, more by whole lists
TRY_BOUNDS, OFTEN_WIDE = 64, 8  # where bounds often leave more, one query of so many looks at them
BUILT = 1 << 20
ROUNDING = 1e-9  # more than sums of products of unit vectors can differ by their order
QUERIES = 64  # searched together
EVIDENCE = 3

_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def term_rows(arr: pa.Array, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """(term hash, row) of every term occurrence."""
    data, off = utf8(pc.utf8_lower(arr.cast(pa.large_string())))
    starts, ends, row = word_spans(data, off, _SEPARATOR)
    hasher.load(data)
    terms, rows = [], []
    for k in (0, *PREFIXES):
        if k:
            long = ends - starts > k
            starts, ends, row = starts[long], ends[long], row[long]
        terms.append(mix64(hasher.spans(starts, starts + k if k else ends) + np.uint64(k)) >> np.uint64(16))
        rows.append(row)
    return np.concatenate(terms), np.concatenate(rows)


def term_counts(arr: pa.Array, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, term hash, count) of a slice, by row and hash."""
    t, r = term_rows(arr, hasher)
    key = np.sort((r.astype(np.uint64) << np.uint64(48)) | t)  # a slice has less than 2**16 rows
    first = np.flatnonzero(np.diff(key, prepend=~key[:1]))
    n = np.diff(np.append(first, len(key)))
    key = key[first]
    return (key >> np.uint64(48)).astype(np.int64), key & np.uint64((1 << 48) - 1), n


def _frequency_task(batches):
    """(term, documents that have it) summed over some millions of terms at a time; term -1 has the rows."""
    give_back()
    hasher, parts, held, rows = SpanHasher(), [], 0, 0

    def sums():
        u, at = np.unique(np.concatenate([x for x, _ in parts]), return_inverse=True)
        return u, np.bincount(at, np.concatenate([n for _, n in parts]), len(u)).astype(np.int64)

    def out(u, n):
        for lo in range(0, len(u), 1 << 18):
            yield pa.RecordBatch.from_pydict({"term": pa.array(u[lo:lo + (1 << 18)].astype(np.int64)), "n": pa.array(n[lo:lo + (1 << 18)])})

    for b in batches:
        for lo, hi in row_slices(b.column("text")):
            _, t, _ = term_counts(b.column("text").slice(lo, hi - lo), hasher)
            parts.append(np.unique(t, return_counts=True))
            held, rows = held + len(parts[-1][0]), rows + hi - lo
            if held > 1 << 21:
                u, n = sums()
                parts, held = [(u, n)], len(u)
                if held > 1 << 20:
                    yield from out(u, n)
                    parts, held = [], 0
    if parts:
        yield from out(*sums())
    yield pa.RecordBatch.from_pydict({"term": pa.array([-1], pa.int64()), "n": pa.array([rows], pa.int64())})


def _pack_block(t: pa.Table) -> pa.Table:
    """The terms of a hash range in order, as steps, their numbers of documents, whether an example has them,
    and the factors of those that have one."""
    t = t.sort_by("term")
    term = t.column("term").to_numpy().view(np.uint64)
    n = t.column("n").to_numpy()
    step = np.diff(term, prepend=np.uint64(0))
    lift = t.column("lift").to_numpy()
    raised = np.flatnonzero(lift > 1.0)
    kinds = [np.uint32 if len(x) == 0 or x.max() < 1 << 32 else np.uint64 for x in (step[1:], n)]
    return pa.table({"block": t.column("block")[:1], "first": pa.array(term[:1].view(np.int64)), "step": pa.array([step[1:].astype(kinds[0]).tobytes()], pa.binary()),
                     "n": pa.array([n.astype(kinds[1]).tobytes()], pa.binary()), "own": pa.array([np.packbits(t.column("own").to_numpy(zero_copy_only=False)).tobytes()], pa.binary()),
                     "size": pa.array([len(term)], pa.int64()), "raised": pa.array([raised.astype(np.int32).tobytes()], pa.binary()), "lift": pa.array([lift[raised].tobytes()], pa.binary())})


class Vocabulary:
    """Terms in hash order with their idf and place among the terms of the examples (-1: of none); the idf of
    an example's term is multiplied by its factor. What is sent are the packed blocks; a worker unpacks them
    when it first needs them."""

    def __init__(self, blocks: list, documents: int):
        self.blocks, self.documents, self.hasher = sorted(blocks), documents, None

    def __getstate__(self):
        return {"blocks": self.blocks, "documents": self.documents, "hasher": None}

    def _unpack(self):
        total, wide = sum(b[5] for b in self.blocks), any(len(b[3]) > 4 * b[5] for b in self.blocks)
        self.terms, self.n, own = np.empty(total, np.uint64), np.empty(total, np.uint64 if wide else np.uint32), np.empty(total, bool)
        at, raised, lift = 0, [], []
        for _, first, step, count, mine, size, up, factor in self.blocks:
            step = np.frombuffer(step, np.uint32 if len(step) == 4 * (size - 1) else np.uint64)
            here = self.terms[at:at + size]
            here[0] = 0
            np.cumsum(step, dtype=np.uint64, out=here[1:])
            here += np.uint64(first)
            self.n[at:at + size] = np.frombuffer(count, np.uint32 if len(count) == 4 * size else np.uint64)
            own[at:at + size] = np.unpackbits(np.frombuffer(mine, np.uint8), count=size).astype(bool)
            raised.append(np.frombuffer(up, np.int32).astype(np.int64) + at)
            lift.append(np.frombuffer(factor))
            at += size
        self.blocks = None  # unpacked in workers only, which send it nowhere
        self.rare = self.idf_of(1)
        self.place = np.full(total, -1, np.int32)
        self.place[own] = np.arange(own.sum(), dtype=np.int32)
        self.own_idf = self.idf_of(self.n[own])
        self.own_idf[self.place[np.concatenate(raised)]] *= np.concatenate(lift)
        self.hasher = SpanHasher()

    def idf_of(self, n):
        return np.log((1.0 + self.documents) / (1.0 + n)) + 1.0

    def example_idf(self) -> np.ndarray:
        if self.hasher is None:
            self._unpack()
        return self.own_idf

    def vectors(self, arr: pa.Array, square: np.ndarray | None = None):
        """(row starts, places of example terms, their weights in unit vectors, their counts, squared
        norms) of the rows of a slice; ``square`` has squared norms that were computed elsewhere."""
        if self.hasher is None:
            self._unpack()
        row, t, n = term_counts(arr, self.hasher)
        at = np.minimum(np.searchsorted(self.terms, t), len(self.terms) - 1)
        known = self.terms[at] == t
        place = np.where(known, self.place[at], -1)
        hit = place >= 0
        idf = np.where(known, self.idf_of(self.n[at]), self.rare)
        idf[hit] = self.own_idf[place[hit]]
        w = (1.0 + np.log(n)) * idf
        if square is None:
            square = np.bincount(row, w * w, len(arr))
        row, place, w, n = row[hit], place[hit].astype(np.int64), w[hit], n[hit]
        return np.searchsorted(row, np.arange(len(arr) + 1)), place, w / np.sqrt(square[row]), n, square


class BlockMaxIndex:
    """Postings by term, long lists also by example and, cut by range of neighbouring examples, with the largest
    weight of each cut. The frequent terms of most weight are columns of a dense block instead."""

    def __init__(self, starts: np.ndarray, term: np.ndarray, weight, ids: np.ndarray, label: np.ndarray, n_terms: int):
        """``weight`` gives the weights of a slice or of numbers of postings (an array does); lists are
        built for ``BUILT`` postings at a time."""
        weight = weight if callable(weight) else weight.__getitem__
        n = len(ids)
        lead = np.full(n, -1, np.int64)
        for i in range(n):
            if starts[i + 1] > starts[i]:
                lead[i] = term[starts[i] + weight(slice(starts[i], starts[i + 1])).argmax()]
        order = np.lexsort((ids, lead, label))  # alike examples lie together, so bounds are tight
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        self.ids, self.label, self.place = ids[order], label[order], place
        owner = np.repeat(place.astype(np.min_scalar_type(n)), np.diff(starts))
        per_term = np.bincount(term, minlength=n_terms)
        mass = np.zeros(n_terms)
        for a in range(0, len(term), BUILT):
            mass += np.bincount(term[a:a + BUILT], weight(slice(a, a + BUILT)) ** 2, n_terms)
        often = np.flatnonzero(per_term * DENSE_SHARE >= n)
        often = often[np.argsort(-mass[often], kind="stable")[:DENSE_TERMS]]
        self.column = np.full(n_terms, -1, np.int32)
        self.column[often] = np.arange(len(often))
        self.dense = np.zeros((n, len(often)))
        upto = np.append(0, np.cumsum(per_term))
        per_term[often] = 0
        self.post_of = np.append(0, np.cumsum(per_term))
        self.doc, self.weight = np.empty(self.post_of[-1], np.uint16 if n <= 1 << 16 else np.int32), np.empty(self.post_of[-1])
        a = 0
        while a < n_terms:
            b = max(a + 1, int(np.searchsorted(upto, upto[a] + BUILT, "right")) - 1)
            some = np.flatnonzero((term >= a) & (term < b))
            t, d, w = term[some], owner[some], weight(some)
            at = self.column[t]
            self.dense[d[at >= 0], at[at >= 0]] = w[at >= 0]
            rare = np.flatnonzero(at < 0)
            rare = rare[np.lexsort((d[rare], t[rare]))]
            self.doc[self.post_of[a]:self.post_of[b]], self.weight[self.post_of[a]:self.post_of[b]] = d[rare], w[rare]
            a = b
        is_long = per_term >= max(LONG_LIST, n // LONG_SHARE)
        long = np.flatnonzero(is_long)
        self.long_at = np.full(n_terms, -1, np.int32)
        self.long_at[long] = np.arange(len(long))
        self.n_ranges = -(-n // RANGE)
        rng = self.doc // RANGE
        cut = np.zeros(len(rng), bool)
        cut[1:] = (rng[1:] != rng[:-1]) & np.repeat(is_long, per_term)[1:]
        cut[self.post_of[:-1][per_term > 0]] = True
        begin = np.flatnonzero(cut)
        largest = np.maximum.reduceat(self.weight, begin) if len(begin) else np.zeros(0)
        mine = np.repeat(is_long, np.diff(np.searchsorted(begin, self.post_of)))
        self.begin, self.largest = begin[mine], largest[mine]
        self.range = rng[self.begin]
        self.cuts_of = np.searchsorted(self.begin, self.post_of)
        # the places of a class are neighbours, so its part of a list is a run
        edge = int(np.searchsorted(self.label, 1))
        self.sections = [(lo, hi) for lo, hi in ((0, edge), (edge, n)) if lo < hi]
        shape = (len(self.sections), len(long))
        self.long_docs, self.long_weights, self.long_size, self.long_most = np.empty(shape, object), np.empty(shape, object), np.zeros(shape, np.int64), np.zeros(shape)
        for i, t in enumerate(long.tolist()):
            a, b = self.post_of[t], self.post_of[t + 1]
            cut = a + int(np.searchsorted(self.doc[a:b], edge))
            for j, (lo, _) in enumerate(self.sections):
                here = slice(a, cut) if lo < edge else slice(cut, b)
                self.long_docs[j, i], self.long_weights[j, i], self.long_size[j, i] = self.doc[here], self.weight[here], here.stop - here.start
                self.long_most[j, i] = self.weight[here].max(initial=0.0)
        # the same postings by example, and the norm of each example over them
        total = int(per_term[long].sum())
        self.own_of, self.own_at, self.own_weight = np.zeros(n + 1, np.int64), np.empty(total, np.min_scalar_type(len(long))), np.empty(total)
        step = max(1, BUILT * n // max(1, len(term)))
        for a in range(0, n, step):
            some = order[a:a + step]
            post = ragged(starts[some], starts[some + 1] - starts[some])
            at = self.long_at[term[post]]
            row = np.repeat(np.arange(len(some)), starts[some + 1] - starts[some])[at >= 0]
            done = self.own_of[a] + np.arange(len(row))
            self.own_at[done], self.own_weight[done] = at[at >= 0], weight(post[at >= 0])
            self.own_of[a + 1:a + 1 + len(some)] = self.own_of[a] + np.cumsum(np.bincount(row, minlength=len(some)))
        self.rest = np.sqrt(np.bincount(np.repeat(np.arange(n), np.diff(self.own_of)), self.own_weight ** 2, n))
        self.query = np.zeros(len(long))
        self.wide, self.asked, self.left = False, 0, 0

    def frequent(self, starts: np.ndarray, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """(queries x examples): what the frequent terms add to every cosine."""
        q = np.zeros((len(starts) - 1, self.dense.shape[1]))
        col = self.column[term]
        hit = col >= 0
        q[np.repeat(np.arange(len(q)), np.diff(starts))[hit], col[hit]] = weight[hit]
        return q @ self.dense.T

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int, skip: int = -1, base: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(places, cosines) of the k nearest examples with a positive cosine, nearest first; ``base`` is
        the query's row of :meth:`frequent`."""
        if base is None:
            base = self.frequent(np.array([0, len(term)]), term, weight)[0]
        rare = self.column[term] < 0
        term, weight = term[rare], weight[rare]
        at = self.long_at[term]
        long, short = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        first = self.post_of[term[short]]
        size = self.post_of[term[short] + 1] - first
        post = ragged(first, size)
        known = np.bincount(self.doc[post], np.repeat(weight[short], size) * self.weight[post], len(self.ids)) + base
        term, at, weight = term[long], at[long], weight[long]
        self.asked += 1
        if not self.wide or self.asked % TRY_BOUNDS == 0:  # else bounds left most examples the last times
            some, floor = self._reaching(term, at, weight, known, skip, k)
            few = len(some) * FEW_SHARE <= len(known) or len(some) <= k
            self.left = max(0, self.left - 1) if few else min(2 * OFTEN_WIDE, self.left + 1)
            self.wide = self.left >= OFTEN_WIDE
            if few:
                s = self._exact(some, at, weight, known)
                best = np.flatnonzero(s >= floor - ROUNDING) if floor > ROUNDING else np.flatnonzero(s > 0.0)
                best = best[self._order(some[best], s[best])[:k]]
                return some[best], s[best]
        return self._by_class(at, weight, known, skip, k)

    def _reaching(self, term: np.ndarray, at: np.ndarray, weight: np.ndarray, known: np.ndarray, skip: int, k: int) -> tuple[np.ndarray, float]:
        """(places of the examples that can be among the k nearest, a cosine that the k-th best reaches)."""
        # what the long lists add is at most the product of both norms over their terms
        bound = known + np.sqrt((weight * weight).sum()) * self.rest
        if skip >= 0:
            known = known.copy()
            known[skip] = bound[skip] = -1.0
        floor = max(0.0, np.partition(known, len(known) - k)[len(known) - k]) if len(known) > k else 0.0
        some = self._above(bound, floor)
        if len(some) > max(k, FIRST):  # the most promising ones tell more of the k-th best
            first = some[np.argpartition(-bound[some], FIRST)[:FIRST]]
            s = self._exact(first, at, weight, known)
            if FIRST > k:
                floor = max(floor, np.partition(s, FIRST - k)[FIRST - k])
            some = some[self._above(bound[some], floor)]
        if len(some) * FEW_SHARE > len(known):  # nor can they add more than the largest weights of the example's range
            lo = self.cuts_of[term]
            count = self.cuts_of[term + 1] - lo
            cut = ragged(lo, count)
            most = np.bincount(self.range[cut], np.repeat(weight, count) * self.largest[cut], self.n_ranges)
            some = some[self._above(known[some] + most[some // RANGE], floor)]
        return some, floor

    @staticmethod
    def _above(bound: np.ndarray, floor: float) -> np.ndarray:
        return np.flatnonzero(bound >= floor - ROUNDING) if floor > ROUNDING else np.flatnonzero(bound > 0.0)

    def _exact(self, some: np.ndarray, at: np.ndarray, weight: np.ndarray, known: np.ndarray) -> np.ndarray:
        """The cosines of some examples, whose postings of long lists lie together."""
        s = known[some]
        lo, hi = self.own_of[some], self.own_of[some + 1]
        full = np.flatnonzero(hi > lo)
        if not len(full) or not len(at):
            return s
        cuts = list(zip(lo[full].tolist(), hi[full].tolist()))
        self.query[at] = weight
        value = self.query[np.concatenate([self.own_at[a:b] for a, b in cuts])]
        self.query[at] = 0.0
        value *= np.concatenate([self.own_weight[a:b] for a, b in cuts])
        s[full] += np.add.reduceat(value, np.append(0, np.cumsum((hi - lo)[full])[:-1]))
        return s

    def _by_class(self, at: np.ndarray, weight: np.ndarray, known: np.ndarray, skip: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`nearest`, with the long lists of a class at once: copied as they lie, so that they don't
        cost a step of Python for every few postings. ``known`` is what all other terms add."""
        # no example of a class can be nearer than its best known part and the largest weights together
        bound = self.long_most[:, at] @ weight + [known[lo:hi].max() for lo, hi in self.sections]
        places, scores, floor = np.zeros(0, np.int64), np.zeros(0), 0.0
        for j in np.argsort(-bound, kind="stable").tolist():
            if bound[j] < floor - ROUNDING:
                break
            lo, hi = self.sections[j]
            s = np.full(len(known), -1.0)
            s[lo:hi] = known[lo:hi]
            if len(at):
                doc = np.concatenate(self.long_docs[j, at].tolist(), dtype=np.int64)
                value = np.concatenate(self.long_weights[j, at].tolist())
                value *= np.repeat(weight, self.long_size[j, at])
                s += np.bincount(doc, value, len(s))
            places, scores, floor = self._merged(places, scores, self._best(s, skip, k, floor), k)
        return places, scores

    def _merged(self, places: np.ndarray, scores: np.ndarray, more: tuple, k: int) -> tuple[np.ndarray, np.ndarray, float]:
        """The k best of two results, and the cosine that others must reach."""
        places, scores = np.concatenate([places, more[0]]), np.concatenate([scores, more[1]])
        best = self._order(places, scores)[:k]
        return places[best], scores[best], scores[best[-1]] if len(best) == k else 0.0

    def _order(self, places: np.ndarray, scores: np.ndarray) -> np.ndarray:
        return np.lexsort((self.ids[places], -np.round(scores, 12)))

    def _best(self, s: np.ndarray, skip: int, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """(places, cosines) of the k best of ``s`` that can reach ``floor``, ties at the end settled by id."""
        if skip >= 0:
            s[skip] = -1.0
        least = floor - ROUNDING
        if len(s) > k:  # only what can be among the k best, ties included
            least = max(least, np.partition(s, len(s) - k)[len(s) - k] - ROUNDING)
        doc = np.flatnonzero(s >= least) if least > 0.0 else np.flatnonzero(s > 0.0)
        best = self._order(doc, s[doc])[:k]
        return doc[best], s[doc[best]]


def _unpacked(row: tuple) -> np.ndarray:
    """The counts of an example's terms: as wide as its largest needs."""
    terms, counts = len(row[1]) // 4, row[2]
    return np.frombuffer(counts, f"<u{len(counts) // terms}" if terms else np.uint8)


class Core:
    """What scoring needs of a fit, sent once: the vocabulary and the examples' places of terms and counts,
    packed a text. A worker builds the index from them when it first needs it."""

    def __init__(self, vocabulary: Vocabulary, rows: list):
        self.vocabulary, self.rows, self.index = vocabulary, sorted(rows), None

    def __getstate__(self):
        return {"vocabulary": self.vocabulary, "rows": self.rows, "index": None}

    def prepare(self) -> "Core":
        if self.index is None:
            give_back()
            size = np.array([len(r[1]) // 4 for r in self.rows], np.int64)
            starts, idf = np.append(0, np.cumsum(size)), self.vocabulary.example_idf()
            term = np.empty(starts[-1], np.int32)
            count = np.empty(starts[-1], np.result_type(np.uint8, *{_unpacked(r).dtype for r in self.rows}))
            for i, r in enumerate(self.rows):
                term[starts[i]:starts[i + 1]], count[starts[i]:starts[i + 1]] = np.frombuffer(r[1], np.int32), _unpacked(r)
            owner = np.repeat(np.arange(len(size), dtype=np.min_scalar_type(len(size))), size)
            norm = np.sqrt(np.array([r[4] for r in self.rows], float))

            # the logarithms of small counts are looked up
            factor = 1.0 + np.log(np.maximum(np.arange(1 << 8 * count.itemsize), 1)) if count.itemsize < 4 else None

            def weight(some):
                n = count[some]
                return (1.0 + np.log(n.astype(np.int64)) if factor is None else factor[n]) * idf[term[some]] / norm[owner[some]]

            ids, label = (np.array([r[c] for r in self.rows], np.int64) for c in (0, 3))
            self.index = BlockMaxIndex(starts, term, weight, ids, label, len(idf))
            del term, count, owner, weight
            give_back()
        return self

    def vector(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of terms and weights of an example."""
        row = self.rows[i]
        term, square = np.frombuffer(row[1], np.int32), row[4]
        return term, (1.0 + np.log(_unpacked(row).astype(np.int64))) * self.vocabulary.example_idf()[term] / np.sqrt(square)

    def votes(self, starts: np.ndarray, term: np.ndarray, weight: np.ndarray, skip: np.ndarray | None = None):
        """(query, places, cosines, vote) of every query with a term of an example."""
        index = self.prepare().index
        for at in range(0, len(starts) - 1, QUERIES):
            s = starts[at:at + QUERIES + 1]
            base = index.frequent(s - s[0], term[s[0]:s[-1]], weight[s[0]:s[-1]])
            for j in np.flatnonzero(np.diff(s)).tolist():
                p, c = index.nearest(term[s[j]:s[j + 1]], weight[s[j]:s[j + 1]], K, -1 if skip is None else int(skip[at + j]), base[j])
                square = c * c
                yield at + j, p, c, float((square * index.label[p]).sum() / (square.sum() + NOTHING))


class Model:
    """A fit: ``core`` is broadcast (None without examples of both classes: every score is ``base``), the
    curve's ``a`` and ``b`` are two numbers."""

    def __init__(self, core, base: float, documents: int = 0, a: float = 0.0, b: float = 0.0, frequencies: DataFrame | None = None):
        self.core, self.base, self.documents, self.a, self.b = core, base, documents, a, b
        self.frequencies = frequencies  # (term, n, lift), where they are too many to be in the vocabulary

    def __getstate__(self):
        return {**self.__dict__, "frequencies": None}

    def probability(self, vote):
        return 1.0 / (1.0 + np.exp(-np.clip(self.a * vote + self.b, -35, 35)))

    def score(self, arr: pa.Array, square: np.ndarray | None = None):
        """Score and evidence (example ids, cosines, labels) of every text of a slice."""
        n = len(arr)
        if self.core is None:
            return np.full(n, self.base), [[] for _ in range(n)]
        core = self.core.value
        starts, term, weight, _, _ = core.vocabulary.vectors(arr, square)
        votes, evidence = np.zeros(n), [[] for _ in range(n)]
        for i, p, c, vote in core.votes(starts, term, weight):
            votes[i] = vote
            evidence[i] = [{"example_id": int(core.index.ids[x]), "cosine": float(y), "toxic": int(core.index.label[x])} for x, y in zip(p[:EVIDENCE], c)]
        return self.probability(votes), evidence


def _calibrate(vote: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic curve y ~ vote by Newton steps with a small ridge."""
    x = np.stack([vote, np.ones_like(vote)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -35, 35)))
        g = x.T @ (weight * (p - y)) + 0.01 * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        step = np.linalg.solve(h, g)
        w = w - step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-9:
            break
    return float(max(w[0], 0.0)), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        max_examples: int = MAX_EXAMPLES, table_terms: int = TABLE_TERMS,
        max_bytes: int = MAX_EXAMPLE_BYTES) -> Model:
    """Fit on ``labels`` (doc_id, toxic); statistics come from all rows of ``docs``."""
    spark = docs.sparkSession
    prepare(spark)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    lab = labels.select("doc_id", "toxic").where("toxic is not null and doc_id is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in lab.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = n.get(0, 0) + n.get(1, 0)
    base = n.get(1, 0) / total if total else 0.0
    if not n.get(0) or not n.get(1):
        return Model(None, base)
    # a share of the hash range that holds about twice the bound goes to the window, which cuts exactly
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    share = F.when(F.col("toxic") == 1, min(1.0, 2.0 * max_examples / n[1])).otherwise(min(1.0, 2.0 * max_examples / n[0]))
    by_hash = Window.partitionBy("toxic").orderBy("place", "doc_id")
    sample = (lab.withColumn("place", place).where(F.col("place") < share * float(1 << 30))
              .withColumn("r", F.row_number().over(by_hash)).where(F.col("r") <= max_examples).drop("r", "place"))
    # at most 2 x max_examples rows of two numbers: a proven bound
    in_order = Window.partitionBy("toxic").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    ex = (d.join(F.broadcast(sample), "doc_id").groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
          .where("text is not null").withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)))
          .withColumn("bytes", F.sum(F.octet_length("text")).over(in_order)).where(F.col("bytes") <= max_bytes).select("text", "doc_id", "toxic").checkpoint(eager=True))
    size = {r["toxic"]: r["n"] for r in ex.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not size.get(0) or not size.get(1):
        return Model(None, base)
    n1, n0 = float(size[1]), float(size[0])
    counts = d.select("text").mapInArrow(_frequency_task, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).checkpoint(eager=True)
    documents = counts.where("term = -1").first()["n"]
    often = counts.where("term >= 0 and n > 1")
    # the examples' terms: bounded by the examples
    own = _lifts(ex, n1, n0).checkpoint(eager=True)
    small = often.count() <= table_terms
    kept = often.join(own, "term", "full" if small else "right")
    kept = kept.select("term", F.coalesce("n", F.lit(1)).alias("n"), F.col("lift").isNotNull().alias("own"), F.coalesce("lift", F.lit(1.0)).alias("lift"), F.shiftright("term", BLOCK_SHIFT).cast("int").alias("block"))
    blocks = _rows(kept.groupBy("block").applyInArrow(_pack_block, "block int, first long, step binary, n binary, own binary, size long, raised binary, lift binary"))
    if not blocks:
        return Model(None, base)
    vocabulary = Vocabulary(blocks, documents)
    model = Model(None, base, documents, frequencies=None if small else often.join(own, "term", "full"))
    ex, square = _with_norms(ex, model)
    shared = spark.sparkContext.broadcast(vocabulary)
    packed = ex.select("doc_id", "toxic", "text", square.alias("square")).mapInArrow(_vector_task(shared, small), "doc_id long, terms binary, counts binary, toxic int, square double")
    rows = _rows(packed)
    shared.destroy()
    model.core = spark.sparkContext.broadcast(Core(vocabulary, rows))
    # each example's vote among the others, by tasks
    tasks = max(1, min(shuffle_partitions(spark), len(rows) // QUERIES))
    votes = spark.range(0, len(rows), 1, tasks).mapInArrow(_left_out_task(model.core), "vote double, toxic double").toPandas()
    # classes are sampled at different rates: weigh them back to the labelled shares
    y = votes["toxic"].to_numpy()
    model.a, model.b = _calibrate(votes["vote"].to_numpy(), y, np.where(y == 1, n[1] / n1, n[0] / n0))
    return model


def _lifts(ex: DataFrame, n1: float, n0: float) -> DataFrame:
    """(term, lift) of the examples' terms: 1 + what their G-squared over the classes has beyond ``CHANCE``."""
    found = [ex.where(F.col("toxic") == c).select("text").mapInArrow(_frequency_task, "term long, n long").where("term >= 0")
             .select("term", *[(F.col("n") if c == x else F.lit(0)).cast("double").alias(f"n{x}") for x in (1, 0)]) for c in (1, 0)]
    both = found[0].unionByName(found[1]).groupBy("term").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))

    def xlogx(x):
        return F.when(x > 0, x * F.log(x)).otherwise(0.0)

    a, b, total = F.col("n1"), F.col("n0"), F.lit(n1 + n0)
    cells = xlogx(a) + xlogx(b) + xlogx(F.lit(n1) - a) + xlogx(F.lit(n0) - b) + xlogx(total)
    sides = xlogx(a + b) + xlogx(total - a - b) + xlogx(F.lit(n1)) + xlogx(F.lit(n0))
    return both.select("term", (F.lit(1.0) + F.greatest(F.lit(0.0), 2.0 * (cells - sides) - CHANCE)).alias("lift"))


def _rows(df: DataFrame) -> list[tuple]:
    """The rows of a table of bounded size."""
    return list(zip(*[c.to_pylist() for c in df.toArrow().columns]))


def _left_out_task(shared):
    """The vote of the other examples on each example, and its label."""
    def run(batches):
        core = shared.value.prepare()
        for b in batches:
            numbers = b.column("id").to_numpy()
            if not len(numbers):
                continue
            vectors = [core.vector(i) for i in numbers.tolist()]
            starts = np.append(0, np.cumsum([len(t) for t, _ in vectors]))
            votes = np.zeros(len(numbers))
            for i, _, _, vote in core.votes(starts, np.concatenate([t for t, _ in vectors]), np.concatenate([w for _, w in vectors]), core.index.place[numbers]):
                votes[i] = vote
            yield pa.RecordBatch.from_pydict({"vote": pa.array(votes), "toxic": pa.array([float(core.rows[i][3]) for i in numbers.tolist()])})
    return run


def _norm_task():
    """(key, weight without idf, term) of every distinct term of a text; a row without term per text."""
    def run(batches):
        hasher = SpanHasher()
        for b in batches:
            for lo, hi in row_slices(b.column("text")):
                row, t, n = term_counts(b.column("text").slice(lo, hi - lo), hasher)
                key = b.column("key").slice(lo, hi - lo)
                yield pa.RecordBatch.from_pydict({"key": key.take(pa.array(row)), "term": pa.array(t.astype(np.int64)), "w": pa.array(1.0 + np.log(n))})
                yield pa.RecordBatch.from_pydict({"key": key, "term": pa.nulls(hi - lo, pa.int64()), "w": pa.nulls(hi - lo, pa.float64())})
    return run


def _with_norms(df: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, Column]:
    """``df`` and the column of squared norms of its texts: null where the vocabulary gives them, else
    joined by a digest of the text. Copies of a text add up alike and are divided out."""
    if model.frequencies is None:
        return df, F.lit(None).cast("double")
    key, square = unused(df, "key"), unused(df, "square")
    digest = F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"), 256)
    terms = df.select(digest.alias("key"), F.col(text_col).cast("string").alias("text")).mapInArrow(_norm_task(), "key string, term long, w double")
    idf = (F.log(F.lit(1.0 + model.documents) / (F.lit(1.0) + F.coalesce("n", F.lit(1)))) + 1.0) * F.coalesce("lift", F.lit(1.0))
    norms = (terms.join(model.frequencies, "term", "left").groupBy("key")
             .agg((F.sum((F.col("w") * idf) ** 2) / F.count(F.when(F.col("term").isNull(), 1))).alias(square))
             .withColumnRenamed("key", key))
    return df.join(norms, digest == F.col(key), "left").drop(key), F.col(square)


def _vector_task(shared, own_norms: bool):
    def run(batches):
        v = shared.value
        for b in batches:
            for lo, hi in row_slices(b.column("text")):
                x = b.slice(lo, hi - lo)
                s, term, _, n, square = v.vectors(x.column("text"), None if own_norms else x.column("square").to_numpy(zero_copy_only=False))
                cuts = list(zip(s[:-1].tolist(), s[1:].tolist()))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": x.column("doc_id").cast(pa.int64()),
                    "terms": pa.array([term[p:q].astype(np.int32).tobytes() for p, q in cuts], pa.binary()),
                    "counts": pa.array([n[p:q].astype(np.min_scalar_type(int(n[p:q].max(initial=0)))).tobytes() for p, q in cuts], pa.binary()),
                    "toxic": x.column("toxic").cast(pa.int32()), "square": pa.array(square)})
    return run


def predict(df: DataFrame, model: Model, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """``df`` with a struct column ``out``: score and evidence (nearest examples); all columns stay."""
    spark = df.sparkSession
    prepare(spark)
    kind = pa.list_(pa.struct([("example_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))

    own_norms = model.frequencies is None
    m = Model(model.core, model.base, model.documents, model.a, model.b)

    @F.arrow_udf("struct<score:double,evidence:array<struct<example_id:bigint,cosine:double,toxic:int>>>")
    def tag(texts: pa.Array, square: pa.Array) -> pa.Array:
        score, evidence = np.zeros(len(texts)), []
        norms = None if own_norms else square.to_numpy(zero_copy_only=False)
        for lo, hi in row_slices(texts):
            score[lo:hi], e = m.score(texts.slice(lo, hi - lo), None if own_norms else norms[lo:hi])
            evidence += e
        return pa.StructArray.from_arrays([pa.array(score), pa.array(evidence, kind)], ["score", "evidence"])

    x, norm = _with_norms(df, model, text_col)
    x = x.withColumn(out, tag(F.col(text_col).cast("string"), norm))
    return x if own_norms else x.drop(norm)
