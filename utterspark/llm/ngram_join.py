"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures, exact at the end.

A document's set holds the hashes of its distinct k-word shingles; two documents link when
``den * |A & B| >= num * |A | B|``. Sizes fall into bands such that a set's partners are in its own
band or a neighbouring one.

1. Candidate keys. Shingles are ordered by document frequency, then by hash. Linked sets share a
   shingle within their prefixes, the first ``n - ceil(num * n / den) + 1`` shingles of a set of n.
   Shingles of one set only come first and can't match, so a text with enough shingles of its own
   has no key at all, and passages that many documents share come last: they make no candidates.
   Frequencies are counted in Spark: a task packs its (hash, row) pairs into one sorted block per
   bucket (equal sets of a chunk once); buckets return the pairs seen twice or more to the chunk of
   their rows, which picks the prefixes. A chunk keeps one row per key (others become edges to it at
   once), so a key that a third of all rows share costs a row per chunk.
2. Candidate edges form stars per key; their components are groups beyond which no link exists.
   Groups whose sets are all equal need no work.
3. Tiles. A group of up to ``TILE_SHINGLES`` shingles is one tile; a larger one is cut by size band
   and slot, and tiles are pairs of slots in the same or neighbouring bands. Inside a tile a set has
   a bitmap with one hashed bit per shingle: bits of A missing in B bound ``|A - B|`` from below,
   hence the overlap from above; every survivor's overlap is counted exactly. A tile returns a
   spanning forest and the number of links of each set, never all pairs.
4. Forest edges and equal sets give the components. A pair of sets lies in one tile only, so the sums
   of the tiles' numbers are the numbers of links.

Words are maximal runs without the bytes 0x20, 0x09-0x0D, after A-Z is folded. Defined results: with
fewer than k words the whole sequence is the one shingle; null, empty or blank texts have an empty
set and link with nothing; equal sets link; a repeated doc_id gives a row each and is one node; a
null doc_id has a null component; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from utterspark.llm.common import FOLD_AZ, WORD_SPACE, SpanHasher, bounded_broadcast, give_back, mix64, prepare, ragged, row_slices, utf8, word_spans
from utterspark.llm.components import connected_components
from utterspark.session import shuffle_partitions

WORDS, NUM, DEN = 4, 85, 100
TILE_SHINGLES = 1 << 20
CHUNK_ROWS, CHUNK_SHINGLES = 1 << 16, 1 << 20
BUCKETS_PER_PARTITION = 4  # keeps what a task holds of the pairs at some ten megabytes
_STEP = [np.uint64(x) for x in np.random.default_rng(11).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)]
_SALT = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(arr: pa.Array, words: int, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of every row one after another, set sizes)."""
    data, off = utf8(arr)
    n = len(off) - 1
    starts, ends, row = word_spans(data, off, WORD_SPACE)
    hasher.load(data)
    w = hasher.spans(starts, ends)
    count = np.bincount(row, minlength=n)
    m = max(len(w) - words + 1, 0)
    h = np.zeros(m, np.uint64)
    for j in range(words):
        h += w[j:j + m] * _STEP[j]
    whole = row[:m] == row[words - 1:words - 1 + m] if m else np.zeros(0, bool)
    h, hrow = mix64(h[whole]), row[:m][whole]
    few = np.flatnonzero((count > 0) & (count < words))
    if len(few):
        first = (np.cumsum(count) - count)[few]
        s = count[few].astype(np.uint64) * _SALT
        for j in range(words - 1):
            have = count[few] > j
            s[have] += w[first[have] + j] * _STEP[j]
        h, hrow = np.concatenate([h, mix64(s)]), np.concatenate([hrow, few])
        order = np.argsort(hrow, kind="stable")
        h, hrow = h[order], hrow[order]
    per = np.bincount(hrow, minlength=n)
    stop = np.cumsum(per)
    for a, b in zip((stop - per).tolist(), stop.tolist()):
        if b - a > 1:
            h[a:b].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (hrow[1:] != hrow[:-1])
    return h[keep], np.bincount(hrow[keep], minlength=n)


def set_ids(h: np.ndarray, size: np.ndarray) -> np.ndarray:
    """One 64-bit digest per set; with the size it stands for the set."""
    ends = np.concatenate([[0], np.cumsum(size)])
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(mix64(h + _SALT), out=sums[1:])
    return mix64(sums[ends[1:]] - sums[ends[:-1]] + size.astype(np.uint64))


class Bands:
    """Size bands for a threshold num / den: partners are in the same or a neighbouring band."""

    def __init__(self, num: int, den: int):
        lo, self.lo, hi = 1, [], []
        while lo < 1 << 40:
            self.lo.append(lo)
            hi.append(lo * den // num)
            lo = hi[-1] + 1
        self.lo, self.hi = np.array(self.lo, np.int64), np.array(hi, np.int64)
        self.reach = self.hi * den // num

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lo, size, "right") - 1


def prefix_lengths(size: np.ndarray, num: int, den: int) -> np.ndarray:
    return size - -(-num * size // den) + 1


def prefix_keys(row: np.ndarray, short: np.ndarray, rank: np.ndarray, size: np.ndarray, own: np.ndarray,
                num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) of the prefix shingles that other sets have too. ``row, short, rank`` are those
    shingles with their frequency rank, ``own`` the number of shingles that only the row's set has."""
    bands = Bands(num, den)
    order = np.lexsort((short, rank, row))
    row, short = row[order], short[order]
    at = np.arange(len(row)) - np.searchsorted(row, row)
    keep = at < (prefix_lengths(size, num, den) - own)[row]
    row, short = row[keep], short[keep]
    band = bands.of(np.maximum(size, 1))[row]
    lower = (band > 0) & (size[row] <= bands.reach[np.maximum(band - 1, 0)])
    tag = np.concatenate([band, band[lower] - 1]).astype(np.uint64)
    return mix64(np.concatenate([short, short[lower]]) + mix64(tag + _SALT)), np.concatenate([row, row[lower]])


def stars(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the smallest id of each, and distinct (id, smallest id) edges."""
    order = np.lexsort((ids, keys))
    k, i = keys[order], ids[order]
    first = np.ones(len(k), bool)
    first[1:] = k[1:] != k[:-1]
    head = i[np.flatnonzero(first)][np.cumsum(first) - 1] if len(k) else i
    other = i != head
    edges = np.unique(np.stack([i[other], head[other]], axis=1), axis=0) if other.any() else np.zeros((0, 2), np.int64)
    return k[first], i[first], edges


def _pack(count: int, *arrays: np.ndarray) -> bytes:
    return np.array([count], np.int64).tobytes() + b"".join(x.tobytes() for x in arrays)


def _unpack(block: pa.Scalar, *kinds: type) -> list[np.ndarray]:
    raw = block.as_buffer()
    n, at, out = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for kind in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _blocks(cols: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    to, kind, chunk, block = list(zip(*cols)) or [[], [], [], []]
    return pa.RecordBatch.from_pydict({"to": pa.array(to, pa.int64()), "kind": pa.array(kind, pa.int8()),
                                       "chunk": pa.array(chunk, pa.int64()), "block": pa.array(block, pa.binary())})


_BLOCKS = "to long, kind byte, chunk long, block binary"
_PAIRS, _INFO, _KEYS, _EDGES = range(4)


def _shingle_task(words: int, buckets: int):
    """Chunks of a task's rows: (short hash, row) pairs by bucket, and the rows themselves."""
    def run(batches):
        from pyspark import TaskContext

        hasher = SpanHasher(FOLD_AZ)
        chunk = TaskContext.get().partitionId() << 32
        hs: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        gone: list[np.ndarray] = []
        held = rows = 0

        def flush():
            h, size, doc, null = (np.concatenate(x) for x in (hs, sizes, ids, gone))
            for x in (hs, sizes, ids, gone):
                x.clear()
            digest = set_ids(h, size)
            _, first = np.unique(digest, return_index=True)
            sends = np.zeros(len(size), bool)  # equal sets of a chunk send their shingles once
            sends[first] = True
            sends &= ~null
            row = np.repeat(np.arange(len(size)), size)
            mine = sends[row]
            short, row = h[mine] >> np.uint64(16), row[mine].astype(np.uint16)
            to = short % np.uint64(buckets)
            order = np.argsort(to * np.uint64((1 << 48) // buckets + 1) + short // np.uint64(buckets))
            short, row, to = short[order], row[order], to[order].astype(np.int64)
            cut = np.searchsorted(to, np.arange(buckets + 1))
            out = []
            for b in np.flatnonzero(np.diff(cut)).tolist():
                q = short[cut[b]:cut[b + 1]] // np.uint64(buckets)
                step = np.diff(q, prepend=np.uint64(0))
                wide = step.max() >> np.uint64(32) > 0  # sorted values as 32-bit steps, if they fit
                out.append((b, _PAIRS, -1 - chunk if wide else chunk, _pack(len(q), step if wide else step.astype(np.uint32), row[cut[b]:cut[b + 1]])))
            out.append((chunk % buckets, _INFO, chunk, _pack(len(size), doc, size.astype(np.int64), digest.view(np.int64), null.astype(np.int8), sends.astype(np.int8))))
            return _blocks(out)

        for b in batches:
            doc = b.column("doc_id")
            null = doc.is_null().to_numpy(zero_copy_only=False)
            doc = doc.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi in row_slices(b.column("text")):
                if rows + hi - lo > CHUNK_ROWS or held >= CHUNK_SHINGLES:
                    yield flush()
                    chunk, held, rows = chunk + 1, 0, 0
                h, size = shingle_sets(b.column("text").slice(lo, hi - lo), words, hasher)
                for x, y in zip((hs, sizes, ids, gone), (h, size, doc[lo:hi], null[lo:hi])):
                    x.append(y)
                held, rows = held + len(h), rows + hi - lo
        if rows:
            yield flush()
    return run


def _frequency_task(buckets: int):
    """A bucket's pairs whose shingle two or more sets have, returned to their chunks with the rank of
    the frequency (an eighth of its logarithm); rows of documents pass through."""
    def run(batches):
        give_back()
        short, row, owner, chunks = [], [], [], []
        for b in batches:
            for to, kind, chunk, block in zip(b.column("to").to_pylist(), b.column("kind").to_pylist(), b.column("chunk").to_pylist(), b.column("block")):
                if kind == _INFO:
                    yield _blocks([(chunk, _INFO, chunk, block.as_py())])
                    continue
                step, r = _unpack(block, np.uint64 if chunk < 0 else np.uint32, np.uint16)
                short.append(np.cumsum(step, dtype=np.uint64) * np.uint64(buckets) + np.uint64(to))
                row.append(r.copy())  # not a view that would keep the whole batch
                owner.append(np.full(len(r), len(chunks), np.int32))
                chunks.append(-1 - chunk if chunk < 0 else chunk)
        if not short:
            return
        h, r, o = (np.concatenate(x) for x in (short, row, owner))
        for x in (short, row, owner):
            x.clear()
        order = np.argsort(h)
        h, r, o = h[order], r[order], o[order]
        del order
        first = np.ones(len(h), bool)
        first[1:] = h[1:] != h[:-1]
        begin = np.flatnonzero(first)
        count = np.diff(np.append(begin, len(h)))
        rank = np.repeat(np.minimum(255, 8 * np.log2(count)).astype(np.uint8), count)
        keep = np.repeat(count > 1, count)
        h, r, o, rank = h[keep], r[keep], o[keep], rank[keep]
        order = np.argsort(o, kind="stable")
        cut = np.searchsorted(o[order], np.arange(len(chunks) + 1))
        for i, chunk in enumerate(chunks):
            x = order[cut[i]:cut[i + 1]]
            if len(x):
                yield _blocks([(chunk, _PAIRS, chunk, _pack(len(x), h[x].astype(np.uint32), (h[x] >> np.uint64(32)).astype(np.uint16), r[x], rank[x]))])
    return run


def _prefix_task(num: int, den: int, buckets: int):
    """Candidate keys of the chunks of a task, one row per key of a chunk, and edges between rows
    of a chunk that share one."""
    def run(batches):
        give_back()
        info: dict[int, pa.Scalar] = {}
        pairs: dict[int, list] = {}
        for b in batches:
            for kind, chunk, block in zip(b.column("kind").to_pylist(), b.column("chunk").to_pylist(), b.column("block")):
                if kind == _INFO:
                    info[chunk] = block
                else:
                    pairs.setdefault(chunk, []).append(block)
        for chunk, block in info.items():
            doc, size, digest, null, sends = _unpack(block, np.int64, np.int64, np.int64, np.int8, np.int8)
            found = pairs.pop(chunk, None)
            some = np.flatnonzero((size > 0) & (null == 0))
            keys, rows = [mix64(digest.view(np.uint64)[some] ^ np.uint64(0x55AA))], [some]
            if found:
                lo, hi, row, rank = (np.concatenate(x) for x in zip(*(_unpack(x, np.uint32, np.uint16, np.uint16, np.uint8) for x in found)))
                short, row = lo.astype(np.uint64) + (hi.astype(np.uint64) << np.uint64(32)), row.astype(np.int64)
                own = size - np.bincount(row, minlength=len(size))
                k, r = prefix_keys(row, short, rank, size, own, num, den)
                keys.append(k)
                rows.append(r)
            k, i, edges = stars(np.concatenate(keys), doc[np.concatenate(rows)])
            to = (k % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            cut = np.searchsorted(to[order], np.arange(buckets + 1))
            out = [(b, _KEYS, chunk, _pack(len(x), k[x], i[x])) for b in np.flatnonzero(np.diff(cut)).tolist() for x in [order[cut[b]:cut[b + 1]]]]
            if len(edges):
                out.append((chunk % buckets, _EDGES, chunk, _pack(len(edges), edges[:, 0], edges[:, 1])))
            out.append((chunk % buckets, _INFO, chunk, _pack(len(doc), doc, size, digest, null)))
            yield _blocks(out)
    return run


def _star_task(batches):
    """Edges between documents of one bucket's keys; rows of documents pass through."""
    keys, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]

    def rows(a, b=None, size=None, digest=None):
        none = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_pydict({"a": a if isinstance(a, pa.Array) else pa.array(a), "b": none if b is None else pa.array(b),
                                           "size": none if size is None else pa.array(size), "digest": none if digest is None else pa.array(digest)})

    for batch in batches:
        for kind, block in zip(batch.column("kind").to_pylist(), batch.column("block")):
            if kind == _KEYS:
                k, i = _unpack(block, np.uint64, np.int64)
                keys.append(k)
                ids.append(i)
            elif kind == _EDGES:
                yield rows(*_unpack(block, np.int64, np.int64))
            else:
                doc, size, digest, null = _unpack(block, np.int64, np.int64, np.int64, np.int8)
                yield rows(pa.array(doc, mask=null == 1), None, size, digest)
    _, _, edges = stars(np.concatenate(keys), np.concatenate(ids))
    if len(edges):
        yield rows(edges[:, 0], edges[:, 1])


def _set_task(words: int):
    """Rows (doc_id, size, digest, copies, tiles, text) -> the row with its set, where text still has the set looked for."""
    def run(batches):
        hasher = SpanHasher(FOLD_AZ)
        for b in batches:
            for lo, hi in row_slices(b.column("text")):
                x = b.slice(lo, hi - lo)
                h, size = shingle_sets(x.column("text"), words, hasher)
                same = (set_ids(h, size).view(np.int64) == x.column("digest").to_numpy()) & (size == x.column("size").to_numpy())
                stop = np.cumsum(size)
                at = np.flatnonzero(same)
                sets = [h[stop[i] - size[i]:stop[i]].tobytes() for i in at]
                take = {c: x.column(c).take(pa.array(at)) for c in ("doc_id", "size", "digest", "copies", "tiles")}
                yield pa.RecordBatch.from_pydict({**take, "shingles": pa.array(sets, pa.binary())})
        give_back()
    return run


def bitmaps(sets: list[np.ndarray], bits: int) -> np.ndarray:
    out = np.zeros((len(sets), bits // 64), np.uint64)
    for i, s in enumerate(sets):
        row = np.zeros(bits, np.uint8)
        row[(s & np.uint64(bits - 1)).astype(np.int64)] = 1
        out[i] = np.packbits(row).view(np.uint64)
    return out


def tile_links(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray, copies: np.ndarray, num: int,
               den: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Spanning forest of the links of a tile, and for every set the copies of the sets it links with.
    ``side`` is -1 in a tile whose pairs all count; else only pairs of the two sides do (each side has
    a tile of its own)."""
    size = np.array([len(s) for s in sets], np.int64)
    order = np.lexsort((ids, size))
    ids, size, side, copies, sets = ids[order], size[order], side[order], copies[order], [sets[i] for i in order]
    n = len(ids)
    bits = 64
    while bits < min(int(size.max(initial=1)), 1 << 15):
        bits *= 2
    maps = bitmaps(sets, bits)
    shingles, flat = np.unique(np.concatenate(sets), return_inverse=True) if n else (np.zeros(0), np.zeros(0, np.int64))
    start = np.concatenate([[0], np.cumsum(size)])
    mark = np.zeros(len(shingles), bool)
    root = np.arange(n)
    found: list[tuple[int, int]] = []
    links = np.zeros(n, np.int64)
    begin = np.searchsorted(size * den, size * num)  # partners of a set are at least this large
    for j in range(1, n):
        lo = int(begin[j])
        if lo >= j:
            continue
        old = maps[lo:j]
        a_not_b = np.bitwise_count(old & ~maps[j]).sum(axis=1, dtype=np.int64)
        b_not_a = np.bitwise_count(~old & maps[j]).sum(axis=1, dtype=np.int64)
        most = np.minimum(size[lo:j] - a_not_b, size[j] - b_not_a)
        may = den * most >= num * (size[lo:j] + size[j] - most)
        may &= (side[lo:j] != side[j]) | (side[j] < 0)
        cand = lo + np.flatnonzero(may)
        if not len(cand):
            continue
        mine = flat[start[j]:start[j + 1]]
        mark[mine] = True
        hit = mark[flat[ragged(start[cand], size[cand])]]
        both = np.add.reduceat(hit, np.cumsum(size[cand]) - size[cand], dtype=np.int64)
        mark[mine] = False
        cand = cand[den * both >= num * (size[cand] + size[j] - both)]
        links[j] += copies[cand].sum()
        links[cand] += copies[j]
        while len(cand := cand[root[cand] != root[j]]):
            found.append((int(ids[cand[0]]), int(ids[j])))
            root[root == root[cand[0]]] = root[j]
    out = np.empty(n, np.int64)
    out[order] = links
    return found, out


def link_tile(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Spanning forest of the links of a tile."""
    return tile_links(ids, sets, side, np.ones(len(ids), np.int64), num, den)[0]


def _tile_task(num: int, den: int):
    """Forest edges (a, b), and (size, digest, n) with the links of every set."""
    def run(t: pa.Table) -> pa.Table:
        key = np.stack([t.column("size").to_numpy(), t.column("digest").to_numpy()], axis=1)
        t = t.take(pa.array(np.unique(key, axis=0, return_index=True)[1]))  # repeated rows bring a set again
        ids = t.column("doc_id").to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("shingles").combine_chunks()]
        e, n = tile_links(ids, sets, t.column("side").to_numpy().astype(np.int64), t.column("copies").to_numpy(), num, den)
        some = np.flatnonzero(n)
        none, gap = [None] * len(e), [None] * len(some)
        return pa.table({"a": pa.array([x for x, _ in e] + gap, pa.int64()), "b": pa.array([y for _, y in e] + gap, pa.int64()),
                         **{c: pa.array(none + t.column(c).to_numpy()[some].tolist(), pa.int64()) for c in ("size", "digest")},
                         "n": pa.array(none + n[some].tolist(), pa.int64())})
    return run


def _with_tiles(members: DataFrame, num: int, den: int, tile_shingles: int) -> DataFrame:
    """(doc_id, size, digest, copies, tiles) from (doc_id, size, digest, copies, grp): the tiles a set takes part in."""
    bands = Bands(num, den)
    los = F.array(*[F.lit(int(x)).cast("long") for x in bands.lo if x < 1 << 32])
    m = members.withColumn("band", F.size(F.filter(los, lambda x: x <= F.col("size"))) - 1)
    # group and band totals are sums of numbers, combined before the shuffle
    per = m.groupBy("grp", "band").agg(F.sum("size").alias("in_band"))
    w = Window.partitionBy("grp")
    near = Window.partitionBy("grp").orderBy("band")
    slots = F.ceil(F.col("in_band") / F.lit(tile_shingles / 2.0)).cast("int")
    per = per.withColumn("total", F.sum("in_band").over(w)).withColumn("slots", slots)
    per = per.select(
        "grp", "band", "total", "slots",
        F.when(F.lag("band").over(near) == F.col("band") - 1, F.lag("slots").over(near)).otherwise(0).alias("below"),
        F.when(F.lead("band").over(near) == F.col("band") + 1, F.lead("slots").over(near)).otherwise(0).alias("above"))
    x = m.join(per, ["grp", "band"])
    slot = F.pmod(F.xxhash64("doc_id"), F.col("slots")).cast("int")

    def name(b1, s1, b2, s2):
        return F.concat_ws(":", F.col("grp").cast("string"), b1.cast("string"), s1.cast("string"), b2.cast("string"), s2.cast("string"))

    def pairs(count, build):
        return F.transform(F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>")), build)

    band, s = F.col("band"), F.col("_slot")
    own = pairs(F.col("slots"), lambda o: F.struct(name(band, F.least(s, o), band, F.greatest(s, o)).alias("tile"),
                                                   F.when(o == s, -1).when(s < o, 0).otherwise(1).cast("int").alias("side")))
    up = pairs(F.col("above"), lambda o: F.struct(name(band, s, band + 1, o).alias("tile"), F.lit(0).alias("side")))
    down = pairs(F.col("below"), lambda o: F.struct(name(band - 1, o, band, s).alias("tile"), F.lit(1).alias("side")))
    one = F.array(F.struct(F.col("grp").cast("string").alias("tile"), F.lit(-1).alias("side")))
    tiles = F.when(F.col("total") <= tile_shingles, one).otherwise(F.concat(own, up, down))
    return x.withColumn("_slot", slot).select("doc_id", "size", "digest", "copies", tiles.alias("tiles"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                       num: int = NUM, den: int = DEN, tile_shingles: int = TILE_SHINGLES,
                       buckets: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links), one row per row of ``docs``. ``component_id`` is the
    smallest doc_id that links reach; ``n_links`` is the number of other rows whose texts link with the row's, equal
    ones included; rows with a null doc_id have none and count for none."""
    spark = docs.sparkSession
    prepare(spark)
    n = buckets or max(shuffle_partitions(spark), 1) * BUCKETS_PER_PARTITION
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if "Exchange" in d._jdf.queryExecution().executedPlan().toString():
        d = d.checkpoint(eager=True)  # rows are known by their place in a task: a rerun must see them in the same order
    blocks = d.mapInArrow(_shingle_task(words, n), _BLOCKS).repartition(n, "to").mapInArrow(_frequency_task(n), _BLOCKS)
    keys = blocks.repartition(n, "to").mapInArrow(_prefix_task(num, den, n), _BLOCKS)
    raw = keys.repartition(n, "to").mapInArrow(_star_task, "a long, b long, size long, digest long").checkpoint(eager=True)
    info = raw.where("b is null").select(F.col("a").alias("doc_id"), "size", "digest")
    grp = connected_components(raw.where("b is not null").select("a", "b"))

    # one member per distinct set; groups of one set are settled by equality
    sets = info.where("size > 0 and doc_id is not null").groupBy("size", "digest").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")).checkpoint(eager=True)
    members = sets.join(grp.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("doc_id", "size", "digest", "copies", F.coalesce("root", "doc_id").alias("grp"))
    several = members.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("grp")
    todo = _with_tiles(members.join(several, "grp"), num, den, tile_shingles).checkpoint(eager=True)
    texts = d.join(bounded_broadcast(todo), "doc_id").select("doc_id", "size", "digest", "copies", "tiles", "text")
    sets_in = texts.mapInArrow(_set_task(words), "doc_id long, size long, digest long, copies long, tiles array<struct<tile:string,side:int>>, shingles binary")
    tiles = sets_in.select("doc_id", "size", "digest", "copies", F.explode("tiles").alias("t"), "shingles").select("doc_id", "size", "digest", "copies", "t.tile", "t.side", "shingles")
    linked = tiles.groupBy("tile").applyInArrow(_tile_task(num, den), "a long, b long, size long, digest long, n long").checkpoint(eager=True)
    links = linked.where("a is not null").select("a", "b")

    # nodes are set representatives; a doc_id with several texts ties its sets together
    same = info.where("size > 0 and doc_id is not null").join(sets.withColumnRenamed("doc_id", "rep"), ["size", "digest"]).select("doc_id", "rep")
    twice = info.where("doc_id is not null").groupBy("doc_id").agg(F.countDistinct("size", "digest").alias("k")).where("k > 1").select("doc_id")
    ties = same.join(twice, "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    roots = connected_components(links.unionByName(ties))
    deg = linked.where("n is not null").groupBy("size", "digest").agg(F.sum("n").alias("partners"))
    reps = (sets.withColumnRenamed("doc_id", "rep").join(roots.withColumnRenamed("id", "rep"), "rep", "left").join(deg, ["size", "digest"], "left")
            .select("size", "digest", F.coalesce("root", "rep").alias("root"), (F.col("copies") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links")))
    return info.join(reps, ["size", "digest"], "left").select(
        "doc_id", F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.when(F.col("doc_id").isNotNull(), F.col("root"))).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"))
