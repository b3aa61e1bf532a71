"""Byte-level BPE encoding and decoding by two-tier lookup.

Pre-tokens are the matches of the public tokenizers' pattern, found for a whole slice of texts at
once from character classes. Tier 1: a minimal perfect hash over the vocabulary resolves every pre-token that is itself a token
(one slot per token, no empty slots; the slot's bytes are compared, so a foreign pre-token is never
mistaken). Tier 2: the rest is merged by rank with a heap over doubly linked bytes, O(n log n) for a
pre-token of n bytes. Each distinct pre-token of a task is resolved once (the memo, plain arrays in
order of the hashes, is emptied at ``MEMO`` entries, so memory is bounded); ids are then laid out with one ragged gather per slice.

The vocabulary (a rank file, its path is a parameter) is read on the driver and broadcast; its size
is checked against ``MAX_VOCAB_BYTES``. Encoding and decoding are projections without a shuffle.

Defined results: null and empty texts have no ids; ids come as packed little-endian unsigned 32-bit
integers (binary), decoding returns the exact UTF-8 bytes; no special tokens; whole texts always.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import unicodedata

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterspark.llm.common import SpanHasher, give_back, list_binary, mix64, prepare, ragged, row_slices, utf8

MAX_VOCAB_BYTES = 64 << 20
MEMO = 500_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: a base64 token, a space and its rank a line."""
    with open(path, "rb") as f:
        raw = f.read(MAX_VOCAB_BYTES + 1)
    if len(raw) > MAX_VOCAB_BYTES:
        raise ValueError(f"the rank file is larger than {MAX_VOCAB_BYTES} bytes")
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


class PerfectHash:
    """Hash and displace: a key's bucket holds the displacement that sends all of the bucket's keys
    to free slots; buckets are placed from the largest to the smallest, and buckets of one key get
    a leftover slot outright, so n keys fill exactly n slots."""

    def __init__(self, keys: list[bytes]):
        n = self.n = max(len(keys), 1)
        self.buckets = max(1, n // 3)
        h = self.hashes(keys)
        order = np.argsort(h % np.uint64(self.buckets), kind="stable")
        sizes = np.bincount((h % np.uint64(self.buckets)).astype(np.int64), minlength=self.buckets)
        ends = np.cumsum(sizes)
        self.seed = np.zeros(self.buckets, np.int64)
        self.slot_key = np.full(n, -1, np.int64)
        free = np.ones(n, bool)
        tries = np.arange(256, dtype=np.uint64)
        spare = None
        for b in np.argsort(-sizes, kind="stable"):
            if sizes[b] == 0:
                break
            mine = order[ends[b] - sizes[b]:ends[b]]
            if sizes[b] == 1:
                spare = iter(np.flatnonzero(free)) if spare is None else spare
                slots, self.seed[b] = np.array([next(spare)]), 0
                self.seed[b] = -1 - slots[0]
            else:
                base = 0
                while True:
                    at = self._place(h[mine][:, None], (tries + np.uint64(base))[None, :])
                    ok = free[at].all(axis=0)
                    s = np.sort(at, axis=0)
                    ok &= (s[1:] != s[:-1]).all(axis=0)
                    if ok.any():
                        k = int(ok.argmax())
                        slots, self.seed[b] = at[:, k], base + k
                        break
                    base += 256
            free[slots] = False
            self.slot_key[slots] = mine

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    def _place(self, h: np.ndarray, seed: np.ndarray) -> np.ndarray:
        return (mix64(h + seed * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.n)).astype(np.int64)

    def lookup(self, keys: list[bytes]) -> np.ndarray:
        """Index of the key that owns the slot of each key (to be compared with it)."""
        h = self.hashes(keys)
        seed = self.seed[(h % np.uint64(self.buckets)).astype(np.int64)]
        slot = np.where(seed < 0, -1 - seed, self._place(h, np.maximum(seed, 0).astype(np.uint64)))
        return self.slot_key[slot]


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token: always the lowest-ranked adjacent pair first, leftmost on ties.

    A part is known by its first byte; ``end`` and ``prev`` link the parts. The heap holds
    ``rank << 32 | first byte``; an entry is stale unless ``pair`` still has its rank there."""
    n, get = len(piece), ranks.get
    end, prev, pair, heap = list(range(1, n + 1)), list(range(-1, n - 1)), [-1] * n, []
    for i in range(n - 1):
        r = get(piece[i:i + 2])
        if r is not None:
            pair[i] = r
            heap.append(r << 32 | i)
    heapq.heapify(heap)
    while heap:
        x = heapq.heappop(heap)
        i = x & 0xFFFFFFFF
        if pair[i] != x >> 32:
            continue
        j = end[i]
        e = end[i] = end[j]
        pair[j] = pair[i] = -1
        if e < n:
            prev[e] = i
            r = get(piece[i:end[e]])
            if r is not None:
                pair[i] = r
                heapq.heappush(heap, r << 32 | i)
        p = prev[i]
        if p >= 0:
            r = get(piece[p:e])
            pair[p] = -1 if r is None else r
            if r is not None:
                heapq.heappush(heap, r << 32 | p)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
# fixed values: the code points of the Unicode property White_Space
WHITE_SPACE = (0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def class_table() -> np.ndarray:
    kinds = {"L": _LETTER, "N": _NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(i))[0], _OTHER) for i in range(0x110000)), np.uint8, 0x110000)
    out[list(WHITE_SPACE)] = _SPACE
    return out


def pre_tokens(data: np.ndarray, off: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts of the pattern's matches over all rows, and the number of matches per row.

    The pattern's alternatives are runs of one class (letters, numbers, other) with at most one
    space in front; of white space before something else the last character stands alone unless it
    is that space; an apostrophe that starts a match takes s, t, m, d, re, ve or ll with it. The
    matches cover a row without gaps, so their starts say it all."""
    n = len(off) - 1
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    m = len(cp)
    if m == 0:
        return np.zeros(0, np.int64), np.zeros(n, np.int64)
    first = np.searchsorted(at, off[:-1][np.diff(off) > 0])
    head = np.zeros(m + 1, bool)
    head[first] = True
    head[m] = True
    cls = classes[cp]
    run = head[:m].copy()
    run[1:] |= cls[1:] != cls[:-1]
    white = cls == _SPACE
    after_space = np.zeros(m, bool)
    after_space[1:] = (cp[:-1] == 32) & ~head[1:m]
    start = run & (white | ~after_space)
    last = np.zeros(m, bool)  # the last white space before something else in its row
    last[:-1] = white[:-1] & ~white[1:] & ~head[1:m]
    start |= last
    quote = np.flatnonzero((cp == 39) & start & run)
    if len(quote):
        nxt = [np.where(quote + k < m, cp[np.minimum(quote + k, m - 1)], 0) for k in (1, 2)]
        same = [~head[np.minimum(quote + 1, m)], ~head[np.minimum(quote + 1, m)] & ~head[np.minimum(quote + 2, m)]]
        one = same[0] & np.isin(nxt[0], [ord(c) for c in "stmd"])
        two = same[1] & np.any([(nxt[0] == ord(x)) & (nxt[1] == ord(y)) for x, y in ("re", "ve", "ll")], axis=0)
        for hit, k in ((one, 2), (two & ~one, 3)):
            q = quote[hit]
            start[q + 1] = False
            q = q[(q + k < m)] + k
            q = q[~head[q] & (cls[q] == _LETTER)]
            start[q] = True
    begins = at[np.flatnonzero(start)]
    return begins, np.diff(np.searchsorted(begins, off))


class Codec:
    """Vocabulary, perfect hash and memo of distinct pre-tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = list(ranks)
        self.ids = np.fromiter(ranks.values(), np.int64, len(ranks))
        self.hash = PerfectHash(self.tokens)
        self.classes = class_table()
        self._ready = False

    def __getstate__(self):
        keep = ("ranks", "tokens", "ids", "hash", "classes")
        return {k: self.__dict__[k] for k in keep} | {"_ready": False}

    def _prepare(self) -> None:
        if self._ready:
            return
        give_back()
        self.token_objects = np.array(self.tokens, object)
        top = int(self.ids.max(initial=-1)) + 1
        by_id = [b""] * top
        for t, i in self.ranks.items():
            by_id[i] = t
        self.id_bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.id_len = np.fromiter(map(len, by_id), np.int64, top)
        self.id_start = np.cumsum(self.id_len) - self.id_len
        self.spans = SpanHasher()
        self._ready = True
        self._clear()

    def _reseed(self) -> None:
        """Another hash function and an empty memo: two pre-tokens were found to share a hash."""
        self.spans = SpanHasher(seed=int(self.spans.seed) + 1)
        self._clear()

    def _clear(self) -> None:
        self.known, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # hashes in order, and their places
        self.room = 1 << 12
        self.starts, self.lens = np.zeros(self.room, np.int64), np.zeros(self.room, np.int64)
        self.flat, self.used = np.zeros(self.room, np.uint32), 0
        self.key_starts, self.key_lens = np.zeros(self.room, np.int64), np.zeros(self.room, np.int64)
        self.key_flat, self.key_used = np.zeros(self.room, np.uint8), 0

    def _learn(self, hashes: np.ndarray, keys: list[bytes]) -> None:
        """Resolve distinct pre-tokens, hashes ascending: perfect hash first, heap merge for the misses."""
        owner = self.hash.lookup(keys)
        found = self.token_objects[owner] == np.array(keys, object)
        single = self.ids[owner].tolist()
        ids = [[single[i]] if ok else merge_bytes(keys[i], self.ranks) for i, ok in enumerate(found.tolist())]
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        n, total = len(self.known), int(lens.sum())
        while len(self.starts) < n + len(ids):
            self.starts, self.lens, self.key_starts, self.key_lens = (
                np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lens, self.key_starts, self.key_lens))
        while len(self.flat) < self.used + total:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        joined = np.frombuffer(b"".join(keys), np.uint8)
        while len(self.key_flat) < self.key_used + len(joined):
            self.key_flat = np.concatenate([self.key_flat, np.zeros_like(self.key_flat)])
        self.key_flat[self.key_used:self.key_used + len(joined)] = joined
        sizes = np.fromiter(map(len, keys), np.int64, len(keys))
        self.key_starts[n:n + len(ids)] = self.key_used + np.cumsum(sizes) - sizes
        self.key_lens[n:n + len(ids)] = sizes
        self.key_used += len(joined)
        self.flat[self.used:self.used + total] = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, total)
        self.starts[n:n + len(ids)] = self.used + np.cumsum(lens) - lens
        self.lens[n:n + len(ids)] = lens
        self.used += total
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.entry = np.insert(self.entry, at, np.arange(n, n + len(ids), dtype=np.int32))

    def encode(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, ids per text)."""
        self._prepare()
        data, off = utf8(arr)
        begins, per = pre_tokens(data, off, self.classes)
        if len(begins) == 0:
            return np.zeros(0, np.uint32), per
        ends = np.append(begins[1:], len(data))
        if len(self.known) > MEMO:
            self._clear()
        while (found := self._resolve(data, begins, ends)) is None:
            self._reseed()
        at, inverse = found
        at = at[inverse]
        lens = self.lens[at]
        ids = self.flat[ragged(self.starts[at], lens)]
        sums = np.zeros(len(begins) + 1, np.int64)
        np.cumsum(lens, out=sums[1:])
        stop = np.cumsum(per)
        return ids, sums[stop] - sums[stop - per]

    def _knows(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the hashes have a memo entry."""
        if not len(self.known):
            return np.zeros(len(hashes), bool)
        return self.known[np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)] == hashes

    def _resolve(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray):
        """(memo entry of every distinct pre-token, distinct one of every pre-token), or None if two
        pre-tokens share a hash: the bytes of every pre-token are compared with its memo entry's."""
        self.spans.load(data)
        h, one, inverse = np.unique(self.spans.spans(begins, ends), return_index=True, return_inverse=True)
        size = ends - begins
        first, first_size = begins[one], size[one]
        # the pre-tokens cover the data in order, so the data itself is what their bytes are compared with
        if not np.array_equal(size, first_size[inverse]) or not np.array_equal(data, data[ragged(first[inverse], size)]):
            return None
        fresh = np.flatnonzero(~self._knows(h))
        if len(fresh):
            raw, s, e = data.tobytes(), first.tolist(), ends[one].tolist()
            self._learn(h[fresh], [raw[s[i]:e[i]] for i in fresh.tolist()])
        at = self.entry[np.searchsorted(self.known, h)].astype(np.int64)
        kept = self.key_flat[ragged(self.key_starts[at], self.key_lens[at])]
        if not np.array_equal(first_size, self.key_lens[at]) or not np.array_equal(kept, data[ragged(first, first_size)]):
            return None
        return at, inverse

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all id lists one after another, byte offsets per list)."""
        self._prepare()
        ids = ids.astype(np.int64)
        lens = self.id_len[ids]
        data = self.id_bytes[ragged(self.id_start[ids], lens)]
        sums = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(lens, out=sums[1:])
        return data, sums[np.concatenate([[0], np.cumsum(counts)])]


def codec(spark: SparkSession, path: str):
    """Broadcast codec of a rank file; share it between ``encode`` and ``decode``."""
    prepare(spark)
    return spark.sparkContext.broadcast(Codec(read_ranks(path)))


def encode(df: DataFrame, shared, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with a binary column ``out``: the ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("binary")
    def run(texts: pa.Array) -> pa.Array:
        c, found = shared.value, []
        for lo, hi in row_slices(texts):
            ids, counts = c.encode(texts.slice(lo, hi - lo))
            off = np.concatenate([[0], np.cumsum(counts)]) * 4
            found.append(list_binary(ids.astype("<u4").view(np.uint8), off))
        return pa.concat_arrays(found) if found else pa.array([], pa.binary())

    return df.withColumn(out, run(F.col(text_col).cast("string")))


def decode(df: DataFrame, shared, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with a binary column ``out``: the bytes that the ids of ``ids_col`` stand for."""

    @F.arrow_udf("binary")
    def run(packed: pa.Array) -> pa.Array:
        c, found = shared.value, []
        for lo, hi in row_slices(packed):
            raw, off = utf8(packed.slice(lo, hi - lo))
            found.append(list_binary(*c.decode(np.frombuffer(raw.tobytes(), "<u4"), np.diff(off) // 4)))
        return pa.concat_arrays(found) if found else pa.array([], pa.binary())

    return df.withColumn(out, run(F.col(ids_col)))
