"""Helpers that the operators of this subpackage share.

Vectorised text work happens on slices of Arrow batches: a slice holds about
``SLICE_BYTES`` of text (one row at least), so the numpy temporaries of a task
stay at a few dozen megabytes however many rows an Arrow batch has.
"""

from __future__ import annotations

import ctypes
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterspark.session import MAX_BROADCAST_BYTES, _row_bytes, ensure_checkpoint_dir, ship_package

SLICE_BYTES = 1 << 19
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder and package on the workers; every operator calls it first.

    Arrow batches end at ``BATCH_BYTES`` unless the session says otherwise: 10,000 whole texts at a time, with
    the columns made of them, are held by each task in the worker and once more in the executor's JVM."""
    ensure_checkpoint_dir(spark)
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    ship_package(spark)


def give_back() -> None:
    """Return to the system what a reused Python worker has freed; a task calls it before it builds
    something large and when it has let go of it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, stem: str = "tmp") -> str:
    """A column name that ``df`` does not have, whatever extra columns came along."""
    return f"_{stem}_{uuid.uuid4().hex[:12]}"


def bounded_broadcast(df: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """Broadcast hint behind a measured size (one partial aggregate, nothing is funnelled
    into one task); beyond it the caller's join shuffles and AQE splits skewed keys."""
    size = df.agg(F.sum(_row_bytes(df)).alias("b")).first()["b"] or 0
    return F.broadcast(df) if size <= min(max_bytes, MAX_BROADCAST_BYTES) else df


def crc_mod(col, n: int):
    """crc32 of the id written as text, modulo n: the contracts' train/held-out rule."""
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift multiply rounds), elementwise on uint64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def utf8(arr: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; nulls count as empty. Offsets start at 0."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr.cast(pa.large_binary()), b"")
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + n + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def row_slices(arr: pa.Array, limit: int = SLICE_BYTES):
    """(start, stop) row ranges of about ``limit`` bytes of ``arr``, one row at least."""
    n = len(arr)
    if n == 0:
        return
    size = np.cumsum(pc.fill_null(pc.binary_length(arr), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 16)
    lo, base = 0, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(size, base + limit, "right")))
        yield lo, hi
        lo, base = hi, int(size[hi - 1])


class SpanHasher:
    """64-bit hashes of arbitrary byte spans of a buffer.

    A span is taken in blocks of eight bytes, each xored into the state and mixed through the
    finaliser (a bijection), so no algebraic relation between spans makes them collide; two different
    spans agree with the chance of a random function, 2**-64. Spans beyond ``LONG`` bytes go to
    xxh3 one by one, of which a buffer holds few.
    """

    LONG = 512

    def __init__(self, fold: np.ndarray | None = None, seed: int = 7):
        self.fold, self.seed = fold, np.uint64(seed)
        self._mask = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

    def load(self, data: np.ndarray) -> None:
        data = data if self.fold is None else self.fold[data]
        self.size = len(data)
        self.bytes = np.concatenate([data, np.zeros(8, np.uint8)])
        self.blocks = np.ndarray((self.size + 1,), "<u8", self.bytes, strides=(1,))

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = (ends - starts).astype(np.int64)
        h = mix64(n.astype(np.uint64) * _M2 + self.seed)
        h ^= self.blocks[starts] & self._mask[np.minimum(n, 8)]
        h = mix64(h)
        more = np.flatnonzero((n > 8) & (n <= self.LONG))
        at, left, g = starts[more], n[more], h[more]
        while len(more):
            at, left = at + 8, left - 8
            g = mix64(g ^ (self.blocks[at] & self._mask[np.minimum(left, 8)]))
            done = left <= 8
            if done.any():
                h[more[done]] = g[done]
                keep = ~done
                more, at, left, g = more[keep], at[keep], left[keep], g[keep]
        for i in np.flatnonzero(n > self.LONG).tolist():
            h[i] = xxhash.xxh3_64_intdigest(self.bytes[starts[i]:ends[i]].data, int(self.seed))
        return h


def word_spans(data: np.ndarray, off: np.ndarray, is_sep: np.ndarray):
    """Maximal runs of non-separator bytes that stay inside a row: (starts, ends, row)."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    w = ~is_sep[data]
    prev, nxt = np.empty(n, bool), np.empty(n, bool)
    prev[0], prev[1:] = False, w[:-1]
    nxt[-1], nxt[:-1] = False, w[1:]
    prev[off[:-1][off[:-1] < n]] = False
    nxt[off[1:][off[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(w & ~prev), np.flatnonzero(w & ~nxt) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every (start, length) run, one after another."""
    total = int(lens.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lens), lens)


def list_binary(data: np.ndarray, off: np.ndarray) -> pa.Array:
    """A binary array from bytes and offsets."""
    off = np.ascontiguousarray(off, np.int64)
    buffers = [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data, np.uint8))]
    return pa.Array.from_buffers(pa.large_binary(), len(off) - 1, buffers).cast(pa.binary())


WORD_SPACE = np.zeros(256, bool)
WORD_SPACE[[0x20, *range(0x09, 0x0E)]] = True
FOLD_AZ = np.arange(256, dtype=np.uint8)
FOLD_AZ[65:91] += 32
