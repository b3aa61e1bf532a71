"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables.

A unit vector is rotated by fast pseudo-rotations (random signs, then a Walsh-Hadamard transform,
three times) and hashed to its nearest signed axis: the position and sign of the largest coordinate.
Each of ``TABLES`` tables has its own signs. A vector is stored under its axis in every table; a query
probes the ``PROBES`` signed axes nearest to it, and further ones until their lists hold ``LEAST``
vectors. Vectors that share a probed axis in any table are
candidates and are reranked by the exact inner product in double precision.

Inner products of vectors of any length are searched by the usual reduction: stored vectors are
scaled by the largest norm and get one more coordinate that makes them unit vectors, queries get 0.

Work is dealt as tiles: axes with few vectors are packed together, an axis with more than
``TILE_ROWS`` vectors is cut into slots, queries into blocks of ``QUERY_ROWS``. A tile holds bounded
numbers of vectors and queries and returns at most ``k`` rows per query, so no list of candidate pairs
ever exists, and copies of one vector, however many, only make more tiles. Only axes that a query
probes count in a tile: the others are masked.

Defined results: vectors that are null, zero or hold null or non-finite components take no part; nor
do rows with a null id; a repeated id counts once per distinct vector as a candidate; ties go to the
smaller id; fewer candidates than ``k`` give fewer rows; vectors of another length than the first
found length take no part (first: the most frequent, the smaller on ties); a repeated query id is
searched by each of its vectors and keeps the best scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from utterspark.llm.common import prepare

TABLES, PROBES, LEAST, SEED = 2, 48, 4_000, 5
TILE_ROWS, QUERY_ROWS, CHUNK = 16_384, 4_096, 256


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows (their length a power of two), scaled to keep norms."""
    n, d = x.shape
    step = 1
    while step < d:
        y = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        step *= 2
    return x / np.sqrt(d)


def rotate(x: np.ndarray, table: int) -> np.ndarray:
    rng = np.random.default_rng([SEED, table])
    for _ in range(3):
        x = hadamard(x * rng.choice(np.array([-1.0, 1.0]), x.shape[1]))
    return x


def unit(v: np.ndarray, scale: float, augment: bool, query: bool) -> np.ndarray:
    """Rows as (nearly) unit vectors of a power-of-two length; ``augment`` adds the coordinate that the
    reduction of inner products to angles needs when norms differ."""
    n, dim = v.shape
    norm = np.sqrt((v * v).sum(axis=1))
    width = 1
    while width < dim + augment:
        width *= 2
    out = np.zeros((n, width))
    out[:, :dim] = v / (norm if query or not augment else np.full(n, scale))[:, None]
    if augment and not query:
        out[:, dim] = np.sqrt(np.maximum(1.0 - (norm / scale) ** 2, 0.0))
    return out


def axes(v: np.ndarray, table: int) -> np.ndarray:
    """Nearest signed axis: 2 * coordinate, + 1 if negative."""
    y = rotate(v, table)
    at = np.abs(y).argmax(axis=1)
    return 2 * at + (y[np.arange(len(y)), at] < 0)


def probes(v: np.ndarray, table: int, held: np.ndarray, count: int, least: int) -> np.ndarray:
    """Flags of the signed axes that each row probes: the ``count`` nearest, and further ones until
    their lists hold ``least`` vectors. ``held`` has the number of vectors of every axis."""
    y = rotate(v, table)
    both = np.stack([y, -y], axis=2).reshape(len(y), -1)
    order = np.argsort(-both, axis=1, kind="stable")
    before = np.cumsum(held[order], axis=1) - held[order]
    take = (np.arange(order.shape[1]) < count) | (before < least)
    out = np.zeros(order.shape, bool)
    np.put_along_axis(out, order, take, axis=1)
    return out


def _good(vec: Column) -> Column:
    """A double array without null or non-finite components and not all zero, else null."""
    v = vec.cast("array<double>")
    fine = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(v.isNotNull() & fine & F.exists(v, lambda x: x != 0.0), v)


def _matrix(col: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return np.frombuffer(b"".join(col.to_pylist()), np.float64).reshape(len(col), dim)


def _pack(v: np.ndarray) -> pa.Array:
    return pa.array([x.tobytes() for x in np.ascontiguousarray(v)], pa.binary())


def _vectors(b: pa.RecordBatch, dim: int) -> np.ndarray:
    c = b.column("v")
    return c.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(c), dim)


def _count_task(dim: int, scale: float, augment: bool, tables: int):
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            if len(b):
                u = unit(_vectors(b, dim), scale, augment, False)
                for t in range(tables):
                    sums[t] = sums.get(t, 0) + np.bincount(axes(u, t), minlength=2 * u.shape[1])
        for t, n in sums.items():
            yield pa.RecordBatch.from_pydict({"t": pa.array([t] * len(n), pa.int32()), "axis": pa.array(np.arange(len(n)), pa.int32()), "n": pa.array(n.astype(np.int64))})
    return run


class Tiles:
    """Which tiles an axis of a table is dealt to: first tile and number of slots."""

    def __init__(self, held: np.ndarray, tile_rows: int):
        self.held = held
        self.first, self.slots = np.zeros(held.shape, np.int64), np.ones(held.shape, np.int64)
        n, room = -1, 0
        for t in range(held.shape[0]):
            room = 0
            for a in range(held.shape[1]):
                h = int(held[t, a])
                if h > tile_rows:
                    self.slots[t, a] = -(-h // tile_rows)
                    self.first[t, a], n, room = n + 1, n + int(self.slots[t, a]), 0
                else:
                    if h > room:
                        n, room = n + 1, tile_rows
                    self.first[t, a], room = max(n, 0), room - h
        self.count = n + 1


def _deal_task(shared, dim: int, scale: float, augment: bool, tables: int, count: int, least: int, blocks: int):
    """Copies of vectors (one per table and query block) and of queries (one per tile they probe)."""
    def run(batches):
        tiles = shared.value
        for b in batches:
            for lo in range(0, len(b), 2048):
                x = b.slice(lo, 2048)
                v, ids = _vectors(x, dim), x.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
                packed = _pack(v)
                u, is_query = unit(v, scale, augment, False), x.column("is_query").to_numpy(zero_copy_only=False).astype(bool)
                q = np.flatnonzero(is_query)
                uq = unit(v[q], scale, augment, True)
                for t in range(tables):
                    a = axes(u, t)
                    tile = tiles.first[t, a] + np.abs(ids) % tiles.slots[t, a]
                    for k in range(blocks):
                        yield _dealt(tile * blocks + k, ids, packed, a, None)
                    if len(q) == 0:
                        continue
                    flags = probes(uq, t, tiles.held[t], count, least) & (tiles.held[t] > 0)
                    row, axis = np.nonzero(flags)
                    first, slots = tiles.first[t, axis], tiles.slots[t, axis]
                    at = np.repeat(first, slots) + np.arange(slots.sum()) - np.repeat(np.cumsum(slots) - slots, slots)
                    pair = np.unique(np.repeat(row, slots) * tiles.count + at)
                    r, at = pair // tiles.count, pair % tiles.count
                    masks = [m.tobytes() for m in np.packbits(flags, axis=1)]
                    yield _dealt(at * blocks + np.abs(ids[q[r]] // 7919) % blocks, ids[q[r]], packed.take(pa.array(q[r])), None, [masks[i] for i in r])
    return run


def _dealt(tile, ids, packed, axis, mask) -> pa.RecordBatch:
    n = len(ids)
    return pa.RecordBatch.from_pydict({"tile": pa.array(tile, pa.int64()), "id": pa.array(ids, pa.int64()), "v": packed,
                                       "axis": pa.nulls(n, pa.int32()) if axis is None else pa.array(axis, pa.int32()),
                                       "mask": pa.nulls(n, pa.binary()) if mask is None else pa.array(mask, pa.binary())})


def _inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed in order: the same vectors give the same bits everywhere."""
    s = np.zeros(len(a))
    for i in range(a.shape[1]):
        s += a[:, i] * b[:, i]
    return s


def _tile_task(dim: int, k: int):
    def run(t: pa.Table) -> pa.Table:
        stored = t.column("mask").combine_chunks().is_null().to_numpy(zero_copy_only=False)
        mine, ask = t.filter(pa.array(stored)), t.filter(pa.array(~stored))
        out: list[tuple[np.ndarray, ...]] = []
        if len(mine) and len(ask):
            v, ids = _matrix(mine.column("v"), dim), mine.column("id").to_numpy()
            axis = mine.column("axis").to_numpy().astype(np.int64)
            by = np.argsort(ids, kind="stable")
            v, ids, axis = v[by], ids[by], axis[by]
            first = np.flatnonzero(np.diff(ids, prepend=ids[0] - 1))  # an id's vectors lie together
            q, qids = _matrix(ask.column("v"), dim), ask.column("id").to_numpy()
            masks = np.unpackbits(np.frombuffer(b"".join(ask.column("mask").to_pylist()), np.uint8).reshape(len(ask), -1), axis=1).astype(bool)
            for lo in range(0, len(q), CHUNK):
                s = q[lo:lo + CHUNK] @ v.T
                s[~masks[lo:lo + CHUNK][:, axis] | (qids[lo:lo + CHUNK, None] == ids[None, :])] = -np.inf
                best = np.maximum.reduceat(s, first, axis=1) if len(first) < len(ids) else s  # the k places are for ids
                n = min(k, best.shape[1])
                floor = -np.partition(-best, n - 1, axis=1)[:, n - 1]
                slack = 1e-9 * np.maximum(1.0, np.abs(np.where(np.isfinite(floor), floor, 0.0)))
                row, col = np.nonzero((s >= (floor - slack)[:, None]) & (s > -np.inf))
                exact = _inner(q[lo + row], v[col])
                if best is not s:
                    order = np.lexsort((-exact, ids[col], row))
                    row, col, exact = row[order], col[order], exact[order]
                    new = np.ones(len(row), bool)
                    new[1:] = (row[1:] != row[:-1]) | (ids[col[1:]] != ids[col[:-1]])
                    row, col, exact = row[new], col[new], exact[new]
                order = np.lexsort((ids[col], -exact, row))
                row, col, exact = row[order], col[order], exact[order]
                rank = np.arange(len(row)) - np.searchsorted(row, row)
                keep = rank < k
                out.append((qids[lo + row[keep]], ids[col[keep]], exact[keep]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})
    return run


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           tables: int = TABLES, count: int = PROBES, least: int = LEAST,
           tile_rows: int = TILE_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products found among all other rows of
    ``vectors`` for every row that ``is_query`` holds for."""
    spark = vectors.sparkSession
    prepare(spark)
    v = vectors.select(F.col(id_col).cast("long").alias("id"), _good(F.col(vec_col)).alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    v = v.where(F.col("v").isNotNull() & F.col("id").isNotNull())
    # repeated rows count once, also in what the lists of the axes hold
    v = v.groupBy("id", "v").agg(F.max("is_query").alias("is_query")).checkpoint(eager=True)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    shape = (v.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_query").cast("long")).alias("q"), F.max(norm).alias("hi"), F.min(norm).alias("lo"))
             .orderBy(F.desc("n"), "dim").limit(1).collect())
    if not shape or not shape[0]["q"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, hi, lo = shape[0]["dim"], shape[0]["hi"], shape[0]["lo"]
    augment = hi - lo > 1e-4 * hi
    v = v.where(F.size("v") == dim)
    counts = v.select("v").mapInArrow(_count_task(dim, hi, augment, tables), "t int, axis int, n long").groupBy("t", "axis").agg(F.sum("n").alias("n")).collect()
    held = np.zeros((tables, 1 + max(r["axis"] for r in counts)), np.int64)  # one number per table and axis
    for r in counts:
        held[r["t"], r["axis"]] = r["n"]
    shared = spark.sparkContext.broadcast(Tiles(held, tile_rows))
    blocks = -(-int(shape[0]["q"]) // query_rows)
    dealt = v.mapInArrow(_deal_task(shared, dim, hi, augment, tables, count, least, blocks), "tile long, id long, v binary, axis int, mask binary")
    near = dealt.groupBy("tile").applyInArrow(_tile_task(dim, k), "query_id long, vec_id long, score double")
    best = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
