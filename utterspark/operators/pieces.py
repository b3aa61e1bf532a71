"""Sub-word ids: longest-match-first pieces of a given vocabulary, with begin and end ids.

The vocabulary is a public rank file (its path is a parameter, nothing is learned or copied): a token with
a leading space begins a word, any other continues one. A word is cut into the longest piece that begins
it, then the longest piece that continues it from there, and so on; a word that cannot be cut whole, or is longer
than ``MAX_WORD`` characters, is one unknown id. Words are those of :func:`tokenize_mixed` (every Han
character by itself, runs of letters, marks and numbers of any script).

The pieces form one trie with two roots, held as sorted (node, character) keys and walked for all distinct
words of a batch at once: one search a character place, no loop over rows or words. The trie is a few MB
(its size is checked) and broadcast, so encoding is a projection: no join with a vocabulary table, no
shuffle, whatever words are frequent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from utterspark.functions.slices import cuts_of, give_back
from utterspark.operators.features import MAX_LENGTH, PAD_ID, UNK_ID
from utterspark.session import materialize, ship_package

# Ids of the marks round a text, the first piece's id, and the longest word that is cut.
BEGIN_ID = 2
END_ID = 3
FIRST_PIECE_ID = 4
MAX_WORD = 100

MAX_PIECES = 2_000_000
SLICE_WORDS = 200_000  # words that are cut at a time
_BITS = 21  # of a code point


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """(piece, continues, id) of a rank file: lines of a base64 token and its rank, read by Spark. Tokens
    that are not valid UTF-8, a lone space and empty tokens are no pieces; equal pieces have the lowest id."""
    line = F.split("value", " ")
    token = F.unbase64(line[0])
    text = F.decode(F.when(F.is_valid_utf8(token.cast("string")), token), "UTF-8")
    t = spark.read.text(path).select(text.alias("t"), line[1].cast("long").alias("rank")).where("t is not null and rank is not null")
    begins = F.startswith("t", F.lit(" "))
    t = t.select(F.when(begins, F.substr("t", F.lit(2))).otherwise(F.col("t")).alias("piece"), (~begins).alias("continues"), "rank")
    return t.where("piece <> ''").groupBy("piece", "continues").agg((F.min("rank") + FIRST_PIECE_ID).alias("id"))


class Trie:
    """Pieces that begin a word hang from node 0, pieces that continue one from node 1."""

    def __init__(self, pieces: list[str], continues: np.ndarray, ids: np.ndarray):
        n = len(pieces)
        points = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32).astype(np.int64)
        size = np.fromiter(map(len, pieces), np.int64, n)
        start = np.cumsum(size) - size
        node = np.asarray(continues, np.int64)
        self.accepts = [np.full(2, -1, np.int64)]
        keys, children, total, depth = [], [], 2, 0
        live = np.flatnonzero(size > 0)
        ids = np.asarray(ids, np.int64)
        while len(live):
            key = node[live] << _BITS | points[start[live] + depth]
            distinct, child = np.unique(key, return_inverse=True)
            keys.append(distinct)
            children.append(total + np.arange(len(distinct)))
            node[live] = total + child
            depth += 1
            here = live[size[live] == depth]
            accept = np.full(len(distinct), -1, np.int64)
            accept[node[here] - total] = ids[here]
            self.accepts.append(accept)
            total += len(distinct)
            live = live[size[live] > depth]
        # nodes are numbered level by level, so the keys of all levels are in order
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        self.children = np.concatenate(children) if children else np.zeros(0, np.int64)
        self.accept = np.concatenate(self.accepts)
        self.depth = depth
        del self.accepts

    def cut(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, offsets of the words)."""
        texts = words.to_pylist()
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        points = np.append(np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64), 0)
        end = np.cumsum(size)
        at = end - size
        found, of = [], []
        unknown = (size > MAX_WORD) | (size == 0)
        live = np.flatnonzero(~unknown)
        root = np.zeros(len(texts), np.int64)
        while len(live):
            best, stop = self._longest(points, at[live], end[live], root[live])
            lost = best < 0
            unknown[live[lost]] = True
            live, best, stop = live[~lost], best[~lost], stop[~lost]
            found.append(best)
            of.append(live)
            at[live] = stop
            root[live] = 1
            live = live[stop < end[live]]
        found = np.concatenate([*found, np.zeros(0, np.int64)]).astype(np.int64)
        of = np.concatenate([*of, np.zeros(0, np.int64)]).astype(np.int64)
        whole = ~unknown[of]
        none = np.flatnonzero(unknown & (size > 0))
        of, found = np.concatenate([of[whole], none]), np.concatenate([found[whole], np.full(len(none), UNK_ID)])
        order = np.argsort(of, kind="stable")  # of one word the pieces were found from left to right
        return found[order], np.searchsorted(of[order], np.arange(len(texts) + 1))

    def _longest(self, points, at, end, node) -> tuple[np.ndarray, np.ndarray]:
        """(id of the longest piece, or -1, and where it ends) for every word's rest."""
        best, stop = np.full(len(at), -1, np.int64), at.copy()
        live, place = np.arange(len(at)), at.copy()
        while len(live) and len(self.keys):
            key = node[live] << _BITS | points[place[live]]
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[found] == key
            live, found = live[there], found[there]
            node[live] = self.children[found]
            place[live] += 1
            hit = self.accept[node[live]]
            best[live[hit >= 0]] = hit[hit >= 0]
            stop[live[hit >= 0]] = place[live[hit >= 0]]
            live = live[place[live] < end[live]]
        return best, stop


def piece_trie(pieces: DataFrame):
    """Broadcast trie of (piece, continues, id); at most ``MAX_PIECES`` pieces."""
    spark = pieces.sparkSession
    ship_package(spark)
    rows = pieces.select("piece", "continues", "id").limit(MAX_PIECES + 1).toArrow()
    if len(rows) > MAX_PIECES:
        raise ValueError(f"more than {MAX_PIECES} pieces")
    ids = rows.column("id").to_numpy()
    return spark.sparkContext.broadcast(Trie(rows.column("piece").to_pylist(), rows.column("continues").to_numpy().astype(np.int64), ids))


def _ids_of(lists: pa.Array, trie: Trie) -> pa.Array:
    flat = lists.flatten().dictionary_encode()
    distinct, of = flat.dictionary, flat.indices.to_numpy(zero_copy_only=False)
    ids, off = trie.cut(distinct)
    lens = np.diff(off)[of]
    ends = np.cumsum(lens)
    out = ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(off[:-1][of] - (ends - lens), lens)]
    per_list = np.append(0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
    bounds = np.append(0, ends)[per_list].astype(np.int32)
    mask = lists.is_null() if lists.null_count else None
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(out), mask=mask)


def piece_ids(words: Column, trie) -> Column:
    """ARRAY<BIGINT>: the ids of the pieces of all words of a list, in order; NULL for a NULL list."""
    @F.arrow_udf("array<bigint>")
    def run(lists: pa.Array) -> pa.Array:
        # slices of about SLICE_WORDS words: what a task holds does not follow the length of the texts
        found = [_ids_of(lists.slice(lo, hi - lo), trie.value) for lo, hi in cuts_of(lists.offsets.to_numpy(), SLICE_WORDS)]
        give_back()
        return pa.concat_arrays(found) if found else pa.array([], pa.list_(pa.int64()))

    return run(words)


def encode_pieces(df: DataFrame, id_cols: list[str], words: Column, trie, max_length: int = MAX_LENGTH) -> DataFrame:
    """``input_ids`` and ``attention_mask`` per row: begin, pieces, end, at most ``max_length`` together,
    padded to the longest row. A text without words (or NULL) is begin and end. A word has one id at least,
    so no more words go to the tasks than ids are kept. No shuffle: the rows are encoded once and written,
    and read for the pad length and for the rows."""
    first = F.slice(F.filter(words, lambda w: w != ""), 1, max_length - 2)
    pieces = F.coalesce(piece_ids(first, trie), F.array().cast("array<bigint>"))
    mark = lambda x: F.array(F.lit(x).cast("bigint"))
    e = materialize(df.select(*id_cols, F.slice(pieces, 1, max_length - 2).alias("_p")))
    longest = e.agg(F.max(F.size("_p")).alias("_L")).select(F.lit(0).alias("_k"), "_L")
    e = e.withColumn("_k", F.lit(0)).join(F.broadcast(longest), "_k")  # one row: the pad length
    pad = F.col("_L") - F.size("_p")
    return e.select(
        *id_cols, F.concat(mark(BEGIN_ID), "_p", mark(END_ID), F.array_repeat(F.lit(PAD_ID).cast("bigint"), pad)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), F.size("_p") + 2), F.array_repeat(F.lit(0), pad)).alias("attention_mask"))


def piece_counts(df: DataFrame, words: Column, trie) -> DataFrame:
    """(id, n): how often every piece (and the unknown id) occurs in all texts."""
    return df.select(F.explode(piece_ids(words, trie)).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
