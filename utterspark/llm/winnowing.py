"""Benchmark decontamination by winnowing.

Words are runs of letters, digits and non-ASCII characters with A-Z lower-cased, as 64-bit hashes. Of
every ``window - k + 1`` consecutive k-grams of words the one with the smallest hash is kept (the last of
equal ones), by the same rule on both sides, so any ``window`` consecutive words that a document shares
with an item hold a fingerprint that both keep: no shared span of that length can be missed. Items of
fewer words are one window of all their words; winnowed with a window of one k-gram of their own
length, every position of a document is a fingerprint for them.

Documents and items give (hash, words before, the k-gram's words, words after) for every fingerprint;
these are joined on the hash, the k-grams' words compared, and the hit is extended word by word to both
sides as far as a window reaches. A run of ``window`` equal words or more is a hit; every window of a
longer shared span has a fingerprint of its own, so the union of the runs is exactly the set of words
inside an occurring window.

Scale: the documents are read once and never shuffled. A Bloom filter of the items' fingerprints,
``FILTER_BITS`` bits whatever the number of items, is broadcast and keeps foreign fingerprints out of
the join, so what is shuffled follows the matches. Copies of a fingerprint with the same surroundings
are one row of the items' side however many items share them. That side is broadcast behind a check of
its measured size; beyond it the join shuffles and AQE splits a passage that many documents hold. The
runs of a document, bounded by its words, are merged per document.

Words are compared by their 64-bit hashes: a false run needs colliding words within ten equal ones.

Defined results: null and empty texts, and texts without words, have no words and no hits; items
without words never occur; rows that repeat a doc_id stay rows of their own; items that repeat an
item_id count once; a null item_id counts as no item but its windows hit; empty tables give empty or
clean results; extra columns of either table are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterspark.llm.common import FOLD_AZ, SpanHasher, bounded_broadcast, mix64, prepare, ragged, row_slices, utf8, word_spans

WINDOW, K = 10, 5
FILTER_BITS = 1 << 26
SEPARATOR = np.ones(256, bool)  # of the ASCII range only digits and letters are word bytes; all others are
SEPARATOR[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_GRAM = np.random.default_rng(23).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)

PRINTS = "array<struct<kind:int,hash:long,pos:int,before:array<long>,gram:array<long>,after:array<long>>>"
_LONGS = pa.list_(pa.int64())
_PRINT = pa.struct([("kind", pa.int32()), ("hash", pa.int64()), ("pos", pa.int32()), ("before", _LONGS), ("gram", _LONGS), ("after", _LONGS)])


def words_of(arr: pa.Array, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes of all texts one after another, word offsets of the texts)."""
    data, off = utf8(arr)
    starts, ends, row = word_spans(data, off, SEPARATOR)
    hasher.load(data)
    return hasher.spans(starts, ends), np.searchsorted(row, np.arange(len(off)))


def gram_hashes(w: np.ndarray, k: int, kind: int) -> np.ndarray:
    """Hash of the k words from every position on; ``kind`` keeps apart what must not be joined."""
    h = np.full(max(len(w) - k + 1, 0), kind, np.uint64)
    for j in range(k):
        h = mix64(h ^ (w[j:j + len(h)] * _GRAM[j]))
    return h


def winnow(h: np.ndarray, stop: np.ndarray, grams: int) -> np.ndarray:
    """Positions of the smallest (of equal ones the last) hash of each run of ``grams`` positions that
    does not pass ``stop`` of its first position."""
    n = len(h) - grams + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at = h[:n].copy(), np.arange(n)
    for j in range(1, grams):
        x = h[j:j + n]
        less = x <= best
        best[less] = x[less]
        at[less] = np.flatnonzero(less) + j
    inside = np.arange(n) + grams <= stop[:n]
    return np.unique(at[inside])


def fingerprints(w: np.ndarray, off: np.ndarray, window: int, k: int, short: list[int]) -> dict[str, np.ndarray]:
    """Fingerprints of all texts: kind, hash, first word (at), words of the gram (size), words before
    and after. Kind 0 are the winnowed k-grams of texts of at least ``window`` words, kind m are all
    grams of m words for each m in ``short``."""
    first, last = np.repeat(off[:-1], np.diff(off)), np.repeat(off[1:], np.diff(off))  # of each word's text
    h = gram_hashes(w, k, 0)
    at = winnow(h, last[:len(h)] - k + 1, window - k + 1)
    reach = window - k
    found = [(np.zeros(len(at), np.int64), h[at], at, np.full(len(at), k), np.minimum(at - first[at], reach), np.minimum(last[at] - at - k, reach))]
    for m in short:
        h = gram_hashes(w, m, m)
        at = np.flatnonzero(np.arange(len(h)) + m <= last[:len(h)])
        none = np.zeros(len(at), np.int64)
        found.append((none + m, h[at], at, none + m, none, none))
    names = ("kind", "hash", "at", "size", "before", "after")
    return dict(zip(names, (np.concatenate(x) for x in zip(*found))))


def _slots(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(FILTER_BITS - 1)
    return h & mask, (h >> np.uint64(32)) & mask


def _known(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    found = np.ones(len(h), np.uint64)
    for slot in _slots(h):
        found &= bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))
    return found.astype(bool)


def _packed(w: np.ndarray, off: np.ndarray, prints: dict[str, np.ndarray], keep: np.ndarray) -> pa.Array:
    """One list of fingerprint structs per text."""
    p = {c: x[keep] for c, x in prints.items()}
    row = np.searchsorted(off, p["at"], "right") - 1
    order = np.argsort(row, kind="stable")
    p, row = {c: x[order] for c, x in p.items()}, row[order]
    at, size = p["at"], p["size"]

    def lists(start, lens):
        ends = pa.array(np.append(0, np.cumsum(lens)).astype(np.int32))
        return pa.ListArray.from_arrays(ends, pa.array(w[ragged(start, lens)].view(np.int64)))

    structs = pa.StructArray.from_arrays(
        [pa.array(p["kind"].astype(np.int32)), pa.array(p["hash"].view(np.int64)), pa.array((at - off[row]).astype(np.int32)),
         lists(at - p["before"], p["before"]), lists(at, size), lists(at + size, p["after"])], fields=list(_PRINT))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(off))).astype(np.int32)), structs)


def _task(window: int, k: int, short: list[int] | None = None, shared=None):
    """Number of words and fingerprints of every text. Of documents (``shared`` is the items' filter)
    those that the filter knows; of items the winnowed ones, or the whole item where it is short."""
    def run(batches):
        hasher = SpanHasher(FOLD_AZ)
        for b in batches:
            for lo, hi in row_slices(b.column("text")):
                x = b.slice(lo, hi - lo)
                w, off = words_of(x.column("text"), hasher)
                n = np.diff(off)
                p = fingerprints(w, off, window, k, sorted(set(n[(n > 0) & (n < window)].tolist())) if shared is None else short)
                if shared is None:
                    keep = (p["kind"] == 0) | (p["kind"] == n[np.searchsorted(off, p["at"], "right") - 1])
                else:
                    keep = _known(shared.value, p["hash"])
                yield pa.RecordBatch.from_arrays([x.column("id"), pa.array(n), _packed(w, off, p, keep)], ["id", "n_words", "prints"])
    return run


def _filter(grams: DataFrame) -> np.ndarray:
    """The Bloom filter of ``hash``: at most FILTER_BITS / 64 rows reach the driver."""
    mask = F.lit(FILTER_BITS - 1).cast("long")
    slots = F.array(F.col("hash").bitwiseAND(mask), F.shiftrightunsigned("hash", 32).bitwiseAND(mask))
    words = (grams.select(F.explode(slots).alias("s"))
             .groupBy(F.shiftright("s", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(s & 63 as int)))").alias("bits")).toPandas())
    bits = np.zeros(FILTER_BITS // 64, np.uint64)
    bits[words["at"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return bits


def _equal_run(a: Column, b: Column) -> Column:
    """How many leading elements of two arrays are equal."""
    at = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x != y, F.lit(True))), True)
    return F.when(at == 0, F.least(F.size(a), F.size(b))).otherwise(at - 1).cast("int")


def contaminated_words(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                       item_text_col: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """One row per row of ``docs``: its id, n_words, n_hit (words inside an occurring window), spans (the
    distinct runs of hit words: start, stop; a run may overlap the next) and items (the ids, as strings
    in order, of the items whose windows occur)."""
    if not 1 <= k <= window:
        raise ValueError("k must be between 1 and the window")
    spark = docs.sparkSession
    prepare(spark)

    def read(df, id_, text):
        return df.select(F.col(id_).alias("id"), F.col(text).cast("string").alias("text"))

    item = (read(items, item_id_col, item_text_col).withColumn("id", F.col("id").cast("string"))
            .mapInArrow(_task(window, k), f"id string, n_words long, prints {PRINTS}").checkpoint(eager=True))
    short = sorted(r["n_words"] for r in item.where(f"n_words > 0 and n_words < {window}").select("n_words").distinct().collect())
    # items that share a gram and its surroundings are one row
    grams = (item.select("id", F.explode("prints").alias("p")).select("id", "p.*")
             .groupBy("kind", "hash", "before", "gram", "after").agg(F.collect_set("id").alias("items")).checkpoint(eager=True))
    shared = spark.sparkContext.broadcast(_filter(grams))
    kind = read(docs, id_col, text_col).schema["id"].dataType.simpleString()
    seen = (read(docs, id_col, text_col).mapInArrow(_task(window, k, short, shared), f"id {kind}, n_words long, prints {PRINTS}")
            .withColumn("row", F.monotonically_increasing_id()).checkpoint(eager=True))
    d = seen.select("row", F.explode("prints").alias("p")).select("row", "p.*").alias("d")
    i = bounded_broadcast(grams).alias("i")
    pairs = d.join(i, (F.col("d.hash") == F.col("i.hash")) & (F.col("d.kind") == F.col("i.kind")) & (F.col("d.gram") == F.col("i.gram")))
    left = _equal_run(F.reverse("d.before"), F.reverse("i.before"))
    right = _equal_run(F.col("d.after"), F.col("i.after"))
    runs = pairs.select("row", F.col("d.kind").alias("kind"), (F.col("d.pos") - left).alias("start"),
                        (F.col("d.pos") + F.size("d.gram") + right).alias("stop"), "i.items")
    runs = runs.where((F.col("kind") > 0) | (F.col("stop") - F.col("start") >= window))
    span = F.struct("start", "stop")
    hit = (runs.groupBy("row").agg(F.sort_array(F.collect_set(span)).alias("spans"), F.collect_set("items").alias("items"))
           .withColumn("items", F.sort_array(F.array_distinct(F.flatten("items")))).checkpoint(eager=True))
    out = seen.select("row", F.col("id").alias(id_col), "n_words").join(bounded_broadcast(hit), "row", "left")
    none = F.array().cast("array<struct<start:int,stop:int>>")
    out = out.select(id_col, "n_words", F.coalesce("spans", none).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    # spans are in order of their start: each adds what lies beyond the furthest stop so far
    ends = F.aggregate("spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")), lambda acc, s: F.struct(
        F.greatest(acc["end"], s["stop"]).alias("end"),
        (acc["n"] + F.greatest(s["stop"] - F.greatest(acc["end"], s["start"]), F.lit(0))).alias("n")))
    return out.select(id_col, "n_words", ends["n"].alias("n_hit"), "spans", "items")


# A window of a long item, a short item and every occurrence by plain string comparison.
ORACLE = r"""
with w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words, row_number() over () as r from documents),
i as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark),
iw as (
  select distinct item_id, least(len(words), 10) as m, list_aggregate(words[p:p + least(len(words), 10) - 1], 'string_agg', ' ') as win
  from (select item_id, words, unnest(generate_series(1, greatest(len(words) - 9, 1))) as p from i where len(words) > 0)),
lens as (select distinct m from iw),
dw as (
  select r, p, m, list_aggregate(words[p:p + m - 1], 'string_agg', ' ') as win
  from (select r, words, m, unnest(generate_series(1, len(words) - m + 1)) as p from w, lens where len(words) >= m)),
hits as (select r, p, dw.m, item_id from dw join iw on dw.win = iw.win and dw.m = iw.m),
hw as (select r, count(distinct x) as n_hit from (select r, unnest(generate_series(p, p + m - 1)) as x from (select distinct r, p, m from hits)) group by r),
hi as (select r, count(*) as n_items, string_agg(s, ',' order by s) as ids from (select distinct r, cast(item_id as varchar) as s from hits where item_id is not null) group by r)
select doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from w left join hw using (r) left join hi using (r)
"""
