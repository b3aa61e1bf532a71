"""Target-distribution importance resampling over hashed word n-grams.

Every text is a bag of features: all runs of 1 to ``ORDERS`` consecutive words. A feature's bucket is the
crc32 of its bytes modulo ``BUCKETS``. A bucket's gain is the (scaled, floored) logarithm of its smoothed
share in the target over its share in the source; a document's weight is the sum of the gains of its
features, its score the weight plus Gumbel noise from a keyed digest of its id, and the highest scores
are a draw without replacement in proportion to exp(weight / 1000).

Weights are array-scored: crc32 is linear, so the register after "a b c" follows from the words' own
registers by table-driven shifts. All n-grams of a slice of texts are hashed with a few dozen numpy
gathers and no n-gram is ever built as a string; gains are then one gather and one segmented sum.

The cutoff is located by bracketing: a quantile sketch (one pass, mergeable) proposes two scores around
the wanted rank; exact counts of what lies above and inside validate the bracket, which is widened until it
holds the rank; only the rows inside it are sorted (range partitions, ``ranking.global_rank``) to find
the cutoff row. The drawn rows, a fixed share, are ranked the same way.

Scale: two scans of the texts, none shuffled: the first sends one count per task and bucket, the second
broadcasts ``BUCKETS`` gains and writes a few numbers per document, on which everything else works.

Defined results: null and empty texts have no features, weight 0 and take no part in the draw unless
``min_words`` is 0; ties of score go to the smaller id (null ids last), then to fewer features, and among
rows equal in all of them it does not matter which is drawn; repeated rows and ids are rows of their own;
a null id has the noise of an empty one; an empty target or source has share 1 / BUCKETS everywhere;
extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterspark.llm.common import FOLD_AZ, prepare, row_slices, utf8, word_spans
from utterspark.llm.winnowing import SEPARATOR
from utterspark.operators.ranking import global_rank

BUCKETS, ORDERS, SCALE = 10_000, 3, 1000
SEED, MIN_WORDS, SHARE = 42, 20, (5, 100)
ACCURACY = 10_000  # the sketch's rank error is one part in so many


class Crc32:
    """crc32 of word n-grams joined by one space."""

    DIRECT = 64  # shifts by fewer bytes have a table each

    def __init__(self):
        t = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
        self.table = t
        one = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * b) for b in range(4)])
        shifts = [one]
        for _ in range(self.DIRECT):
            shifts.append((shifts[-1] >> 8) ^ t[shifts[-1] & 255])
        self.direct = np.stack(shifts[:-1]).reshape(-1)
        self.doubled = {self.DIRECT: shifts[-1]}  # by a power of two bytes, each from the one before

    def _power(self, n: int) -> np.ndarray:
        if n not in self.doubled:
            half = self._power(n // 2)
            self.doubled[n] = self._by(half.reshape(-1), 0, half).reshape(4, 256)
        return self.doubled[n]

    @staticmethod
    def _by(table: np.ndarray, base, s: np.ndarray) -> np.ndarray:
        out = table[base + (s & 255)]
        for b in range(1, 4):
            out = out ^ table[base + 256 * b + ((s >> np.uint32(8 * b)) & 255)]
        return out

    def shift(self, s: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Registers after ``n`` more zero bytes."""
        out = self._by(self.direct, (n % self.DIRECT) * 1024, s)
        rest = n // self.DIRECT
        far = np.flatnonzero(rest)
        power = self.DIRECT
        while len(far):
            odd = far[(rest[far] & 1) == 1]
            out[odd] = self._by(self._power(power).reshape(-1), 0, out[odd])
            rest >>= 1
            far, power = far[rest[far] > 0], power * 2
        return out

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Registers of the spans' bytes from a zero register: byte by byte over all spans at once, and
        the few long ones by the library."""
        n = ends - starts
        out = np.zeros(len(starts), np.uint32)
        for i in np.flatnonzero(n > self.DIRECT).tolist():
            out[i] = zlib.crc32(data[starts[i]:ends[i]], 0xFFFFFFFF) ^ 0xFFFFFFFF
        live = np.flatnonzero(n <= self.DIRECT)
        at, left, s = starts[live], n[live], out[live]
        while len(live):
            done = left == 0
            if done.any():
                out[live[done]] = s[done]
                keep = ~done
                live, at, left, s = live[keep], at[keep], left[keep], s[keep]
            s = (s >> 8) ^ self.table[(s ^ data[at]) & 255] if len(live) else s
            at, left = at + 1, left - 1
        return out

    def ngrams(self, own: np.ndarray, size: np.ndarray, orders: int):
        """crc32 of the 1-grams, 2-grams, ... from every position on; the last positions run short."""
        s = self.shift(np.full(len(own), 0xFFFFFFFF, np.uint32), size) ^ own
        yield ~s
        for m in range(1, orders):
            s = s[:-1]
            if not len(s):
                return
            s = (s >> 8) ^ self.table[(s ^ np.uint32(32)) & 255]
            s = self.shift(s, size[m:]) ^ own[m:]
            yield ~s


def feature_buckets(arr: pa.Array, crc: Crc32, buckets: int, orders: int):
    """(bucket, row) of every feature of a slice, and the number of words per row."""
    data, off = utf8(arr)
    data = FOLD_AZ[data]
    starts, ends, row = word_spans(data, off, SEPARATOR)
    own, size = crc.spans(data, starts, ends), ends - starts
    found, rows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for m, h in enumerate(crc.ngrams(own, size, orders)):
        whole = row[:len(h)] == row[m:]
        found.append((h[whole] % np.uint32(buckets)).astype(np.int64))
        rows.append(row[:len(h)][whole])
    return np.concatenate(found), np.concatenate(rows), np.bincount(row, minlength=len(arr))


def _count_task(buckets: int, orders: int):
    def run(batches):
        crc, n = Crc32(), np.zeros(buckets, np.int64)
        for b in batches:
            for lo, hi in row_slices(b.column("text")):
                n += np.bincount(feature_buckets(b.column("text").slice(lo, hi - lo), crc, buckets, orders)[0], minlength=buckets)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some.astype(np.int32)), "n": pa.array(n[some])})
    return run


def bucket_counts(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS, orders: int = ORDERS) -> DataFrame:
    """(bucket, n): the features of all texts in every bucket that has any."""
    texts = df.select(F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(_count_task(buckets, orders), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket from two tables of counts (at most ``buckets`` rows each)."""
    n = []
    for counts in (source, target):
        rows = counts.toPandas()
        x = np.zeros(buckets, np.int64)
        x[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
        n.append(x)
    (s, t), (all_s, all_t) = n, (int(x.sum()) for x in n)
    return np.array([math.floor(SCALE * math.log(float(b + 1) * (all_s + buckets) / (float(a + 1) * (all_t + buckets)))) for a, b in zip(s.tolist(), t.tolist())], np.int64)


def _weight_task(shared, orders: int):
    def run(batches):
        crc, gains = Crc32(), shared.value
        for b in batches:
            for lo, hi in row_slices(b.column("text")):
                x = b.slice(lo, hi - lo)
                bucket, row, words = feature_buckets(x.column("text"), crc, len(gains), orders)
                # sums of integers below 2**53 are exact in doubles
                weight = np.bincount(row, gains[bucket].astype(float), hi - lo).astype(np.int64)
                yield pa.RecordBatch.from_arrays([x.column("id"), pa.array(words), pa.array(np.bincount(row, minlength=hi - lo)), pa.array(weight)],
                                                 ["id", "n_words", "n_features", "weight"])
    return run


def importance_weights(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", orders: int = ORDERS, seed: int = SEED) -> DataFrame:
    """``id_col``, n_words, n_features, weight and score of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(np.asarray(gains, np.int64))
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = d.mapInArrow(_weight_task(shared, orders), f"id {d.schema['id'].dataType.simpleString()}, n_words long, n_features long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return out.select(F.col("id").alias(id_col), "n_words", "n_features", "weight", (F.col("weight") + noise).cast("long").alias("score"))


def bracket(rows: DataFrame, score_col: str, k: int, n: int, accuracy: int = ACCURACY) -> tuple[int, int, int]:
    """(low, high, above): a range of scores that holds the k-th highest of ``n`` rows, and how many
    rows lie above it. The sketch proposes; exact counts of the outside validate or widen."""
    margin, wanted = 2.0 / accuracy, 1.0 - k / n
    while True:
        q = [max(wanted - margin, 0.0), min(wanted + margin, 1.0)]
        low, high = rows.agg(F.percentile_approx(score_col, q, accuracy).alias("q")).first()["q"]
        if margin >= 1.0:
            low, high = rows.agg(F.min(score_col), F.max(score_col)).first()
        over, inside = F.col(score_col) > high, F.col(score_col).between(low, high)
        above, within = rows.agg(F.count_if(over), F.count_if(inside)).first()
        if above < k <= above + within:
            return low, high, above
        margin *= 8


def draw(scored: DataFrame, id_col: str = "doc_id", share: tuple[int, int] = SHARE, min_words: int = MIN_WORDS, accuracy: int = ACCURACY) -> DataFrame:
    """``scored`` with a column rank: 1, 2, ... for the highest scores, in order; null if not drawn.
    floor(share x N) of the N rows with at least ``min_words`` words are drawn."""
    all_rows = scored.select("*", (-F.col("score")).alias("_down"), F.col(id_col).isNull().alias("_no_id"),
                             F.monotonically_increasing_id().alias("_row")).checkpoint(eager=True)
    eligible = all_rows.where(F.col("n_words") >= min_words)
    n = eligible.count()
    k = share[0] * n // share[1]
    if k == 0:
        return scored.select("*", F.lit(None).cast("long").alias("rank"))
    keys = ["_down", "_no_id", id_col, "n_features", "_row"]
    low, high, above = bracket(eligible, "score", k, n, accuracy)
    inside = eligible.where(F.col("score").between(low, high)).select(*keys)
    cut = global_rank(inside, keys, size_col=None).where(F.col("rank") == k - above).first()
    types = {f.name: f.dataType for f in all_rows.schema.fields}
    last = F.struct(*[F.lit(cut[c]).cast(types[c]).alias(c) for c in keys])
    chosen = (F.col("n_words") >= min_words) & (F.struct(*keys) <= last)
    ranked = global_rank(all_rows.where(chosen), keys, size_col=None)
    rest = all_rows.where(~F.coalesce(chosen, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return rest.unionByName(ranked).select(*scored.columns, "rank")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", buckets: int = BUCKETS,
             orders: int = ORDERS, seed: int = SEED, share: tuple[int, int] = SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """Every row's ``id_col``, n_words, n_features, weight, score and rank (null if not drawn)."""
    prepare(docs.sparkSession)
    gains = bucket_gains(bucket_counts(docs, text_col, buckets, orders), bucket_counts(target, target_text_col, buckets, orders), buckets)
    return draw(importance_weights(docs, gains, id_col, text_col, orders, seed), id_col, share, min_words)


# crc32 of every text f of a relation {texts}, as a relation {out}(f, h): the register is linear, so it is the
# xor of one table entry per (byte, bytes that follow) and of one for the start value and the length.
CRC32_SQL = """
bits(b, c, step) as (
  select b, b, 0 from range(256) r(b)
  union all select b, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, step + 1 from bits where step < 8),
crc_table as (select b, c from bits where step = 8),
longest as (select coalesce(max(strlen(f)), 0) as n from {texts}),
per_byte(b, v, after) as (
  select b, c, 0 from crc_table
  union all select p.b, xor(p.v >> 8, t.c), after + 1 from per_byte p join crc_table t on t.b = p.v & 255, longest where after < longest.n),
start_value(v, size) as (
  select 4294967295, 0
  union all select xor(s.v >> 8, t.c), size + 1 from start_value s join crc_table t on t.b = s.v & 255, longest where size < longest.n),
text_bytes as (
  select f, strlen(f) - i as after, ('0x' || substr(hex(encode(f)), 2 * i - 1, 2))::bigint as b
  from (select f, unnest(generate_series(1, strlen(f))) as i from {texts})),
{out} as (
  select f, xor(xor(bit_xor(p.v), any_value(s.v)), 4294967295) as h
  from text_bytes x join per_byte p using (b, after) join start_value s on s.size = strlen(x.f) group by f)
"""

ORACLE = r"""
with recursive doc_words as (
  select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
target_words as (
  select regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
grams as (
  select r, list_aggregate(w[p:p + m - 1], 'string_agg', ' ') as f
  from (select r, w, m, unnest(generate_series(1, len(w) - m + 1)) as p
        from (select r, w from doc_words union all select null, w from target_words), generate_series(1, 3) o(m) where len(w) >= m)),
texts as (select distinct f from grams),
""" + CRC32_SQL.format(texts="texts", out="crc") + """,
bucketed as (select r, h % 10000 as bucket, count(*) as n from grams join crc using (f) group by all),
totals as (select coalesce(sum(n) filter (where r is not null), 0) as all_s, coalesce(sum(n) filter (where r is null), 0) as all_t from bucketed),
gains as (
  select bucket, floor(1000 * ln((t + 1)::double * (all_t_and.all_s + 10000) / ((s + 1)::double * (all_t_and.all_t + 10000)))) as gain
  from (select bucket, coalesce(sum(n) filter (where r is not null), 0) as s, coalesce(sum(n) filter (where r is null), 0) as t from bucketed group by bucket), totals all_t_and),
weights as (select r, sum(n) as n_features, sum(n * gain)::bigint as weight from bucketed join gains using (bucket) where r is not null group by r),
scored as (
  select doc_id, len(w) as n_words, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
  from doc_words left join weights using (r)),
ordered as (
  select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id nulls last, n_features) as place,
    5 * count(*) over (partition by n_words >= 20) // 100 as k from scored)
select doc_id, n_features, weight, score, case when n_words >= 20 and place <= k then place end as rank from ordered
"""
