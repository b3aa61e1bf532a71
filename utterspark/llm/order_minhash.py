"""Document fingerprints: Order MinHash, in DataFrame functions only.

A text's k-mers are its runs of ``KMER`` words (a shorter text is one k-mer). Each k-mer gets its
occurrence number within the text and the pair is hashed; the top bits of the hash choose one of
``BINS`` samples (one permutation cut into ranges instead of that many permutations). A sample keeps
its ``TUPLE`` smallest pairs, puts them back into text order and hashes the ordered tuple, so moving
passages changes the fingerprint as an edit distance would see it, where a plain MinHash would not.

All steps are array expressions on one row: hash, sort (packed longs), number, sort, select. Work is
O(n log n) in the words of a text, occurrence numbers of repeated k-mers come from a binary search in
the sorted hashes. No step needs the rows of another document.

A fingerprint is a string of ten hex digits per non-empty sample (sample number, tuple hash). The
likeness of two fingerprints is the share of equal samples among those that either has.

Defined results: null counts as empty; texts without words have the empty fingerprint; two empty
fingerprints are alike (1.0), an empty and another one are not (0.0); equal texts have equal
fingerprints. Word positions beyond 2**24 - 1 count as that position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from utterspark.session import ensure_checkpoint_dir

KMER, TUPLE, BINS = 3, 2, 64
SEPARATOR = r"[\x20\x09-\x0D]+"
_POS_BITS = 24
_POS = (1 << _POS_BITS) - 1
_BIN_SHIFT = 58  # 64 - log2(BINS)
ROWS_PER_RANGE, MAX_RANGES, FAN = 2_000, 20_000, 128


def _bin(x: Column) -> Column:
    return F.shiftrightunsigned(x, _BIN_SHIFT)


def with_signature(df: DataFrame, text: Column, out: str, kmer: int = KMER, size: int = TUPLE) -> DataFrame:
    """``df`` with ``out``: the sorted signature, one long (sample << 32 | tuple hash) per sample."""
    keep = [F.col(f"`{c}`") for c in df.columns]
    longs = F.array().cast("array<bigint>")

    def step(d: DataFrame, **new: Column) -> DataFrame:
        return d.select(*keep, *[c.alias(n) for n, c in new.items()])

    d = step(df, _w=F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATOR), ""))
    d = step(d, _h=F.transform("_w", lambda w: F.xxhash64(w)))
    n = F.size("_h")
    at = lambda i: F.get(F.col("_h"), i)
    runs = F.transform(F.slice("_h", F.lit(1), F.greatest(n - (kmer - 1), F.lit(0))),
                       lambda x, i: F.xxhash64(x, *[at(i + j) for j in range(1, kmer)]))
    d = step(d, _k=F.when(n >= kmer, runs).when(n > 0, F.array(F.xxhash64("_h", F.lit("short")))).otherwise(longs))
    packed = F.transform("_k", lambda x, i: x.bitwiseAND(F.lit(~_POS)).bitwiseOR(F.least(i, F.lit(_POS)).cast("long")))
    d = step(d, _s=F.sort_array(packed))
    s = lambda i: F.get(F.col("_s"), i)

    def first_of(x: Column, i: Column) -> Column:
        """Index of the first packed entry with x's k-mer: binary search in [0, i]."""
        least = x.bitwiseAND(F.lit(~_POS))
        steps = F.sequence(F.lit(0), F.ceil(F.log2(i + 1.0)).cast("int"))

        def halve(acc, _):
            mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
            low = s(mid) >= least
            done = acc["lo"] >= acc["hi"]
            return F.struct(F.when(done | low, acc["lo"]).otherwise(mid + 1).alias("lo"),
                            F.when(done | ~low, acc["hi"]).otherwise(mid).alias("hi"))

        return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), i.alias("hi")), halve, lambda acc: acc["lo"])

    def same(x: Column, y: Column) -> Column:
        return F.shiftright(x, _POS_BITS) == F.shiftright(y, _POS_BITS)

    def numbered(x: Column, i: Column) -> Column:
        again = (i > 0) & same(s(i - 1), x)
        occurrence = F.when(~again, 0).otherwise(i - first_of(x, i))
        return F.xxhash64(F.shiftright(x, _POS_BITS), occurrence).bitwiseAND(F.lit(~_POS)).bitwiseOR(x.bitwiseAND(F.lit(_POS)))

    d = step(d, _g=F.sort_array(F.transform("_s", numbered)))
    g = lambda i: F.get(F.col("_g"), i)
    d = step(d, _t=F.filter("_g", lambda x, i: (i < size) | (_bin(g(i - size)) != _bin(x))))
    t = lambda i: F.get(F.col("_t"), i)

    def sample(x: Column, i: Column) -> Column:
        """Tuple hash at the first entry of a sample, null at the others."""
        head = (i == 0) | (_bin(t(i - 1)) != _bin(x))
        members = [x, *[F.when(_bin(t(i + j)) == _bin(x), t(i + j)) for j in range(1, size)]]
        # text order: by position, absent members (null) last and hashed as nothing
        pairs = F.sort_array(F.filter(F.array(*[F.when(m.isNotNull(), F.struct(m.bitwiseAND(F.lit(_POS)).alias("p"), F.shiftright(m, _POS_BITS).alias("g"))) for m in members]), lambda p: p.isNotNull()))
        digest = F.xxhash64(F.transform(pairs, lambda p: p["g"])).bitwiseAND(F.lit(0xFFFFFFFF))
        return F.when(head, F.shiftleft(_bin(x), 32).bitwiseOR(digest))

    d = step(d, _t2=F.filter(F.transform("_t", sample), lambda x: x.isNotNull()))
    return d.select(*keep, F.sort_array("_t2").alias(out))


def fingerprint(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), 10, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples among those that either signature has, 0 to 1."""
    bins = lambda s: F.transform(s, lambda x: F.shiftright(x, 32))
    either = F.size(F.array_union(bins(a), bins(b)))
    return F.when(either == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / either).cast("double")


def _ranges(ids: DataFrame) -> list[int]:
    """Ascending bounds that cut the ids into ranges of about ``ROWS_PER_RANGE`` rows; the number of
    ranges is bounded, so the bounds fit a plan literal."""
    n = ids.count()
    k = int(min(max(n // ROWS_PER_RANGE, 1), MAX_RANGES))
    if k < 2:
        return []
    cuts = ids.agg(F.percentile_approx("doc_id", [i / k for i in range(1, k)], 4 * k).alias("p")).first()["p"]
    return sorted(set(cuts or []))


def _range_of(doc_id: Column, bounds: list[int]) -> Column:
    """Number of bounds <= doc_id (null: 0), found in two levels of at most FAN-wide arrays."""
    if not bounds:
        return F.lit(0)
    flat = F.array(*[F.lit(x).cast("long") for x in bounds])
    heads = F.array(*[F.lit(x).cast("long") for x in bounds[::FAN]])
    group = F.size(F.filter(heads, lambda x: x <= doc_id))
    inner = F.size(F.filter(F.slice(flat, (group - 1) * FAN + 1, F.lit(FAN)), lambda x: x <= doc_id))
    return F.when(doc_id.isNull() | (group == 0), 0).otherwise((group - 1) * FAN + inner).cast("int")


def with_next(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` (doc_id, ...) with ``next_<c>`` of the next row in descending doc_id; after the last comes
    the first, null ids come last, equal ids go by text.

    One shuffle by id range with a window inside each range. A range's last row finds its successor
    because the first id of the following range (one id per range, a bounded table) is also dealt to
    it as an extra row."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    bounds = _ranges(df.select("doc_id"))
    x = df.withColumn("_b", _range_of(F.col("doc_id"), bounds))
    heads = df.select("doc_id", _range_of(F.col("doc_id"), bounds).alias("_b")).groupBy("_b").agg(F.max("doc_id").alias("h")).collect()
    heads = sorted(((r["_b"], r["h"]) for r in heads), reverse=True)
    # the head of a range serves the range before it in descending order; the first serves the last
    serves = [(heads[i][1], heads[i - 1][0]) for i in range(len(heads))]
    extra = spark.createDataFrame(serves, "h long, _to int")
    x = x.join(F.broadcast(extra), x["doc_id"].eqNullSafe(extra["h"]), "left").drop("h")
    both = F.when(F.col("_to").isNull(), F.array(F.struct(F.col("_b").alias("b"), F.lit(0).alias("x"))))
    x = x.withColumn("_at", F.explode(both.otherwise(F.array(F.struct(F.col("_b").alias("b"), F.lit(0).alias("x")), F.struct(F.col("_to").alias("b"), F.lit(1).alias("x"))))))
    x = x.withColumn("_b", F.col("_at.b")).withColumn("_x", F.col("_at.x")).drop("_at", "_to")
    w = Window.partitionBy("_b").orderBy("_x", F.col("doc_id").desc_nulls_last(), "text")
    x = x.select(*df.columns, "_x", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns])
    return x.where("_x = 0").drop("_x")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next): each
    text, its edited text (the last half replaced by as much of the next document's beginning) and the
    likeness of its fingerprint to that and to the next document's. One row per row of ``docs``."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    d = with_signature(d, F.col("text"), "sig")
    d = with_next(d, ["text", "sig"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    d = d.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sig", "next_sig")
    d = with_signature(d, F.col("edited"), "edited_sig")
    return d.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                    fingerprint(F.col("sig")).alias("fingerprint"), fingerprint(F.col("edited_sig")).alias("edited_fingerprint"),
                    likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
                    likeness(F.col("sig"), F.col("next_sig")).alias("near_next"))
