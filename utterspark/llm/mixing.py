"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document's size is its number of words. Sources, in code-point order with null last, weigh 3, 1, 2
in turn and share 150% of all sizes; a target stops at twice its source's size and the excess goes to
the other sources by weight until none is above. That fixed point is a water level: with sources
ordered by cap / weight, the first ones get their cap and the others level x weight, so it needs one
pass over the source table (one row per source) and no iteration.

A document's sampling key is ``-ln(u) / w``: u comes from an md5 of seed and id, w is its quality
weight, so smaller keys are better and reruns agree. A source takes floor(target / size) complete
epochs of all its documents first; the rest of the target is filled by documents in key order up to
the prefix sum nearest to it. The prefix sum never runs over a whole source in one task: keys fall
into buckets of a monotone function, bucket sums give the bucket that holds the cut, whole buckets
before it are taken, and only the cut bucket's rows are sorted. A bucket holds about ``BUCKET_ROWS``
rows of a source at weight 1; keys of lower weight crowd the last buckets, and rows of one id share one.

Defined results: null and empty texts have size 0 and are taken 0 words; equal keys go by doc_id,
then by size (and by the text where rows are kept); a repeated row counts each time it occurs; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from utterspark.llm.common import bounded_broadcast, prepare

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
SEED = "mix"
QUALITY = {1: 2.0, 0: 0.5}
NO_LABEL = 1.0
BUCKET_ROWS = 20_000
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sampling_key(doc_id: Column, quality: Column) -> Column:
    """-ln(u) / w with u in (0, 1) from the first 12 digits of an md5."""
    digits = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(SEED), doc_id.cast("string")).cast("binary")), 1, 12), 16, 10).cast("double")
    u = (digits + F.lit(0.5)) / F.lit(float(1 << 48))
    w = F.when(quality == 1, QUALITY[1]).when(quality == 0, QUALITY[0]).otherwise(NO_LABEL)
    return -F.log(u) / w


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, n_docs, target) from (source, size) rows. The windows without keys run
    over one row per source: a mixture names its sources, so that table is small by design."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (turn % len(WEIGHTS) + 1).cast("int"))
    t = per.withColumn("_w", weight).withColumn("_cap", F.lit(float(MOST_EPOCHS)) * F.col("source_size"))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    left = F.lit(SHARE) * F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    t = t.withColumn("_level", left / F.sum("_w").over(rest))
    # the level is that of the first source, in this order, that it does not reach
    t = t.withColumn("_water", F.min(F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.struct(F.col("_cap") / F.col("_w"), "_level"))).over(whole)["_level"])
    target = F.round(F.least("_cap", F.coalesce(F.col("_water") * F.col("_w"), F.col("_cap"))), 6)
    return t.select("source", "source_size", "n_docs", target.alias("target"))


def mix(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", bucket_rows: int = BUCKET_ROWS, keep_rows: bool = False) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken), one row per row of ``docs``; with
    ``keep_rows`` also the struct ``row`` of all its columns, written once with the sizes, so that rows
    which share an id each have their own number of copies.

    ``labels`` gives the quality weights as (doc_id, quality); a document labelled more than once
    counts its best label. ``copies`` is how often the mix holds the document."""
    spark = docs.sparkSession
    prepare(spark)
    kept = [F.struct(*[F.col(c) for c in docs.columns]).alias("row")] if keep_rows else []
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
                       (F.xxhash64(text_col) if keep_rows else F.lit(0)).alias("tie"), *kept)
    if labels is not None:
        best = labels.select(F.col("doc_id").alias("_l"), "quality").where("quality is not null").groupBy("_l").agg(F.max("quality").alias("_q"))
        best = bounded_broadcast(best) if keep_rows else best  # the texts stay where they are
        rows = rows.join(best, rows["doc_id"] == best["_l"], "left").drop("_l")
    else:
        rows = rows.withColumn("_q", F.lit(None).cast("int"))
    # texts are read once: what follows works on ids, sizes and keys
    kept = ["row"] if keep_rows else []
    rows = rows.select("doc_id", "source", "size", "tie", sampling_key(F.col("doc_id"), F.col("_q")).alias("key"), *kept).checkpoint(eager=True)
    targets = source_targets(rows.select("source", "size"))
    targets = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    targets = (targets.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
               .withColumn("slices", F.ceil(F.col("n_docs") / F.lit(float(bucket_rows))).cast("long"))
               .withColumnRenamed("source", "_s").checkpoint(eager=True))
    targets = bounded_broadcast(targets)
    x = rows.join(targets, rows["source"].eqNullSafe(targets["_s"])).drop("_s")
    # 1 - exp(-key) rises with the key and is uniform at weight 1
    x = x.withColumn("b", F.least(F.floor((1 - F.exp(-F.col("key"))) * F.col("slices")), F.col("slices") - 1).cast("long"))
    sums = x.groupBy("source", "b").agg(F.sum("size").alias("in_b"), F.first("rest").alias("rest"))
    upto = F.sum("in_b").over(Window.partitionBy("source").orderBy("b"))
    cuts = (sums.withColumn("before", upto - F.col("in_b")).where("before < rest")
            .groupBy("source").agg(F.max(F.struct("b", "before")).alias("cut"))
            .select(F.col("source").alias("_s"), F.col("cut.b").alias("cut_b"), F.col("cut.before").alias("before")).checkpoint(eager=True))
    cuts = bounded_broadcast(cuts)
    x = x.join(cuts, x["source"].eqNullSafe(cuts["_s"]), "left").drop("_s")
    sure = F.coalesce(F.col("b") < F.col("cut_b"), F.lit(False))
    here = F.coalesce(F.col("b") == F.col("cut_b"), F.lit(False))
    cols = ["doc_id", "source", "size", "source_size", "target", "epochs", *kept]
    settled = x.where(~here).select(*cols, F.when(sure, 1).otherwise(0).alias("extra"))
    w = Window.partitionBy("source").orderBy("key", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = F.col("before") + F.sum("size").over(w)
    # the document that crosses the rest stays if the sum with it is nearer
    near = (run <= F.col("rest")) | ((run - F.col("size") < F.col("rest")) & (run - F.col("rest") < F.col("rest") - (run - F.col("size"))))
    cut = x.where(here).select(*cols, F.when(near, 1).otherwise(0).alias("extra"))
    out = settled.unionByName(cut)
    copies = (F.col("epochs") + F.col("extra")).cast("long")
    return out.select("doc_id", "source", "size", "source_size", F.col("target").cast("double").alias("target"),
                      copies.alias("copies"), (copies * F.col("size")).alias("taken"), *kept)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
q AS (SELECT doc_id AS l, max(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY 1),
r AS (
  SELECT d.doc_id, d.source, d.size,
    -ln((CAST(('0x' || substr(md5('mix' || coalesce('|' || CAST(d.doc_id AS VARCHAR), '')), 1, 12)) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE)
      / (CASE q.q WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END) AS k
  FROM d LEFT JOIN q ON d.doc_id = q.l),
s0 AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    (ARRAY[3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM r GROUP BY source),
s1 AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(w) OVER (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s0),
s2 AS (
  SELECT *, (SELECT arg_min(level, cap / w) FROM s1 WHERE level * w <= cap) AS water FROM s1),
s3 AS (
  SELECT source, source_size, round(least(cap, coalesce(water * w, cap)), 6) AS target FROM s2),
s AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM s3),
x AS (
  SELECT r.*, s.source_size, s.target, s.epochs, s.target - s.epochs * s.source_size AS rest,
    sum(r.size) OVER (PARTITION BY r.source ORDER BY r.k, r.doc_id, r.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM r JOIN s ON r.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target,
  CAST((epochs + CASE WHEN run <= rest OR (run - size < rest AND run - rest < rest - (run - size)) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM x
"""
