"""Corpus pipeline over ``documents``: language ID, toxicity, near duplicates, mixing, byte-level BPE.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and reread as the next one's ``docs``. All but the last return the columns of
documents. ``run`` applies them in the shared checkpoint folder.

Stage by stage: documents without a letter are rejected (language ``und``); documents scored toxic
(0.7 or more) are rejected; of each component of five-word shingle sets with a Jaccard similarity of
0.8 or more the row with the smallest doc_id stays; the mix keeps a document as many times as it takes it (0, 1 or
2); the last stage returns the ids of what is left. To the near-duplicate stage rows that repeat a
doc_id and its text are one document, and rows that share a doc_id but hold other texts are several.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterspark.llm import bpe, langid, mixing, ngram_join, toxicity
from utterspark.llm.common import bounded_broadcast, prepare, table, unused
from utterspark.llm.queries import vocabulary_path
from utterspark.session import scratch_path

NEAR_WORDS, NEAR_NUM, NEAR_DEN = 5, 80, 100
TOXIC_FROM = 0.7


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents that have no language: null texts and texts without a letter."""
    model = langid.fit(docs)
    if not model.langs:  # no labelled row: nothing was learnt, and that is no reason to reject a text
        return langid.with_letters(docs)
    tag = unused(docs, "lang")
    out = langid.predict(docs, model, out=tag)
    return out.where(F.col(f"{tag}.lang") != langid.UNKNOWN).select(*docs.columns)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents that score as toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    tag = unused(docs, "tox")
    out = toxicity.predict(docs, model, out=tag)
    return out.where(F.col(f"{tag}.score") < TOXIC_FROM).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each component of similar texts: the smallest by (doc_id, digest of the text)."""
    # a node per doc_id and text: rows that share an id but hold other texts are other documents
    node, at, k = unused(docs, "node"), unused(docs, "at"), unused(docs, "k")
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.col("text").isNull(), "text"))
    d = docs.withColumn(node, key)
    found = ngram_join.jaccard_components(d.select(node, "text"), id_col=node, words=NEAR_WORDS, num=NEAR_NUM, den=NEAR_DEN)
    found = found.where("doc_id is not null").select(F.col("doc_id").alias(at), "component_id").distinct().checkpoint(eager=True)
    several = found.where(F.col("component_id") != F.col(at)).select("component_id").distinct()
    members = found.join(several, "component_id").checkpoint(eager=True)
    ranked = d.select(node, "doc_id", F.sha2("text", 256).alias("text")).join(bounded_broadcast(members), F.col(node) == F.col(at))
    first = ranked.groupBy("component_id").agg(F.min(F.struct("doc_id", "text", at))[at].alias(at))
    gone = members.join(first, at, "left_anti").select(at).checkpoint(eager=True)
    out = d.join(bounded_broadcast(gone), F.col(node) == F.col(at), "left_anti")
    # rows that repeat a doc_id and text: only those are grouped, the rest stays where it is
    again = d.where(F.col(node).isNotNull()).groupBy(F.col(node).alias(at)).agg(F.count(F.lit(1)).alias(k)).where(F.col(k) > 1).select(at).checkpoint(eager=True)
    hint = bounded_broadcast(again)
    single = out.join(hint, F.col(node) == F.col(at), "left_anti").select(*docs.columns)
    whole = F.struct(*docs.columns)
    twice = out.join(hint, F.col(node) == F.col(at), "left_semi").groupBy(node).agg(F.min_by(whole, F.sha2(F.to_json(whole), 256)).alias(k))
    return single.unionByName(twice.select(f"{k}.*"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as many times as the mix takes it, rows that share a doc_id each by their own number."""
    plan = mixing.mix(docs, table(spark, sf_dir, "labels"), keep_rows=True).where("copies > 0")
    again = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return plan.select("row", again).select(*[F.col("row")[c].alias(c) for c in docs.columns])


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, packed ids, and whether decoding gave the text back."""
    shared = bpe.codec(spark, vocabulary_path())
    out = bpe.decode(bpe.encode(docs.select("doc_id", "text"), shared), shared)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("mixing", mix_sources),
    ("byte_bpe", byte_bpe),
]
ORACLE_SQL = None  # fitted models and components: tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
