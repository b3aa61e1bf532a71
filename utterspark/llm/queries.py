"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterspark.llm import bpe, cross_polytope, host_paths, importance, langid, mixing, ngram_join, order_minhash, revisits, spelling, token_spans, toxicity, winnowing
from utterspark.llm.common import crc_mod, prepare, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(table(spark, sf_dir, "documents"))


def op2_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.search(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.where(~held_out))
    out = langid.predict(docs.select("doc_id", "text"), model, out="p")
    return out.select("doc_id", held_out.alias("held_out"), F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = revisits.resolve(revisits.captures_of(table(spark, sf_dir, "pages")))
    lines = F.array_join(F.transform("headers", lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
    return out.withColumn("headers", lines)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    shared = bpe.codec(spark, vocabulary_path())
    out = bpe.decode(bpe.encode(docs, shared).drop("text"), shared)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_spans.section_tokens(table(spark, sf_dir, "documents"), bpe.codec(spark, vocabulary_path()))


def op8_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = host_paths.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"), out="text")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    docs = docs.select("doc_id", "text")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    model = toxicity.fit(docs, labels.where(~held_out))
    out = toxicity.predict(docs, model, out="t")
    return out.select("doc_id", held_out.alias("held_out"), F.col("t.score").alias("score"),
                      (F.col("t.score") >= 0.7).cast("int").alias("predicted"), F.col("t.evidence").alias("evidence"))


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = winnowing.contaminated_words(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (
    op1_order_minhash, op2_cross_polytope, op3_language_id, op4_ngram_jaccard, op5_warc_revisits,
    op6_byte_bpe, op7_token_spans, op8_host_paths, op9_mixing, op10_toxicity, op11_winnowing, op12_importance_resampling, op13_spelling_variants)}
ORACLES = {"op5_warc_revisits": revisits.ORACLE, "op9_mixing": mixing.ORACLE, "op11_winnowing": winnowing.ORACLE, "op12_importance_resampling": importance.ORACLE, "op13_spelling_variants": spelling.ORACLE}
