"""Shuffle, rank, split, label dictionary and batching plans
(SURVEY 2.6 R1-R3, 2.7 E1-E2, 2.4 J1-J2-J4, 2.10 A2, 2.3 T5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from utterspark.operators import corpus as C
from utterspark.operators import labels as L
from utterspark.operators import split as S
from utterspark.operators.ranking import global_rank, hashed_rank
from utterspark.plans.registry import register
from utterspark.plans.sql_fixtures import SHEET_ROWS, SPLIT, UTTERANCES, WS_SQL
from utterspark.sources.tables import sheet_rows, utterances


def corpus_split(spark, sf_dir):
    return S.split_corpus(utterances(spark, sf_dir))


@register("split_selection", f"""
WITH {SPLIT}
SELECT source_file, row_pos, split FROM corpus_split
""")
def split_selection(spark, sf_dir):
    """The same split by selecting the two rows where it changes."""
    return S.split_by_selection(utterances(spark, sf_dir)).select("source_file", "row_pos", "split")


def train_labels(split_df):
    return L.fit_labels(split_df.filter(F.col("split") == "train"))


@register("shuffle_order", f"""
WITH {UTTERANCES}
SELECT source_file, row_pos, md5('42' || '|' || source_file || '|' || CAST(row_pos AS VARCHAR)) AS shuffle_key
FROM utterances
""")
def shuffle_order(spark, sf_dir):
    return S.with_shuffle_key(utterances(spark, sf_dir)).select("source_file", "row_pos", "shuffle_key")


@register("global_rank", f"""
WITH {SPLIT}
SELECT source_file, row_pos, rank FROM ranked
""")
def global_rank_plan(spark, sf_dir):
    keyed = S.with_shuffle_key(utterances(spark, sf_dir))
    return global_rank(keyed, ["shuffle_key", "source_file", "row_pos"], size_col=None).select(
        "source_file", "row_pos", "rank")


@register("hashed_rank", f"""
WITH {SPLIT}
SELECT source_file, row_pos, rank FROM ranked
""")
def hashed_rank_plan(spark, sf_dir):
    """The same exact rank by md5 key, with buckets computed from the key."""
    keyed = S.with_shuffle_key(utterances(spark, sf_dir))
    return hashed_rank(keyed, "shuffle_key", ["source_file", "row_pos"], size_col=None).select(
        "source_file", "row_pos", "rank")


@register("split_corpus", f"""
WITH {SPLIT}
SELECT source_file, row_pos, rank, split FROM corpus_split
""")
def split_corpus(spark, sf_dir):
    return corpus_split(spark, sf_dir).select("source_file", "row_pos", "rank", "split")


@register("split_sizes", f"""
WITH {SPLIT}
SELECT split, CAST(count(*) AS BIGINT) AS n FROM corpus_split GROUP BY split
""")
def split_sizes(spark, sf_dir):
    return corpus_split(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@register("fit_labels", f"""
WITH {SPLIT}
SELECT label, idx FROM label_dict
""")
def fit_labels(spark, sf_dir):
    return train_labels(corpus_split(spark, sf_dir))


@register("class_list", f"""
WITH {SPLIT}
SELECT CAST(count(*) AS BIGINT) AS n_classes, string_agg(label, '|' ORDER BY label) AS classes FROM label_dict
""")
def class_list(spark, sf_dir):
    c = L.class_list(train_labels(corpus_split(spark, sf_dir)))
    return c.select("n_classes", F.array_join("classes", "|").alias("classes"))


@register("encode_labels", f"""
WITH {SPLIT}
SELECT s.source_file, s.row_pos, s.split, s.intent, d.idx AS label_idx
FROM corpus_split s LEFT JOIN label_dict d ON s.intent = d.label
""")
def encode_labels(spark, sf_dir):
    s = corpus_split(spark, sf_dir)
    enc = L.encode_labels(s, train_labels(s), unseen="error")
    return enc.select("source_file", "row_pos", "split", "intent", "label_idx")


@register("decode_labels", f"""
WITH {SPLIT}
SELECT s.source_file, s.row_pos, d2.label AS pred_label
FROM corpus_split s JOIN label_dict d ON s.intent = d.label JOIN label_dict d2 ON d.idx = d2.idx
""")
def decode_labels(spark, sf_dir):
    s = corpus_split(spark, sf_dir)
    labels = train_labels(s)
    enc = L.encode_labels(s, labels, unseen="skip").withColumnRenamed("label_idx", "pred_idx")
    return L.decode_labels(enc, labels).select("source_file", "row_pos", "pred_label")


@register("label_mapping", f"""
WITH {SPLIT}
SELECT CAST(idx AS VARCHAR) AS key, label FROM label_dict
""")
def label_mapping(spark, sf_dir):
    return L.label_mapping(train_labels(corpus_split(spark, sf_dir)))


@register("batch_ids", f"""
WITH {SPLIT}
SELECT source_file, row_pos, split,
       CAST(floor((row_number() OVER (PARTITION BY split ORDER BY rank) - 1) / 32) AS BIGINT) AS batch_id
FROM corpus_split
""")
def batch_ids(spark, sf_dir):
    b = S.with_batch_id(corpus_split(spark, sf_dir))
    return b.select("source_file", "row_pos", "split", "batch_id")


@register("cross_split_duplicates", f"""
WITH {SPLIT}
SELECT md5(text) AS text_md5, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT split) AS BIGINT) AS n_splits,
       CAST(count(DISTINCT intent) AS BIGINT) AS n_intents
FROM corpus_split GROUP BY text HAVING count(DISTINCT split) > 1 OR count(DISTINCT intent) > 1
""")
def cross_split_duplicates(spark, sf_dir):
    d = C.cross_split_duplicates(corpus_split(spark, sf_dir))
    return d.select(F.md5("text").alias("text_md5"), "n_rows", "n_splits", "n_intents")


def _legacy_sql(intent_sql: str) -> str:
    return f"""
WITH {SHEET_ROWS},
legacy_raw AS (
  SELECT coalesce(NULLIF(trim(cell, {WS_SQL}), ''), 'unknown') AS text, {intent_sql} AS intent,
         path AS source_file, row_pos
  FROM sheet_rows WHERE strpos(path, '_negative_') = 0),
legacy AS (
  SELECT text, intent, source_file, min(row_pos) AS row_pos FROM legacy_raw
  WHERE text <> 'unknown' GROUP BY source_file, text, intent),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5('42' || '|' || source_file || '|' || CAST(row_pos AS VARCHAR)),
                                        source_file, row_pos) AS rank,
         count(*) OVER () AS n_all
  FROM legacy)
SELECT source_file, row_pos, intent, rank,
       CASE WHEN rank <= floor(n_all * CAST(0.7 AS DOUBLE)) THEN 'train'
            WHEN rank <= floor(n_all * CAST(0.7 AS DOUBLE)) + floor(n_all * CAST(0.15 AS DOUBLE)) THEN 'valid'
            ELSE 'test' END AS split
FROM ranked
"""


def positive_corpus_split(spark, sf_dir, intent_rule: str):
    """Positive-only corpus of the older flows, de-duplicated per file, split."""
    u = C.dedup(C.to_legacy_utterances(sheet_rows(spark, sf_dir), intent_rule=intent_rule), scope="file")
    return S.split_corpus(u)


@register("legacy_corpus", _legacy_sql(
    "array_to_string(string_split(path, '_')[1:greatest(len(string_split(path, '_')) - 3, 0)], '_')"))
def legacy_corpus(spark, sf_dir):
    """The first version's corpus end to end: positive sheets only, intent from
    the path (last three ``_`` pieces dropped), sentinel cleaning, per-file
    dedup, then the exact 70/15/15 split."""
    return positive_corpus_split(spark, sf_dir, "drop_last_3").select(
        "source_file", "row_pos", "intent", "rank", "split")


@register("embedding_corpus", _legacy_sql("split_part(file_name, '_validated_', 1)"))
def embedding_corpus(spark, sf_dir):
    """The embedding flow's corpus: positive sheets only, intent from the file
    name before ``_validated_``, sentinel cleaning, per-file dedup, split."""
    return positive_corpus_split(spark, sf_dir, "validated").select(
        "source_file", "row_pos", "intent", "rank", "split")
