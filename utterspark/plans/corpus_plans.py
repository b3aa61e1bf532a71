"""Corpus plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from utterspark.functions.text import clean_text, strip_punct
from utterspark.operators import corpus as C
from utterspark.plans.registry import register
from utterspark.plans.sql_fixtures import RAW_UTTERANCES, SHEET_ROWS, UTTERANCES, WS_CLASS, WS_SQL
from utterspark.sources.tables import sheet_rows, table, utterances


def _md5_text(c):
    return F.md5(F.col(c)).alias(f"{c}_md5")


@register("intent_distribution", f"""
WITH {UTTERANCES},
pooled AS (SELECT DISTINCT text, intent, is_negative FROM utterances)
SELECT intent, is_negative, CAST(count(*) AS BIGINT) AS n FROM pooled GROUP BY intent, is_negative
""")
def intent_distribution(spark, sf_dir):
    """Flagship slice: sheets -> clean -> drop blank -> pooled dedup -> counts."""
    return C.intent_distribution(C.dedup(utterances(spark, sf_dir), scope="intent"))


@register("file_counts", f"""
WITH {UTTERANCES}
SELECT source_file, CAST(count(*) AS BIGINT) AS n_rows FROM utterances GROUP BY source_file
""")
def file_counts(spark, sf_dir):
    return C.file_counts(utterances(spark, sf_dir))


@register("polarity", f"""
WITH {SHEET_ROWS}
SELECT file_name, strpos(file_name, '_negative_') > 0 AS is_negative, CAST(count(*) AS BIGINT) AS n_rows
FROM sheet_rows GROUP BY file_name
""")
def polarity(spark, sf_dir):
    rows = C.with_polarity(sheet_rows(spark, sf_dir))
    return rows.groupBy("file_name", "is_negative").agg(F.count(F.lit(1)).alias("n_rows"))


@register("intent_from_name", f"""
WITH {SHEET_ROWS}
SELECT DISTINCT file_name, split_part(file_name, '_validated_', 1) AS intent FROM sheet_rows
""")
def intent_from_name(spark, sf_dir):
    return C.with_intent(sheet_rows(spark, sf_dir).select("file_name").distinct())


@register("intent_from_name_legacy", f"""
WITH {SHEET_ROWS}
SELECT DISTINCT path,
  array_to_string(string_split(path, '_')[1:greatest(len(string_split(path, '_')) - 3, 0)], '_') AS intent
FROM sheet_rows
""")
def intent_from_name_legacy(spark, sf_dir):
    return C.with_intent(sheet_rows(spark, sf_dir).select("path").distinct(), "path", "drop_last_3")


@register("clean_text", f"""
SELECT doc_id, md5(NULLIF(trim(text, {WS_SQL}), '')) AS text_md5,
       length(NULLIF(trim(text, {WS_SQL}), '')) AS n_chars
FROM documents
""")
def clean_text_plan(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", clean_text("text").alias("text"))
    return d.select("doc_id", _md5_text("text"), F.length("text").alias("n_chars"))


@register("drop_blank", f"""
WITH {RAW_UTTERANCES}
SELECT source_file, row_pos, md5(text) AS text_md5 FROM raw_utterances WHERE text IS NOT NULL
""")
def drop_blank(spark, sf_dir):
    return (C.to_utterances(sheet_rows(spark, sf_dir))
            .select("source_file", "row_pos", _md5_text("text")))


@register("drop_blank_sentinel", f"""
WITH {SHEET_ROWS},
s AS (SELECT path, row_pos, coalesce(NULLIF(trim(cell, {WS_SQL}), ''), 'unknown') AS text FROM sheet_rows)
SELECT path AS source_file, row_pos, md5(text) AS text_md5 FROM s WHERE text <> 'unknown'
""")
def drop_blank_sentinel(spark, sf_dir):
    rows = sheet_rows(spark, sf_dir).select(
        F.col("path").alias("source_file"), "row_pos", clean_text("cell").alias("text"))
    return C.drop_blank(rows, sentinel="unknown").select("source_file", "row_pos", _md5_text("text"))


@register("to_utterances", f"""
WITH {SHEET_ROWS}
SELECT path AS source_file, row_pos, split_part(file_name, '_validated_', 1) AS intent,
       strpos(file_name, '_negative_') > 0 AS is_negative,
       md5(NULLIF(trim(cell, {WS_SQL}), '')) AS text_md5
FROM sheet_rows WHERE NULLIF(trim(cell, {WS_SQL}), '') IS NOT NULL
""")
def to_utterances(spark, sf_dir):
    u = C.to_utterances(sheet_rows(spark, sf_dir), relabel=False)
    return u.select("source_file", "row_pos", "intent", "is_negative", _md5_text("text"))


@register("relabel_negatives", f"""
WITH {RAW_UTTERANCES}
SELECT intent, is_negative, CAST(count(*) AS BIGINT) AS n
FROM raw_utterances WHERE text IS NOT NULL GROUP BY intent, is_negative
""")
def relabel_negatives(spark, sf_dir):
    u = C.relabel_negatives(C.to_utterances(sheet_rows(spark, sf_dir), relabel=False))
    return u.groupBy("intent", "is_negative").agg(F.count(F.lit(1)).alias("n"))


@register("strip_punct", f"""
SELECT doc_id, md5(regexp_replace(text, '[^\\p{{L}}\\p{{M}}\\p{{N}}{WS_CLASS}]', '', 'g')) AS text_md5,
       length(regexp_replace(text, '[^\\p{{L}}\\p{{M}}\\p{{N}}{WS_CLASS}]', '', 'g')) AS n_chars
FROM documents
""")
def strip_punct_plan(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", strip_punct("text").alias("text"))
    return d.select("doc_id", _md5_text("text"), F.length("text").alias("n_chars"))


@register("valid_inputs", f"""
SELECT conv_id, turn, md5(NULLIF(trim(text, {WS_SQL}), '')) AS text_md5
FROM conversations WHERE role = 'user' AND NULLIF(trim(text, {WS_SQL}), '') IS NOT NULL
""")
def valid_inputs(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    return C.valid_inputs(conv.select("conv_id", "turn", "text")).select(
        "conv_id", "turn", _md5_text("text"))


@register("union_corpus", f"""
WITH {UTTERANCES}
SELECT source_file, row_pos, intent, is_negative, md5(text) AS text_md5 FROM utterances WHERE NOT is_negative
UNION ALL
SELECT source_file, row_pos, intent, is_negative, md5(text) AS text_md5 FROM utterances WHERE is_negative
""")
def union_corpus(spark, sf_dir):
    u = utterances(spark, sf_dir)
    both = C.build_corpus(u.filter(~F.col("is_negative")), u.filter(F.col("is_negative")))
    return both.select("source_file", "row_pos", "intent", "is_negative", _md5_text("text"))


@register("dedup_per_file", f"""
WITH {UTTERANCES}
SELECT source_file, row_pos, intent, is_negative, md5(text) AS text_md5 FROM utterances
""")
def dedup_per_file(spark, sf_dir):
    return utterances(spark, sf_dir).select(
        "source_file", "row_pos", "intent", "is_negative", _md5_text("text"))


@register("dedup_per_intent", f"""
WITH {UTTERANCES}
SELECT intent, is_negative, md5(text) AS text_md5,
       arg_min(source_file, (source_file, row_pos)) AS source_file,
       arg_min(row_pos, (source_file, row_pos)) AS row_pos
FROM utterances GROUP BY text, intent, is_negative
""")
def dedup_per_intent(spark, sf_dir):
    d = C.dedup(utterances(spark, sf_dir), scope="intent")
    return d.select("intent", "is_negative", _md5_text("text"), "source_file", "row_pos")


# Derived fixture: two independent scorers per utterance; score = an md5 digit
# rule in 0..5, missing (NULL) for scorer 2 when a further digit rule says so.
def _scores(u):
    scorers = F.explode(F.array(F.lit(1), F.lit(2))).alias("scorer")
    s = u.select(*C.UTTERANCE_KEY, scorers)
    h = F.md5(F.concat_ws("|", F.col("text"), F.col("intent"), F.col("scorer").cast("string")))
    score = F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % 6
    missing = (F.col("scorer") == 2) & (F.conv(F.substring(h, 9, 2), 16, 10).cast("int") % 10 == 0)
    return s.withColumn("score", F.when(missing, F.lit(None)).otherwise(score))


SCORES_SQL = """,
scorers AS (SELECT u.text, u.intent, u.is_negative, s.scorer,
                   md5(u.text || '|' || u.intent || '|' || CAST(s.scorer AS VARCHAR)) AS h
            FROM (SELECT DISTINCT text, intent, is_negative FROM utterances) u,
                 (SELECT 1 AS scorer UNION ALL SELECT 2) s),
scores AS (SELECT text, intent, is_negative, scorer,
                  CASE WHEN scorer = 2 AND CAST(('0x' || substr(h, 9, 2)) AS BIGINT) % 10 = 0 THEN NULL
                       ELSE CAST(('0x' || substr(h, 1, 8)) AS BIGINT) % 6 END AS score
           FROM scorers)"""


@register("accept_scored", f"""
WITH {UTTERANCES}{SCORES_SQL},
ok AS (SELECT text, intent, is_negative FROM scores GROUP BY text, intent, is_negative
       HAVING count(score) = 2
          AND min(score) > CASE WHEN is_negative THEN 2 ELSE 3 END)
SELECT u.source_file, u.row_pos, u.intent, u.is_negative, md5(u.text) AS text_md5
FROM utterances u SEMI JOIN ok ON u.text = ok.text AND u.intent = ok.intent AND u.is_negative = ok.is_negative
""")
def accept_scored(spark, sf_dir):
    u = utterances(spark, sf_dir)
    scores = _scores(u.select(*C.UTTERANCE_KEY).distinct())
    return C.accept_scored(u, scores).select(
        "source_file", "row_pos", "intent", "is_negative", _md5_text("text"))


@register("increment_corpus", f"""
WITH {UTTERANCES},
batch AS (SELECT NULLIF(trim(text, {WS_SQL}), '') AS text, 'benchmark' AS intent, false AS is_negative,
                 'benchmark' AS source_file, CAST(item_id AS BIGINT) AS row_pos
          FROM benchmark WHERE NULLIF(trim(text, {WS_SQL}), '') IS NOT NULL),
grown AS (
  SELECT * FROM utterances
  UNION ALL
  SELECT b.* FROM batch b ANTI JOIN utterances u
    ON b.text = u.text AND b.intent = u.intent AND b.is_negative = u.is_negative)
SELECT source_file, row_pos, intent, is_negative, md5(text) AS text_md5 FROM grown
""")
def increment_corpus(spark, sf_dir):
    u = utterances(spark, sf_dir)
    batch = C.valid_inputs(table(spark, sf_dir, "benchmark"), "text").select(
        "text", F.lit("benchmark").alias("intent"), F.lit(False).alias("is_negative"),
        F.lit("benchmark").alias("source_file"), F.col("item_id").cast("long").alias("row_pos"))
    return C.increment(u, batch).select(
        "source_file", "row_pos", "intent", "is_negative", _md5_text("text"))
