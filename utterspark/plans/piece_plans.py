"""Sub-word id plans: the pieces of a public vocabulary, whose path is a parameter."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from utterspark.functions.text import tokenize_mixed
from utterspark.operators import pieces as P
from utterspark.plans.registry import register
from utterspark.plans.split_plans import corpus_split
from utterspark.plans.sql_fixtures import SPLIT
from utterspark.sources.tables import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"

WORDS_SQL = "regexp_extract_all(regexp_replace(text, '(\\p{Han})', ' \\1 ', 'g'), '[\\p{L}\\p{M}\\p{N}]+', 0)"


def pieces_sql(source: str) -> str:
    """CTEs: ``word_pieces`` (w, k, id), the pieces of every distinct word of ``source`` (w)."""
    return f"""
tokens AS (
  SELECT TRY(decode(from_base64(split_part(l, ' ', 1)))) AS t, CAST(split_part(l, ' ', 2) AS BIGINT) AS rank
  FROM (SELECT unnest(string_split(content, chr(10))) AS l FROM read_text('{public_tokenizers.path(VOCABULARY)}')) f WHERE l <> ''),
pieces AS (
  SELECT CASE WHEN starts_with(t, ' ') THEN substr(t, 2) ELSE t END AS piece, NOT starts_with(t, ' ') AS continues, min(rank) + 4 AS id
  FROM tokens WHERE t IS NOT NULL GROUP BY ALL),
words AS (SELECT DISTINCT w FROM {source}),
longest AS (
  SELECT w, s, max(n) AS n, arg_max(id, n) AS id FROM (
    SELECT w, s, unnest(generate_series(1, least(length(w) - s + 1, (SELECT max(length(piece)) FROM pieces)))) AS n
    FROM (SELECT w, unnest(generate_series(1, length(w))) AS s FROM words WHERE length(w) <= 100) a) b
  JOIN pieces ON piece = substr(w, s, n) AND continues = (s > 1) WHERE piece <> '' GROUP BY w, s),
walk AS (
  SELECT w, 1 AS s, 0 AS k, CAST(NULL AS BIGINT) AS id FROM words
  UNION ALL SELECT l.w, CAST(l.s + l.n AS INTEGER), k + 1, l.id FROM walk JOIN longest l ON l.w = walk.w AND l.s = walk.s),
whole AS (SELECT w FROM walk WHERE s = length(w) + 1),
word_pieces AS (
  SELECT w, k, id FROM walk JOIN whole USING (w) WHERE k > 0
  UNION ALL SELECT w, 1, 1 FROM words WHERE w NOT IN (SELECT w FROM whole))"""


def trie(spark):
    return P.piece_trie(P.read_pieces(spark, public_tokenizers.path(VOCABULARY)))


@register("piece_counts", f"""
WITH RECURSIVE occ AS (SELECT unnest({WORDS_SQL}) AS w FROM documents),
{pieces_sql("occ")}
SELECT id, count(*) AS n FROM occ JOIN word_pieces USING (w) GROUP BY id
""")
def piece_counts(spark, sf_dir):
    """How often every piece occurs in all documents."""
    docs = table(spark, sf_dir, "documents").select("text")
    return P.piece_counts(docs, tokenize_mixed("text"), trie(spark))


@register("encode_pieces", f"""
WITH RECURSIVE {SPLIT.strip()},
occ AS (
  SELECT source_file, row_pos, unnest(t) AS w, generate_subscripts(t, 1) AS word_no
  FROM (SELECT source_file, row_pos, {WORDS_SQL}[1:62] AS t FROM corpus_split) x),
{pieces_sql("occ")},
placed AS (
  SELECT source_file, row_pos, id, row_number() OVER (PARTITION BY source_file, row_pos ORDER BY word_no, k) AS pos
  FROM occ JOIN word_pieces USING (w)),
cut AS (SELECT source_file, row_pos, pos, id FROM placed WHERE pos <= 62),
size AS (
  SELECT s.source_file, s.row_pos, coalesce(max(pos), 0) AS n
  FROM corpus_split s LEFT JOIN cut c ON s.source_file = c.source_file AND s.row_pos = c.row_pos GROUP BY ALL),
grid AS (SELECT *, unnest(range(0, (SELECT max(n) FROM size) + 2)) AS pos FROM size)
SELECT g.source_file, g.row_pos, CAST(g.pos AS INTEGER) AS pos,
       CASE WHEN g.pos = 0 THEN 2 WHEN g.pos = g.n + 1 THEN 3 ELSE coalesce(c.id, 0) END AS input_id,
       CASE WHEN g.pos <= g.n + 1 THEN 1 ELSE 0 END AS attention_mask
FROM grid g LEFT JOIN cut c ON g.source_file = c.source_file AND g.row_pos = c.row_pos AND g.pos = c.pos
""")
def encode_pieces(spark, sf_dir):
    """Begin, pieces and end of every utterance, cut to 64 ids and padded to the longest."""
    enc = P.encode_pieces(corpus_split(spark, sf_dir), ["source_file", "row_pos"], tokenize_mixed("text"), trie(spark))
    e = enc.select("source_file", "row_pos", F.posexplode(F.arrays_zip("input_ids", "attention_mask")).alias("pos", "z"))
    return e.select("source_file", "row_pos", F.col("pos").cast("int").alias("pos"), F.col("z.input_ids").alias("input_id"),
                    F.col("z.attention_mask").cast("int").alias("attention_mask"))
