"""DuckDB SQL for the derived fixtures, mirroring ``utterspark.sources.tables``.

Each constant is a list of CTE definitions to be placed after ``WITH``.
"""

from utterspark.functions.text import WHITESPACE_CODEPOINTS, ws_class

WS_SQL = "(" + " || ".join(f"chr({c})" for c in WHITESPACE_CODEPOINTS) + ")"
WS_CLASS = ws_class()

SHEET_ROWS = """
sheet_rows AS (
  SELECT 'dataset/' || fn AS path, fn AS file_name, row_pos, cell FROM (
    SELECT d.lang || '_validated_' || CASE WHEN l.quality = 0 THEN 'negative_' ELSE '' END
             || '20250310_' || d.source || '.xlsx' AS fn,
           CAST(d.doc_id AS BIGINT) AS row_pos, d.text AS cell
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id) s)"""

RAW_UTTERANCES = SHEET_ROWS + f""",
raw_utterances AS (
  SELECT NULLIF(trim(cell, {WS_SQL}), '') AS text,
         CASE WHEN strpos(file_name, '_negative_') > 0 THEN 'INVALID'
              ELSE split_part(file_name, '_validated_', 1) END AS intent,
         strpos(file_name, '_negative_') > 0 AS is_negative,
         path AS source_file, row_pos
  FROM sheet_rows)"""

UTTERANCES = RAW_UTTERANCES + """,
utterances AS (
  SELECT text, intent, is_negative, source_file, min(row_pos) AS row_pos
  FROM raw_utterances WHERE text IS NOT NULL
  GROUP BY source_file, text, intent, is_negative)"""

SPLIT = UTTERANCES + """,
keyed AS (
  SELECT *, md5('42' || '|' || source_file || '|' || CAST(row_pos AS VARCHAR)) AS shuffle_key
  FROM utterances),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY shuffle_key, source_file, row_pos) AS rank,
         count(*) OVER () AS n_all
  FROM keyed),
corpus_split AS (
  SELECT *, CASE WHEN rank <= floor(n_all * CAST(0.7 AS DOUBLE)) THEN 'train'
                 WHEN rank <= floor(n_all * CAST(0.7 AS DOUBLE)) + floor(n_all * CAST(0.15 AS DOUBLE)) THEN 'valid'
                 ELSE 'test' END AS split
  FROM ranked),
label_dict AS (
  SELECT label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS idx
  FROM (SELECT DISTINCT intent AS label FROM corpus_split WHERE split = 'train') t)"""


def scored_sql(scale: float = 128.0) -> str:
    """CTEs: cells, centroid, logit (vec_id, y, c, z), prob (+ p), pred (pred_idx, p_max), names."""
    return f"""
cells AS (
  SELECT vec_id, CAST(label AS INTEGER) AS y, unnest(embedding) AS v,
         generate_subscripts(embedding, 1) - 1 AS dim
  FROM embeddings),
centroid AS (SELECT y AS c, dim, avg(CAST(v AS DOUBLE)) AS m FROM cells GROUP BY y, dim),
logit AS (
  SELECT x.vec_id, x.y, m.c, sum(CAST(x.v AS DOUBLE) * m.m) * {float(scale)!r} AS z
  FROM cells x JOIN centroid m ON x.dim = m.dim GROUP BY x.vec_id, x.y, m.c),
soft AS (SELECT *, exp(z - max(z) OVER (PARTITION BY vec_id)) AS e FROM logit),
prob AS (SELECT vec_id, y, c, z, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM soft),
pmax AS (SELECT vec_id, max(p) AS p_max FROM prob GROUP BY vec_id),
pred AS (
  SELECT pr.vec_id, pr.y, CAST(min(pr.c) AS INTEGER) AS pred_idx, any_value(m.p_max) AS p_max
  FROM prob pr JOIN pmax m ON pr.vec_id = m.vec_id AND pr.p = m.p_max GROUP BY pr.vec_id, pr.y),
names AS (
  SELECT label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS idx FROM (
    SELECT DISTINCT CASE WHEN label = 4 THEN 'INVALID' WHEN label < 4 THEN 'Class_' || lpad(CAST(label AS VARCHAR), 6, '0')
                         ELSE 'class_' || lpad(CAST(label AS VARCHAR), 6, '0') END AS label
    FROM embeddings) t)"""


def evaluated_sql() -> str:
    """scored_sql() plus ``evaluated (vec_id, y, pred_idx, k)`` with the threshold rule."""
    return scored_sql() + """,
evaluated AS (
  SELECT vec_id, y, pred_idx,
         CASE WHEN p_max < 0.6 THEN (SELECT idx FROM names WHERE label = 'INVALID') ELSE pred_idx END AS k
  FROM pred),
cm AS (SELECT y, k, count(*) AS n FROM evaluated GROUP BY y, k),
cls AS (
  SELECT c, coalesce(max(tp), 0) AS tp, coalesce(max(n_true), 0) AS n_true, coalesce(max(n_pred), 0) AS n_pred
  FROM (SELECT y AS c, NULL AS tp, sum(n) AS n_true, NULL AS n_pred FROM cm GROUP BY y
        UNION ALL SELECT k, NULL, NULL, sum(n) FROM cm GROUP BY k
        UNION ALL SELECT y, n, NULL, NULL FROM cm WHERE y = k) u
  GROUP BY c),
pc AS (
  SELECT c, tp, n_true AS support,
         CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
         CASE WHEN n_true > 0 THEN tp / n_true ELSE 0.0 END AS recall
  FROM cls),
pcf AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END
            AS f1_score FROM pc)"""


def scored_split_sql() -> str:
    """scored_sql() plus ``split_s (vec_id, y, rank, split, batch_id)``."""
    return scored_sql() + """,
ranked_s AS (
  SELECT vec_id, y, row_number() OVER (ORDER BY md5('42|' || CAST(vec_id AS VARCHAR)), vec_id) AS rank,
         count(*) OVER () AS n_all
  FROM pred),
split0 AS (
  SELECT *, CASE WHEN rank <= floor(n_all * CAST(0.7 AS DOUBLE)) THEN 'train'
                 WHEN rank <= floor(n_all * CAST(0.7 AS DOUBLE)) + floor(n_all * CAST(0.15 AS DOUBLE)) THEN 'valid'
                 ELSE 'test' END AS split
  FROM ranked_s),
split_s AS (
  SELECT *, CAST(floor((row_number() OVER (PARTITION BY split ORDER BY rank) - 1) / 32) AS BIGINT) AS batch_id
  FROM split0),
lse AS (SELECT vec_id, max(z) AS m FROM logit GROUP BY vec_id),
lse2 AS (SELECT l.vec_id, ln(sum(exp(l.z - m.m))) + any_value(m.m) AS lse
         FROM logit l JOIN lse m ON l.vec_id = m.vec_id GROUP BY l.vec_id),
row_loss AS (SELECT l.vec_id, x.lse - l.z AS loss FROM logit l JOIN lse2 x ON l.vec_id = x.vec_id WHERE l.c = l.y),
eval_rows AS (
  SELECT s.vec_id, s.y, s.split, s.batch_id, p.pred_idx, r.loss,
         CASE WHEN p.p_max < 0.6 THEN (SELECT idx FROM names WHERE label = 'INVALID') ELSE p.pred_idx END AS k,
         CASE WHEN s.y = (SELECT idx FROM names WHERE label = 'INVALID') THEN 1.5 ELSE 1.0 END AS w
  FROM split_s s JOIN pred p ON s.vec_id = p.vec_id JOIN row_loss r ON s.vec_id = r.vec_id),
ep AS (
  SELECT r.*, e.epoch,
         CAST(('0x' || substr(md5(CAST(e.epoch AS VARCHAR) || '|' || CAST(r.vec_id AS VARCHAR)), 1, 4)) AS BIGINT) % 10 AS u
  FROM eval_rows r, range(1, 6) e(epoch)),
hist_rows AS (
  SELECT epoch, split, batch_id, loss / epoch AS loss, w,
         (CASE WHEN u < [2, 5, 7, 7, 6][epoch] THEN y ELSE pred_idx END) = y AS correct
  FROM ep),
hb AS (
  SELECT epoch, split, batch_id, avg(loss) * avg(w) AS weighted_loss, avg(loss) AS mean_loss,
         avg(CASE WHEN correct THEN 1.0 ELSE 0.0 END) AS mean_acc
  FROM hist_rows GROUP BY epoch, split, batch_id),
history AS (
  SELECT epoch,
         avg(CASE WHEN split = 'train' THEN weighted_loss END) AS train_loss,
         avg(CASE WHEN split = 'train' THEN mean_acc END) AS train_acc,
         avg(CASE WHEN split = 'valid' THEN mean_loss END) AS valid_loss,
         avg(CASE WHEN split = 'valid' THEN mean_acc END) AS valid_acc
  FROM hb GROUP BY epoch)"""
