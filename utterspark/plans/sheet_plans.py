"""Spreadsheet plans: the labelled sheets derived from the
tables are written as real .xlsx files by a Spark job, then listed, parsed
and checked exactly as a corpus directory would be."""

from __future__ import annotations

from pyspark.sql import functions as F

from utterspark.operators import corpus as C
from utterspark.plans.registry import register
from utterspark.plans.sql_fixtures import SHEET_ROWS, WS_SQL
from utterspark.session import materialize, scratch_path
from utterspark.sources.sheets import NA_STRINGS, corpus_files, read_sheets, split_rejects, write_sheets
from utterspark.sources.tables import sheet_rows

NA_SQL = ", ".join("'" + s.replace("'", "''") + "'" for s in NA_STRINGS)


def sheet_dir(spark, sf_dir):
    """Write the derived sheets once per call into a fresh shared folder."""
    out = scratch_path(spark, "sheets")
    write_sheets(sheet_rows(spark, sf_dir), out).write.format("noop").mode("overwrite").save()
    return out


@register("corpus_files", f"""
WITH {SHEET_ROWS}
SELECT DISTINCT file_name, true AS has_content FROM sheet_rows
""")
def corpus_files_plan(spark, sf_dir):
    files = corpus_files(spark, sheet_dir(spark, sf_dir))
    return files.select("file_name", (F.length("content") > 0).alias("has_content"))


@register("read_sheets", f"""
WITH {SHEET_ROWS},
numbered AS (SELECT file_name, row_number() OVER (PARTITION BY file_name ORDER BY row_pos) + 1 AS row_pos, cell
             FROM sheet_rows)
SELECT file_name, CAST(row_pos AS BIGINT) AS row_pos, md5(cell) AS cell_md5 FROM numbered
WHERE cell IS NOT NULL AND cell NOT IN ({NA_SQL})
""")
def read_sheets_plan(spark, sf_dir):
    ok, _ = split_rejects(read_sheets(corpus_files(spark, sheet_dir(spark, sf_dir))))
    return ok.select("file_name", "row_pos", F.md5("cell").alias("cell_md5"))


# Fixed value: sheets whose name's md5 starts with one of these digits are damaged on purpose.
DAMAGED_DIGITS = ("0", "1", "2", "3")


@register("file_rejects", f"""
WITH {SHEET_ROWS},
f AS (SELECT file_name, substr(md5(file_name), 1, 1) IN {DAMAGED_DIGITS} AS damaged,
             count(*) FILTER (WHERE cell IS NOT NULL AND cell NOT IN ({NA_SQL})) AS n
      FROM sheet_rows GROUP BY file_name)
SELECT file_name, CASE WHEN damaged THEN 'BadZipFile: File is not a zip file' END AS error,
       CAST(CASE WHEN damaged THEN 0 ELSE n END AS BIGINT) AS n_rows
FROM f WHERE damaged OR n > 0
""")
def file_rejects(spark, sf_dir):
    """Damaged files (cut off in the middle of the archive) are isolated with their
    error; the rows of all other files are unaffected."""
    files = corpus_files(spark, sheet_dir(spark, sf_dir))
    damaged = F.substring(F.md5("file_name"), 1, 1).isin(*DAMAGED_DIGITS)
    files = files.withColumn("content", F.when(damaged, F.expr("substring(content, 1, 200)")).otherwise(F.col("content")))
    ok, rejects = split_rejects(read_sheets(files).transform(materialize))
    counts = ok.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("error", F.lit(None).cast("string"))
    return rejects.select("file_name", "error", F.lit(0).cast("long").alias("n_rows")).unionByName(counts)


@register("sheet_ingest", f"""
WITH {SHEET_ROWS},
r AS (SELECT file_name, NULLIF(trim(cell, {WS_SQL}), '') AS text FROM sheet_rows
      WHERE cell IS NOT NULL AND cell NOT IN ({NA_SQL})),
u AS (SELECT DISTINCT file_name, text,
             CASE WHEN strpos(file_name, '_negative_') > 0 THEN 'INVALID'
                  ELSE split_part(file_name, '_validated_', 1) END AS intent,
             strpos(file_name, '_negative_') > 0 AS is_negative
      FROM r WHERE text IS NOT NULL)
SELECT intent, is_negative, CAST(count(*) AS BIGINT) AS n FROM u GROUP BY intent, is_negative
""")
def sheet_ingest(spark, sf_dir):
    """Corpus directory -> sheet rows -> utterances -> per-file dedup -> counts."""
    ok, _ = split_rejects(read_sheets(corpus_files(spark, sheet_dir(spark, sf_dir))))
    u = C.dedup(C.to_utterances(ok), scope="file")
    return C.intent_distribution(u)
