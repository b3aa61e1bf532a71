"""Driver tables and the fixtures derived from them.

Every fixture is a lazy DataFrame over the given Parquet tables, so column
pruning and filters reach the scans and the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the time stamp part used in derived sheet names; it contains one
# "_" so the legacy intent rule (drop the last three "_" pieces) applies.
SHEET_TIME_PREFIX = "20250310_"
SHEET_DIR = "dataset/"


# Text tables and their row ids: per-row work on them (regex, tokenising) is
# CPU-heavy, so a scan narrower than the cluster is spread out by id.
TEXT_TABLE_KEYS = {"documents": "doc_id", "conversations": "conv_id", "benchmark": "item_id",
                   "pages": "page_id"}


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-repartition to the default parallelism only when the scan has fewer
    partitions than that (e.g. a file written as one row group). A wide scan is
    left alone, so at scale no extra shuffle is added."""
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= target:
            return df
    except Exception:  # noqa: BLE001 - no RDD view (e.g. a remote session): leave as is
        return df
    return df.repartition(target, *keys)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    key = TEXT_TABLE_KEYS.get(name)
    return spread(df, key) if key else df


def sheet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of labelled utterance sheets, one sheet per (lang, polarity, source).

    documents join labels: the sheet intent is ``lang``, ``quality = 0`` marks a
    negative sheet, the cell is the raw document text and ``row_pos`` its id.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = docs.join(labels, "doc_id")
    file_name = F.concat(
        F.col("lang"), F.lit("_validated_"),
        F.when(F.col("quality") == 0, F.lit("negative_")).otherwise(F.lit("")),
        F.lit(SHEET_TIME_PREFIX), F.col("source"), F.lit(".xlsx"),
    )
    return j.select(
        F.concat(F.lit(SHEET_DIR), file_name).alias("path"),
        file_name.alias("file_name"),
        F.col("doc_id").cast("long").alias("row_pos"),
        F.col("text").alias("cell"),
    )


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical corpus: cleaned, non-blank, de-duplicated per sheet."""
    from utterspark.operators.corpus import dedup, to_utterances

    return dedup(to_utterances(sheet_rows(spark, sf_dir)), scope="file")


# The class that plays INVALID in the scored fixture and the
# logit scale of its centroid scorer.
INVALID_CLASS = 4
SCORE_SCALE = 128.0


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label dictionary of the scored fixture: class 4 plays INVALID.

    Names sort like the class numbers (classes below INVALID get a name that
    sorts before it, numbers are zero-padded), so a class number is its index
    in the dictionary for any number of classes.
    """
    from utterspark.operators.labels import fit_labels

    ys = table(spark, sf_dir, "embeddings").select("label").distinct()
    number = F.lpad(F.col("label").cast("string"), 6, "0")
    names = ys.select(F.when(F.col("label") == INVALID_CLASS, F.lit("INVALID"))
                      .when(F.col("label") < INVALID_CLASS, F.concat(F.lit("Class_"), number))
                      .otherwise(F.concat(F.lit("class_"), number)).alias("intent"))
    return fit_labels(names)


def scored(spark: SparkSession, sf_dir: str, scale: float = SCORE_SCALE) -> DataFrame:
    """``embeddings`` scored by their class-centroid linear model.

    Columns: vec_id, y (true class), z (logits), p (softmax), pred_idx, p_max.
    """
    from utterspark.operators.scoring import centroid_model, linear_logits, with_probabilities

    emb = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.col("label").cast("int").alias("y"))
    model = centroid_model(emb, "embedding", "y")
    return with_probabilities(linear_logits(emb, model, "embedding", "z", scale)).drop("embedding")


def evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``scored`` plus ``k``: the prediction after the evaluation threshold."""
    from utterspark.operators.decide import apply_threshold
    from utterspark.operators.labels import index_of

    inv = index_of(scored_labels(spark, sf_dir), "INVALID")
    return apply_threshold(scored(spark, sf_dir), inv, out="k")


# The synthetic training history (share of rows out of 10 whose
# prediction is forced correct at epochs 1..5) and the number of epochs.
HISTORY_SHARES = (2, 5, 7, 7, 6)


def scored_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``evaluated`` rows with split, batch ids, row loss and sample weight."""
    from utterspark.operators.labels import index_of
    from utterspark.operators.metrics import row_loss, sample_weight
    from utterspark.operators.split import split_corpus, with_batch_id

    inv = index_of(scored_labels(spark, sf_dir), "INVALID")
    s = split_corpus(evaluated(spark, sf_dir), id_cols=("vec_id",))
    s = with_batch_id(s, id_cols=("vec_id",))
    return (s.withColumn("loss", row_loss("z", "y"))
             .withColumn("w", sample_weight(F.col("y") == F.lit(inv)))
             .withColumn("correct", F.col("k") == F.col("y")))


def history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-level training history: each scored row once per epoch."""
    s = scored_split(spark, sf_dir).select("vec_id", "y", "pred_idx", "split", "batch_id", "loss", "w")
    e = s.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(len(HISTORY_SHARES)))))
    h = F.md5(F.concat_ws("|", F.col("epoch").cast("string"), F.col("vec_id").cast("string")))
    u = F.conv(F.substring(h, 1, 4), 16, 10).cast("long") % 10
    share = F.element_at(F.array(*[F.lit(x) for x in HISTORY_SHARES]), F.col("epoch"))
    pred = F.when(u < share, F.col("y")).otherwise(F.col("pred_idx"))
    return e.select("epoch", "split", "batch_id", (F.col("loss") / F.col("epoch")).alias("loss"), "w",
                    (pred == F.col("y")).alias("correct"))
