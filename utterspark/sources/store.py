"""Persisting label dictionaries, models and metric documents."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_label_map(labels: DataFrame, path: str) -> None:
    labels.select("label", "idx").coalesce(1).write.mode("overwrite").parquet(path)


def read_label_map(spark: SparkSession, path: str) -> DataFrame:
    """Load a label dictionary; a missing one is an explicit error."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        raise FileNotFoundError(f"label dictionary not found: {path}")
    return spark.read.parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def metrics_document(history: DataFrame, final: DataFrame, class_metrics: DataFrame,
                     fpr: DataFrame, confusion: DataFrame, speed: DataFrame,
                     labels: DataFrame, model_config: dict) -> DataFrame:
    """One row, one column ``document``: the metrics JSON.

    Every section comes from a table bounded by epochs, classes or classes^2
    (ROC curves grow with the distinct scores, so they stay a table and are not
    folded into the document). Each section is a one-row aggregate; they are
    attached to each other by one-row broadcast joins.
    """
    def one(df, name, expr):
        return df.agg(expr.alias(name)).withColumn("_k", F.lit(0))

    fpr_map = F.map_from_entries(F.array_sort(F.collect_list(F.struct(
        F.concat(F.lit("class_"), F.col("class_idx").cast("string")), F.col("fpr")))))
    sections = [
        one(history, "training_history", F.array_sort(F.collect_list(F.struct(
            "epoch", "train_loss", "train_acc", "valid_loss", "valid_acc")))),
        one(final, "final_metrics", F.first(F.struct(*final.columns))),
        one(fpr, "false_positive_rates", fpr_map),
        one(class_metrics, "class_metrics", F.map_from_entries(F.array_sort(F.collect_list(F.struct(
            F.col("key"), F.struct("precision", "recall", "f1_score", "support")))))),
        one(confusion, "confusion_matrix", F.array_sort(F.collect_list(F.struct("y", "k", "n")))),
        one(speed, "prediction_speed", F.first(F.struct(*speed.columns))),
        one(labels, "label_mapping", F.map_from_entries(F.array_sort(F.collect_list(F.struct(
            F.col("idx").cast("string"), F.col("label")))))),
    ]
    doc = sections[0]
    for s in sections[1:]:
        doc = doc.join(F.broadcast(s), "_k")
    cfg = F.struct(*[F.lit(v).alias(k) for k, v in model_config.items()])
    final_metrics = F.struct(*[F.col(f"final_metrics.{c}").alias(c) for c in final.columns],
                             F.col("false_positive_rates"))
    return doc.select(F.to_json(F.struct(
        "training_history", final_metrics.alias("final_metrics"), "class_metrics",
        "confusion_matrix", "prediction_speed", "label_mapping",
        cfg.alias("model_config"))).alias("document"))


def write_metrics(doc: DataFrame, path: str) -> None:
    doc.coalesce(1).write.mode("overwrite").text(path)
