"""Small tables with the awkward cases every operator must survive."""

import random

from pyspark.sql import functions as F

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, key string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed, n=60):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(9)) for _ in range(n))


def awkward_docs():
    """(doc_id, text, lang, source): nulls in every column, empty, blank and very long texts, ties,
    repeated rows and ids."""
    rows = [(i, prose(i % 17 if i % 5 else i), ["en", "de"][i % 2], f"s{i % 3}") for i in range(40)]
    rows += [(100, None, "en", "s0"), (101, "", "de", None), (102, " \n\t ", None, "s1"), (103, "12 34 !!", "en", "s2"),
             (104, prose(5, 30_000), "en", "s0"), (105, "one", "de", "s1"), (None, prose(3), "en", "s1"),
             (7, prose(7), "de", "s1"), (7, prose(7), "de", "s1"), (8, prose(99), "en", "s2"), (106, "é 中文 \U0001F600 ß", None, None)]
    return rows


def docs_frame(spark, rows=None):
    """Documents with extra columns whose names clash with those operators return."""
    rows = awkward_docs() if rows is None else rows
    return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None, 0.5, 1, "k") for r in rows], DOC_SCHEMA).repartition(3)


def write_tables(spark, folder, docs=None, labels=None, **others):
    docs_frame(spark, docs).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels or [], "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    for name, df in others.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return folder


def empty(df):
    return df.where(F.lit(False))
