"""Corpus building: polarity, intent, cleaning, relabelling, union, dedup."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterspark.functions.text import INVALID_LABEL, clean_text
from utterspark.operators.ranking import global_rank
from utterspark.session import broadcast_if_bounded, materialize

UTTERANCE_KEY = ["text", "intent", "is_negative"]

# The sheet-name markers.
VALIDATED_MARKER = "_validated_"
NEGATIVE_MARKER = "_negative_"


# A missing row position: after every position of its file.
_NO_ROW = Decimal(10**20 - 1)

# Broadcast limit (rows) for the keys of an increment batch.
MAX_BROADCAST_KEYS = 200_000


def polarity(name_col="file_name"):
    """A sheet is negative when its file name contains ``_negative_``."""
    return F.col(name_col).contains(NEGATIVE_MARKER)


def intent_from_name(name_col="file_name", rule: str = "validated"):
    """Intent encoded in a sheet name.

    ``validated``: the part before the first ``_validated_`` (whole name if absent).
    ``drop_last_3``: the ``_`` pieces of the name minus the last three (the old
    rule, applied to whatever string is given, e.g. a full path).
    """
    c = F.col(name_col)
    if rule == "validated":
        return F.substring_index(c, VALIDATED_MARKER, 1)
    if rule == "drop_last_3":
        parts = F.split(c, "_")
        return F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 3, F.lit(0))), "_")
    raise ValueError(f"unknown intent rule {rule!r}")


def with_polarity(df: DataFrame, name_col="file_name") -> DataFrame:
    return df.withColumn("is_negative", polarity(name_col))


def with_intent(df: DataFrame, name_col="file_name", rule: str = "validated") -> DataFrame:
    return df.withColumn("intent", intent_from_name(name_col, rule))


def drop_blank(df: DataFrame, col: str = "text", sentinel: str | None = None) -> DataFrame:
    """Drop rows whose (cleaned) text is NULL.

    With ``sentinel`` the old behaviour is kept: blank becomes the sentinel and
    every row equal to the sentinel (a real utterance too) is dropped.
    """
    if sentinel is None:
        return df.filter(F.col(col).isNotNull())
    return (df.withColumn(col, F.coalesce(F.col(col), F.lit(sentinel)))
              .filter(F.col(col) != F.lit(sentinel)))


def relabel_negatives(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "intent", F.when(F.col("is_negative"), F.lit(INVALID_LABEL)).otherwise(F.col("intent")))


def to_utterances(rows: DataFrame, name_col: str = "file_name", path_col: str = "path",
                  cell_col: str = "cell", relabel: bool = True) -> DataFrame:
    """Sheet rows -> utterances ``(text, intent, is_negative, source_file, row_pos)``."""
    out = rows.select(
        clean_text(cell_col).alias("text"),
        intent_from_name(name_col).alias("intent"),
        polarity(name_col).alias("is_negative"),
        F.col(path_col).alias("source_file"),
        F.col("row_pos"),
    )
    if relabel:
        out = relabel_negatives(out)
    return drop_blank(out)


def to_legacy_utterances(rows: DataFrame, path_col: str = "path", cell_col: str = "cell",
                         sentinel: str = "unknown", intent_rule: str = "drop_last_3",
                         name_col: str = "file_name") -> DataFrame:
    """The older flows' corpus: positive sheets only (``_negative_`` is tested
    on the whole path, so a directory name counts), blank text -> ``sentinel``
    -> dropped (a real utterance equal to the sentinel too); ``is_negative`` is
    always false. Intent: ``drop_last_3`` = the path without its last three
    ``_`` pieces (first version); ``validated`` = the file name before
    ``_validated_`` (embedding flow)."""
    pos = rows.filter(~F.col(path_col).contains(NEGATIVE_MARKER))
    intent_src = path_col if intent_rule == "drop_last_3" else name_col
    out = pos.select(clean_text(cell_col).alias("text"),
                     intent_from_name(intent_src, intent_rule).alias("intent"),
                     F.lit(False).alias("is_negative"), F.col(path_col).alias("source_file"), F.col("row_pos"))
    return drop_blank(out, sentinel=sentinel)


def build_corpus(*frames: DataFrame) -> DataFrame:
    """Bag union of positive and negative frames by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def dedup(df: DataFrame, scope: str = "file") -> DataFrame:
    """Exact de-duplication of utterances.

    ``file``: within one sheet (the canonical rule); ``intent``: across the
    pooled sheets of one intent; ``corpus`` is the same key as ``intent``.
    The surviving row is the first by (source_file, row_pos), so the result is
    deterministic; a NULL source comes before all others, a NULL position after
    the others of its source, and NULL texts, intents or marks are values like any other. Hash aggregation combines map-side, so a text repeated in a
    third of all rows costs one partial row per task, not one hot reducer.
    """
    if scope == "file":
        return (df.groupBy("source_file", *UTTERANCE_KEY)
                  .agg(F.min("row_pos").alias("row_pos"))
                  .select(*UTTERANCE_KEY, "source_file", "row_pos"))
    if scope in ("intent", "corpus"):
        # files are numbered in order and (number, row) is packed into one decimal:
        # a fixed-width state, so the aggregate hashes instead of sorting whole texts
        files = materialize(df.select(F.col("source_file").alias("_file")).distinct())
        numbered = global_rank(files, ["_file"], rank_col="_f", size_col=None)
        numbered = broadcast_if_bounded(numbered, MAX_BROADCAST_KEYS)
        wide, whole, low = "decimal(38,0)", F.lit(Decimal(10**20)), F.lit(Decimal(2**63))
        place = F.coalesce(F.col("row_pos").cast("decimal(20,0)") + low, F.lit(_NO_ROW))
        packed = F.col("_f").cast("decimal(10,0)") * whole + place
        first = (df.join(numbered, F.col("source_file").eqNullSafe(F.col("_file")))
                 .groupBy(*UTTERANCE_KEY).agg(F.min(packed.cast(wide)).alias("_first")))
        place = (F.col("_first") % whole).cast(wide)
        file_no = ((F.col("_first") - place) / whole).cast("long")  # exact: a quotient of decimals is rounded
        row = F.when(place != F.lit(_NO_ROW), place - low).cast("long")
        return (first.select(*UTTERANCE_KEY, file_no.alias("_f"), row.alias("row_pos"))
                     .join(numbered, "_f").select(*UTTERANCE_KEY, F.col("_file").alias("source_file"), "row_pos"))
    raise ValueError(f"unknown dedup scope {scope!r}")


def cross_split_duplicates(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Texts that survive per-file de-duplication in several places and either
    straddle splits (leakage between train and evaluation) or carry more than
    one label. ``(text, n_rows, n_splits, n_intents)``.

    The first aggregation combines map-side, so a text holding a third of all
    rows costs one partial row per task; the second sees at most
    splits x intents rows per text.
    """
    g = df.groupBy("text", split_col, "intent").agg(F.count(F.lit(1)).alias("_n"))
    per_text = g.groupBy("text").agg(F.sum("_n").alias("n_rows"),
                                     F.count_distinct(split_col).alias("n_splits"),
                                     F.count_distinct("intent").alias("n_intents"))
    return per_text.filter((F.col("n_splits") > 1) | (F.col("n_intents") > 1))


def file_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"))


def intent_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("intent", "is_negative").agg(F.count(F.lit(1)).alias("n"))


def valid_inputs(df: DataFrame, col: str = "text") -> DataFrame:
    """Prediction-time inputs: stripped, empty ones rejected."""
    return df.withColumn(col, clean_text(col)).filter(F.col(col).isNotNull())


def accept_scored(df: DataFrame, scores: DataFrame, positive_cutoff: int = 3,
                  negative_cutoff: int = 2, n_scores: int = 2) -> DataFrame:
    """Keep utterances whose independent scores all exceed the polarity cutoff.

    ``scores``: (text, intent, is_negative, scorer, score); a NULL score counts
    as missing, and an utterance needs ``n_scores`` present scores.
    """
    cutoff = F.when(F.col("is_negative"), F.lit(negative_cutoff)).otherwise(F.lit(positive_cutoff))
    ok = (scores.groupBy(*UTTERANCE_KEY)
                .agg(F.count("score").alias("n_scores"), F.min("score").alias("min_score"))
                .filter((F.col("n_scores") == n_scores) & (F.col("min_score") > cutoff))
                .select(*UTTERANCE_KEY))
    return df.join(ok, UTTERANCE_KEY, "left_semi")


def increment(corpus: DataFrame, batch: DataFrame) -> DataFrame:
    """Append new utterances (and possibly new intents) not already present.

    Repeats inside the batch are appended once (the first by source and row);
    NULL keys compare as equal. The corpus is first cut to the keys of the batch (broadcast behind a size
    check), so a small batch does not shuffle the corpus.
    """
    batch = dedup(batch, scope="corpus")
    keys = batch.select(*[F.col(c).alias(f"_k_{c}") for c in UTTERANCE_KEY])
    keys = broadcast_if_bounded(keys, MAX_BROADCAST_KEYS)

    def same(left, right):
        return [left[c].eqNullSafe(right[f"_k_{c}"]) for c in UTTERANCE_KEY]

    present = corpus.select(*UTTERANCE_KEY).join(keys, same(corpus, keys), "left_semi").distinct()
    present = present.select(*[F.col(c).alias(f"_k_{c}") for c in UTTERANCE_KEY])
    new = batch.join(present, same(batch, present), "left_anti")
    return corpus.unionByName(new.select(*corpus.columns))
