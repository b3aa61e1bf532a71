"""Language ID: multinomial naive Bayes over hashed character n-grams.

A text becomes its code points, letters folded to lower case by a table and everything else to one
space; its 1- to 3-grams that hold a letter are hashed to ``BUCKETS`` buckets. Training sums bucket
counts per language (partial sums per task, one Spark aggregation); the matrix of smoothed
log-probabilities, languages x buckets, is broadcast, and scoring gathers and sums its columns over
the sparse n-gram lists of a batch of texts in numpy. Prediction is one projection: no shuffle.

The classifier is fitted on a hash sample of about ``max_train_docs`` labelled rows per language
(languages with fewer rows are used whole); prediction covers every row and whole texts.

Defined results: null text, empty text or a text without a letter -> ``und`` with score 0; nothing
learnable -> ``und`` with score 0 for all; equal texts get equal predictions; equal totals go to
the language that sorts first by code point. The prediction is the maximum of the whole text's
posterior; only its score is tempered to the evidence of ``EVIDENCE`` n-grams, so that long texts do not
all score exactly 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterspark.llm.common import mix64, prepare, row_slices, utf8

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
EVIDENCE = 50.0
MAX_TRAIN_DOCS = 10_000
SMOOTHING = 0.5
UNKNOWN = "und"


def _fold_table() -> np.ndarray:
    """Code points of the basic plane: letters to their lower case, all else to a space."""
    out = np.full(0x10000, 32, np.uint32)
    for i in range(0x10000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


_FOLD: np.ndarray | None = None


def _letters(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points of a slice and their offsets per row."""
    global _FOLD
    if _FOLD is None:
        _FOLD = _fold_table()
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    cp = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    high = cp > 0xFFFF
    out = _FOLD[np.where(high, 32, cp)]
    if high.any():
        for c in np.unique(cp[high]):
            if chr(c).isalpha():
                out[cp == c] = c
    return out, lead[off]


def ngram_rows(arr: pa.Array):
    """(bucket, row, letters per row) of a slice of texts; n-grams never cross rows."""
    data, off = utf8(arr)
    cp, off = _letters(data, off)
    n = len(off) - 1
    row = np.repeat(np.arange(n), np.diff(off))
    letter = cp != 32
    letters = np.bincount(row, letter, n).astype(np.int64)
    buckets, rows = [], []
    c64 = cp.astype(np.uint64)
    for k in ORDERS:
        m = len(cp) - k + 1
        if m <= 0:
            continue
        code, some = np.zeros(m, np.uint64), np.zeros(m, bool)
        for j in range(k):
            code = code * np.uint64(0x110001) + c64[j:j + m]
            some |= letter[j:j + m]
        keep = some & (row[:m] == row[k - 1:])
        buckets.append((mix64(code[keep] + np.uint64(k << 60)) >> np.uint64(64 - 15)).astype(np.int32))
        rows.append(row[:m][keep])
    if not buckets:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), letters
    return np.concatenate(buckets), np.concatenate(rows), letters


def _count_task(batches):
    """Sums of bucket counts per language over a task's rows."""
    sums: dict[str, np.ndarray] = {}
    for b in batches:
        for lo, hi in row_slices(b.column("text")):
            langs = np.array(b.column("lang").slice(lo, hi - lo).to_pylist(), object)
            bucket, row, _ = ngram_rows(b.column("text").slice(lo, hi - lo))
            for lang in set(langs):
                hit = (langs == lang)[row]
                sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                sums[lang] += np.bincount(bucket[hit], minlength=BUCKETS)
    for lang, s in sums.items():
        at = np.flatnonzero(s)
        yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()),
                                          "bucket": pa.array(at, pa.int32()), "cnt": pa.array(s[at])})


class Model:
    """Languages in code-point order, their log priors and the (languages x buckets) matrix."""

    def __init__(self, langs: list[str], prior: np.ndarray, logp: np.ndarray):
        self.langs, self.prior, self.logp = langs, prior, logp

    def predict(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(language index or -1, score) of every text."""
        best, score = np.full(len(arr), -1), np.zeros(len(arr))
        if not self.langs:
            return best, score
        for lo, hi in row_slices(arr):
            bucket, row, letters = ngram_rows(arr.slice(lo, hi - lo))
            n = hi - lo
            grams = np.maximum(np.bincount(row, minlength=n), 1)
            told = np.stack([np.bincount(row, lp[bucket], n) for lp in self.logp])
            k = (told + self.prior[:, None]).argmax(axis=0)  # the whole text decides
            told = told * (np.minimum(grams, EVIDENCE) / grams) + self.prior[:, None]
            p = np.exp(told - told.max(axis=0))
            ok = letters > 0
            best[lo:hi] = np.where(ok, k, -1)
            score[lo:hi] = np.where(ok, p[k, np.arange(n)] / p.sum(axis=0), 0.0)
        return best, score


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        max_train_docs: int = MAX_TRAIN_DOCS) -> Model:
    """Fit on the rows of ``train`` with a non-null language; about ``max_train_docs`` per language.
    What reaches the driver is one number per language and the count matrix."""
    spark = train.sparkSession
    prepare(spark)
    rows = train.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros(0), np.zeros((0, BUCKETS)))
    part = F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit(""))), F.lit(1 << 30)) / float(1 << 30)
    rate = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, max_train_docs / sizes[k]))])
    sample = rows.where(part < F.try_element_at(rate, F.col("lang"))).select("text", "lang")
    counts = (sample.mapInArrow(_count_task, "lang string, bucket int, cnt long")
              .groupBy("lang", "bucket").agg(F.sum("cnt").alias("cnt")).toPandas())
    at = {k: i for i, k in enumerate(langs)}
    m = np.full((len(langs), BUCKETS), SMOOTHING)
    m[counts["lang"].map(at).to_numpy(np.int64), counts["bucket"].to_numpy(np.int64)] += counts["cnt"].to_numpy(float)
    n = np.array([sizes[k] for k in langs], float)
    return Model(langs, np.log(n / n.sum()), np.log(m / m.sum(axis=1, keepdims=True)))


def predict(df: DataFrame, model: Model, text_col: str = "text", out: str = "lang_id") -> DataFrame:
    """``df`` with a struct column ``out`` (lang string, score double); all columns stay."""
    spark = df.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,score:double>")
    def tag(texts: pa.Array) -> pa.Array:
        m = shared.value
        best, score = m.predict(texts)
        names = np.array([*m.langs, UNKNOWN], object)
        return pa.StructArray.from_arrays([pa.array(names[best], pa.string()), pa.array(score)], ["lang", "score"])

    return df.withColumn(out, tag(F.col(text_col).cast("string")))


def with_letters(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose text has a letter; needs no model."""
    prepare(df.sparkSession)

    @F.arrow_udf("boolean")
    def some(texts: pa.Array) -> pa.Array:
        return pa.array([bool(x) for lo, hi in row_slices(texts) for x in ngram_rows(texts.slice(lo, hi - lo))[2] > 0], pa.bool_())

    return df.where(some(F.col(text_col).cast("string")))
