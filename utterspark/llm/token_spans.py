"""Token counts per section by offset-mapped attribution.

A document is encoded once, whole, so merges across section boundaries are those of the real token
stream. Token byte lengths give every token's span; sections (character spans) become byte spans; an
interval join by binary search finds the sections a token overlaps. A token inside one section counts
there; one that crosses a boundary goes to the section that holds most of its bytes, to the earlier
one on ties; one that touches no section counts as outside. Counts therefore add up to the document's
tokens. It is a projection per batch: no shuffle, memory bounded by a slice of text.

Defined results: null and empty texts have no tokens; sections are taken in order of start, an overlap
belongs to the earlier section, spans beyond the text are cut to it, empty sections count 0; without
sections all tokens are outside. The outside row (section null) is there if it counts tokens or the
document has no section. A repeated row gives its rows again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterspark.llm.common import prepare, ragged, row_slices, utf8

SCHEMA = "doc_id long, section int, start long, end long, n_tokens long, n_crossing long"


def line_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) in bytes of the lines of every row: what newlines separate, blank lines left out."""
    n = len(off) - 1
    cuts = np.flatnonzero(data == 10)
    row = np.searchsorted(off, cuts, "right") - 1
    starts = np.concatenate([off[:-1], cuts + 1])
    rows = np.concatenate([np.arange(n), row])
    order = np.lexsort((starts, rows))
    starts, rows = starts[order], rows[order]
    last = np.ones(len(starts), bool)
    last[:-1] = rows[1:] != rows[:-1]
    ends = np.where(last, off[rows + 1], np.append(starts[1:], 0) - 1)
    keep = ends > starts
    return rows[keep], starts[keep], ends[keep]


def given_spans(spans: pa.Array, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) in bytes of array<struct<start, end>> character spans, sorted and made disjoint."""
    lead = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    first = np.searchsorted(lead, off)
    rows, starts, ends = [], [], []
    for i, found in enumerate(spans.to_pylist()):
        chars, done = first[i + 1] - first[i], 0
        for s in sorted((x["start"], x["end"]) for x in found or [] if x and x["start"] is not None and x["end"] is not None):
            a, b = max(s[0], done, 0), min(s[1], chars)
            a = min(a, chars)
            b = max(a, b)
            rows.append(i)
            starts.append(lead[first[i] + a])
            ends.append(lead[first[i] + b])
            done = b
    return np.array(rows, np.int64), np.array(starts, np.int64), np.array(ends, np.int64)


def attribute(tok_start: np.ndarray, tok_end: np.ndarray, sec_start: np.ndarray, sec_end: np.ndarray) -> np.ndarray:
    """Section index of every token, -1 outside. Both lists are sorted and disjoint."""
    full = np.flatnonzero(sec_end > sec_start)
    if len(full) == 0:
        return np.full(len(tok_start), -1)
    s, e = sec_start[full], sec_end[full]
    lo = np.searchsorted(e, tok_start, "right")
    hi = np.searchsorted(s, tok_end, "left")
    out = np.where(hi > lo, full[np.minimum(lo, len(full) - 1)], -1)
    many = np.flatnonzero(hi - lo > 1)
    if len(many):
        count = (hi - lo)[many]
        sec = ragged(lo[many], count)
        tok = np.repeat(many, count)
        shared = np.minimum(e[sec], tok_end[tok]) - np.maximum(s[sec], tok_start[tok])
        order = np.lexsort((sec, -shared, tok))
        first = np.ones(len(order), bool)
        first[1:] = tok[order][1:] != tok[order][:-1]
        out[tok[order][first]] = full[sec[order][first]]
    return out


def _task(shared, has_spans: bool):
    def run(batches):
        c = shared.value
        for b in batches:
            ids = b.column("doc_id")
            for lo, hi in row_slices(b.column("text")):
                text = b.column("text").slice(lo, hi - lo)
                data, off = utf8(text)
                if has_spans:
                    row, start, end = given_spans(b.column("spans").slice(lo, hi - lo), data, off)
                else:
                    row, start, end = line_spans(data, off)
                tokens, per = c.encode(text)
                stop = np.cumsum(c.id_len[tokens.astype(np.int64)])
                begin = np.concatenate([[0], stop[:-1]]) if len(stop) else stop
                at = attribute(begin, stop, start, end)
                inside, n = at >= 0, len(row)
                k = at[inside]
                crossing = (begin[inside] < start[k]) | (stop[inside] > end[k])
                count = np.bincount(k, minlength=n).astype(np.int64)
                crossed = np.bincount(k, crossing, n).astype(np.int64)
                outside = np.bincount(np.repeat(np.arange(hi - lo), per)[~inside], minlength=hi - lo)
                extra = np.flatnonzero((outside > 0) | (np.bincount(row, minlength=hi - lo) == 0))
                lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                base = lead[off[row]]
                first = np.searchsorted(row, row)
                m = len(extra)
                none = pa.nulls(m, pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids.take(pa.array(np.concatenate([row, extra]) + lo)).cast(pa.int64()),
                    "section": pa.concat_arrays([pa.array((np.arange(n) - first).astype(np.int32)), pa.nulls(m, pa.int32())]),
                    "start": pa.concat_arrays([pa.array(lead[start] - base), none]), "end": pa.concat_arrays([pa.array(lead[end] - base), none]),
                    "n_tokens": pa.array(np.concatenate([count, outside[extra]]).astype(np.int64)),
                    "n_crossing": pa.array(np.concatenate([crossed, np.zeros(m, np.int64)]))})
    return run


def section_tokens(docs: DataFrame, shared, id_col: str = "doc_id", text_col: str = "text", spans_col: str | None = None) -> DataFrame:
    """(doc_id, section, start, end, n_tokens, n_crossing), a row per section and one for what is outside.
    ``shared`` is a codec of ``bpe.codec``; ``spans_col`` holds array<struct<start, end>> in characters
    (sections are numbered in order of start), without it the non-blank lines are the sections."""
    prepare(docs.sparkSession)
    cols = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    if spans_col:
        cols.append(F.col(spans_col).cast("array<struct<start:bigint,end:bigint>>").alias("spans"))
    return docs.select(*cols).mapInArrow(_task(shared, spans_col is not None), SCHEMA)
