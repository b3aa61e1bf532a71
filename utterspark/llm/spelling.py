"""Spelling variant grouping by PartEnum signatures over letter multisets.

A word is a binary vector with one dimension per letter and occurrence number ("banana": a1 a2 a3 b1 n1
n2). One replaced letter changes two dimensions and leaves the length, one inserted or deleted letter
changes one and the length by one. The dimensions are partitioned into groups; for a Hamming distance of
at most d every choice of all but d groups is enumerated, and the contents of the chosen groups (with
the length class) are hashed into a signature. Two vectors within d differ in at most d groups, so they
agree on the choice that avoids these: they share a signature. No near pair can be missed.

Signatures are equi-joined (words of one length: ``GROUPS[2]`` groups, distance 2; a word to words one
letter longer: ``GROUPS[1]`` groups, distance 1) and the pairs verified by edit distance. Groups are
balanced by how much the dimensions tell, from counts over all words; that decides only how many
candidates there are.

Forms and roots: a word's form is its near word of largest count, where that is ``RATIO`` times its own
or more. Counts grow by that factor along a chain, so chains have no cycles and few steps; roots are
found by pointer doubling, each round a join that ends in a checkpoint.

Scale: words are counted per task (all runs of a slice of texts at once, crc32 by its linearity as in
``importance``) and summed by Spark. Everything after that works
on distinct words: a fixed number of signatures a word, a join that AQE splits where a signature is
common, and at most alphabet x length near words a word. Nothing but one table of group numbers (256 letters x 8
occurrences) reaches the driver.

Defined results: null and empty texts have no runs; a null id counts as empty in the keyed deletions;
rows that repeat an id or a text count as often as they occur; ties of count go to the word that is smaller in code-point order; a
run emptied by its deletion, and words below the limits, are left out; empty tables give no rows.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterspark.llm.common import FOLD_AZ, list_binary, mix64, prepare, ragged, row_slices, utf8, word_spans
from utterspark.llm.importance import CRC32_SQL, Crc32

MIN_LETTERS, MIN_COUNT, RATIO = 6, 5, 5
EVERY = 199  # one in so many (document, run) pairs loses a letter
GROUPS = {1: 5, 2: 6}  # distance: groups
LETTERS, OCCURRENCES = 256, 8  # dimensions with a counted place; others go by their hash
HELD = 1 << 19  # distinct words a counting task holds
MAX_ROUNDS = 12  # doubling rounds: 2**12 steps, where a chain of counts of 64 bits has 27 at most
_ASCII = np.zeros(256, bool)
_ASCII[[*range(65, 91), *range(97, 123)]] = True
_NO_LETTER = np.array([True, False])


def runs_of(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with A-Z in lower case, starts, ends, rows, letters) of all maximal runs of letters. In
    UTF-8 the letters from U+00C0 to U+00FF are the lead byte C3 and any second byte."""
    data, off = utf8(arr)
    letter = _ASCII[data] | (data == 0xC3)
    letter[1:] |= data[:-1] == 0xC3
    starts, ends, row = word_spans(letter.view(np.uint8), off, _NO_LETTER)
    before = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    return FOLD_AZ[data], starts, ends, row, before[ends] - before[starts]


def _count_task(every: int, min_letters: int):
    """(word, n) per task, in portions of at most ``HELD`` distinct words."""
    def words(x, crc):
        data, starts, ends, row, letters = runs_of(x.column("text"))
        # a run that is too short stays too short without a letter
        long = letters >= min_letters
        starts, ends, row, letters = starts[long], ends[long], row[long], letters[long]
        keys, off = utf8(x.column("key"))
        first = crc.shift(np.full(len(off) - 1, 0xFFFFFFFF, np.uint32), np.diff(off)) ^ crc.spans(keys, off[:-1], off[1:])
        h = ~(crc.shift(first[row], ends - starts) ^ crc.spans(data, starts, ends))
        cut = h % np.uint32(every) == 0
        size = np.where(cut, 0, ends - starts)
        kept = size > 0
        whole = list_binary(data[ragged(starts, size)], np.append(0, np.cumsum(size[kept]))).cast(pa.string())
        less = []
        for i in np.flatnonzero(cut).tolist():
            if letters[i] > min_letters:
                run = data[starts[i]:ends[i]].tobytes().decode()
                at = int(h[i]) % len(run)
                less.append(run[:at] + run[at + 1:])
        return pa.concat_arrays([whole, pa.array(less, pa.string())])

    def run(batches):
        crc, sums = Crc32(), None
        for b in batches:
            for lo, hi in row_slices(b.column("text")):
                n = words(b.slice(lo, hi - lo), crc).value_counts()
                part = pa.table({"word": n.field("values"), "n": n.field("counts")})
                sums = part if sums is None else pa.concat_tables([sums, part])
                if len(sums) > HELD:
                    sums = sums.group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])
                    if len(sums) > HELD // 2:
                        yield from sums.to_batches(max_chunksize=1 << 16)
                        sums = None
        if sums is not None:
            yield from sums.group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"]).to_batches(max_chunksize=1 << 16)
    return run


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT,
                every: int = EVERY) -> DataFrame:
    """(word, n): the words of all texts and their number of occurrences. Where ``every`` divides the
    crc32 h of "id:run", the run loses its letter h modulo its length."""
    prepare(docs.sparkSession)
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"))
    d = docs.select(key.alias("key"), F.col(text_col).cast("string").alias("text"))
    words = d.mapInArrow(_count_task(every, min_letters), "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def dimensions(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, letter, occurrence number from 0) of every letter of the words, and the words' lengths."""
    data, off = utf8(arr)
    lead = np.cumsum((data & 0xC0) != 0x80)
    size = np.diff(np.append(0, lead)[off])
    letter = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(size)), size)
    order = np.lexsort((letter, row))
    row, letter = row[order], letter[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (letter[1:] != letter[:-1])
    first = np.flatnonzero(new)
    occurrence = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
    return row, letter, occurrence, size


def _dimension_task(batches):
    """(dimension, words that have it) of the dimensions with a counted place, per task."""
    n = np.zeros(LETTERS * OCCURRENCES, np.int64)
    for b in batches:
        _, letter, occurrence, _ = dimensions(b.column("word"))
        low = (letter < LETTERS) & (occurrence < OCCURRENCES)
        n += np.bincount(letter[low] * OCCURRENCES + occurrence[low], minlength=len(n))
    some = np.flatnonzero(n)
    yield pa.RecordBatch.from_pydict({"dim": pa.array(some.astype(np.int32)), "n": pa.array(n[some])})


def balanced_groups(counts: np.ndarray, words: int, groups: int) -> np.ndarray:
    """A group for every dimension: the most telling first, each to the group that tells least so far."""
    p = np.clip(counts / max(words, 1), 1e-12, 1 - 1e-12)
    tells = -(p * np.log(p) + (1 - p) * np.log(1 - p))
    out, mass = np.zeros(len(counts), np.int64), np.zeros(groups)
    for d in np.argsort(-tells, kind="stable"):
        g = int(mass.argmin())
        out[d] = g
        mass[g] += tells[d]
    return out


def group_contents(arr: pa.Array, place: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of what every word has in every group (words x groups), and the words' lengths."""
    row, letter, occurrence, size = dimensions(arr)
    dim = mix64((letter * (1 << 32) + occurrence + 1).astype(np.uint64))
    low = (letter < LETTERS) & (occurrence < OCCURRENCES)
    group = (dim % np.uint64(groups)).astype(np.int64)
    group[low] = place[letter[low] * OCCURRENCES + occurrence[low]]
    cell = row * groups + group
    order = np.argsort(cell, kind="stable")
    cell, dim = cell[order], dim[order]
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    out = np.zeros(len(size) * groups, np.uint64)
    if len(first):
        out[cell[first]] = np.add.reduceat(dim, first)  # a sum of hashes: the order of letters plays no part
    return out.reshape(len(size), groups), size


def enumerated(contents: np.ndarray, length: np.ndarray, distance: int):
    """A signature per word for every choice of all but ``distance`` groups."""
    groups = contents.shape[1]
    for c, chosen in enumerate(itertools.combinations(range(groups), groups - distance)):
        h = mix64(length.astype(np.uint64) * np.uint64(2654435761) + np.uint64(c))
        for g in chosen:
            h = mix64(h ^ contents[:, g])
        yield h


def signatures(words: DataFrame, place: np.ndarray, distance: int, shorter: int = 0) -> DataFrame:
    """(sig, word, n) for every word and choice; the length class is the length less ``shorter``."""
    groups = GROUPS[distance]

    def run(batches):
        for b in batches:
            word = b.column("word")
            contents, size = group_contents(word, place, groups)
            for h in enumerated(contents, size - shorter, distance):
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), word, b.column("n")], ["sig", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "sig long, word string, n long")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n), once per pair of words (word, n) that differ by exactly one inserted, deleted or
    replaced code point. ``words`` holds every word once."""
    counts = words.select("word").mapInArrow(_dimension_task, "dim int, n long").groupBy("dim").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(LETTERS * OCCURRENCES, np.int64)
    n[counts["dim"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    total = words.count()
    place = {d: balanced_groups(n, total, g) for d, g in GROUPS.items()}

    def side(df, name):
        return df.select("sig", F.col("word").alias(name), F.col("n").alias(f"{name}_n"))

    same = signatures(words, place[2], 2)
    replaced = side(same, "a").join(side(same, "b"), "sig").where("a < b")
    longer = side(signatures(words, place[1], 1), "a").join(side(signatures(words, place[1], 1, shorter=1), "b"), "sig")
    near = F.levenshtein("a", "b", 1) == 1
    columns = ["a", "a_n", "b", "b_n"]
    return replaced.where(near).select(*columns).unionByName(longer.where(near).select(*columns)).distinct()


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Every word of ``words`` (word, n) with n_near, form, form_n and root."""
    spark = words.sparkSession
    prepare(spark)
    w = words.select("word", "n").checkpoint(eager=True)
    pairs = near_pairs(w).checkpoint(eager=True)
    both = pairs.select(F.col("a").alias("word"), F.col("a_n").alias("own"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).union(
        pairs.select("b", "b_n", "a", "a_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("down"), F.col("near").alias("near")))
    g = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.max("own").alias("own"), best.alias("best"))
    large = -F.col("best.down") >= F.col("own") * ratio
    g = g.select("word", "n_near", F.when(large, F.col("best.near")).alias("form"), F.when(large, -F.col("best.down")).alias("form_n")).checkpoint(eager=True)
    step = g.where("form is not null").select("word", F.col("form").alias("root")).checkpoint(eager=True)
    for _ in range(MAX_ROUNDS):
        onward = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = step.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")).checkpoint(eager=True)
        step = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return (w.join(g, "word", "left").join(step, "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root")))


# near words by deletion: equal without their letter i and of one length, or one equal to the other without a letter
ORACLE = """
with recursive runs as (
  select coalesce(doc_id::varchar, '') as k, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents),
counted as (select k, run, k || ':' || run as f, count(*) as n from runs group by all),
""" + CRC32_SQL.format(texts="counted", out="crc") + """,
cut as (
  select case when h % 199 = 0 then substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) else run end as word, n
  from counted join crc using (f)),
words as (select word, sum(n)::bigint as n from cut where length(word) >= 6 group by word having sum(n) >= 5),
less as (select word, n, length(word) as size, i, substring(word, 1, i - 1) || substring(word, i + 1) as rest
  from (select word, n, unnest(generate_series(1, length(word))) as i from words)),
near as (
  select a.word, a.n, b.word as other, b.n as other_n from less a join less b on a.i = b.i and a.rest = b.rest and a.size = b.size and a.word <> b.word
  union select l.word, l.n, w.word, w.n from less l join words w on l.rest = w.word
  union select w.word, w.n, l.word, l.n from less l join words w on l.rest = w.word),
best as (
  select word, n, count(*) as n_near, first(other order by other_n desc, encode(other)) as other, max(other_n) as other_n from near group by word, n),
forms as (select word, n_near, case when other_n >= 5 * n then other end as form, case when other_n >= 5 * n then other_n end as form_n from best),
chain as (
  select word, form as here, 1 as step from forms where form is not null
  union all select c.word, f.form, step + 1 from chain c join forms f on f.word = c.here where f.form is not null),
roots as (select word, arg_max(here, step) as root from chain group by word)
select words.word, words.n, coalesce(n_near, 0) as n_near, form, form_n, coalesce(root, words.word) as root
from words left join forms using (word) left join roots using (word)
"""
