"""Labelled-utterance spreadsheets: list, parse, isolate failures.

Files are listed by Spark's ``binaryFile`` source (glob on the file name, no
percent-encoding of paths) and parsed on executors by ``mapInPandas`` with
the standard library (an .xlsx file is a zip of XML parts); one file is one
row in and its sheet rows out, in chunks, so files parse in parallel and a task holds one file and the
texts of its first column.
"""

from __future__ import annotations

import io
import itertools
import re
import zipfile
from array import array
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterspark.sources.xlsx import MAX_SHEET_ROWS, sheet_bytes, unescape_ooxml

SHEET_GLOB = "*_validated_*.xlsx"
MAX_SHEET_BYTES = 64 << 20

# The strings pandas' default reader turns into missing values
# before any cleaning (its default na_values list).
NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

ROW_SCHEMA = "path string, file_name string, row_pos long, cell string, error string"

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_PKG_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}Relationship"


def corpus_files(spark: SparkSession, directory: str, glob: str = SHEET_GLOB) -> DataFrame:
    """``(path, file_name, content)`` of matching files; a missing directory or no
    match gives an empty DataFrame (callers decide whether that ends the run)."""
    empty = spark.createDataFrame([], "path string, file_name string, content binary")
    jpath = spark._jvm.org.apache.hadoop.fs.Path(directory)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        return empty
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "false").load(directory))
    return files.select("path", F.substring_index("path", "/", -1).alias("file_name"), "content")


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text_of(el) -> str:
    return unescape_ooxml("".join(t.text or "" for t in el.iter(f"{{{_NS['m']}}}t")))


def _parts(z: zipfile.ZipFile) -> str:
    """Path of the first sheet inside the archive."""
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    rid = wb.find("m:sheets/m:sheet", _NS).get(_REL)
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in rels.iter(_PKG_REL) if r.get("Id") == rid).lstrip("/")
    return target if target.startswith("xl/") else f"xl/{target}"


def _elements(stream, tag: str, parent: str) -> Iterator[ET.Element]:
    """Every ``tag`` element right when it ends; what was read of ``parent`` is let go with it."""
    tag, parent = f"{{{_NS['m']}}}{tag}", f"{{{_NS['m']}}}{parent}"
    inside = None
    for event, el in ET.iterparse(stream, events=("start", "end")):
        if event == "start" and el.tag == parent:
            inside = el
        elif event == "end" and el.tag == tag and inside is not None:
            yield el
            inside.clear()


def _cells(row: ET.Element) -> Iterator[tuple[int, str, str | None]]:
    """(column, type, raw value) of a row's cells that hold something."""
    col = -1
    for c in row.findall("m:c", _NS):
        # the position attributes are optional: without them cells count on
        col = _col_index(c.get("r")) if c.get("r") else col + 1
        t, v = c.get("t", "n"), c.find("m:v", _NS)
        if t == "inlineStr":
            text = c.find("m:is", _NS)
            if text is not None:
                yield col, t, _text_of(text)
        elif v is not None and v.text is not None:
            yield col, t, v.text


class _Column:
    """The cells of a sheet's text column: row numbers and, per cell, a shared string's number or
    (negative) the place of a value of its own; texts lie in one buffer."""

    def __init__(self):
        self.row, self.ref = array("q"), array("q")
        self.buffer, self.ends, self.others = bytearray(), array("q"), {}

    def add(self, row: int, kind: str, raw: str) -> None:
        self.row.append(row)
        if kind == "s":
            number = int(raw)
            if number < 0:
                raise IndexError(f"shared string {number}")
            self.ref.append(number)
            return
        if kind == "b":
            self.others[len(self.ends)] = raw == "1"
        elif kind not in ("inlineStr", "str", "e"):
            self.others[len(self.ends)] = float(raw)
        else:
            self.buffer += (raw if kind == "inlineStr" else unescape_ooxml(raw)).encode("utf-8", "surrogatepass")
        self.ends.append(len(self.buffer))
        self.ref.append(-len(self.ends))

    def own(self, ref: int) -> object:
        at = -ref - 1
        if at in self.others:
            return self.others[at]
        return self.buffer[self.ends[at - 1] if at else 0:self.ends[at]].decode("utf-8", "surrogatepass")


def _shared(z: zipfile.ZipFile, wanted: set[int]) -> dict[int, str]:
    """The wanted shared strings, read one after another."""
    found: dict[int, str] = {}
    if wanted and "xl/sharedStrings.xml" in z.namelist():
        with z.open("xl/sharedStrings.xml") as stream:
            for i, si in enumerate(_elements(stream, "si", "sst")):
                if i in wanted:
                    found[i] = _text_of(si)
    if len(found) < len(wanted):
        raise IndexError(f"shared string {min(wanted - found.keys())} is missing")
    return found


class _Disorder(ValueError):
    """A row's number is below the one before."""


def _numbered(z: zipfile.ZipFile, sheet: str, check: bool = True) -> Iterator[tuple[int, list]]:
    """(row number, cells by column) of the rows of a sheet; without numbers rows count on."""
    number = 0
    with z.open(sheet) as stream:
        for row in _elements(stream, "row", "sheetData"):
            before, number = number, int(row.get("r") or number + 1)
            if check and number < before:
                raise _Disorder(f"row {number} after row {before}")
            yield number, sorted(_cells(row), key=lambda c: c[0])


def _read_column(z: zipfile.ZipFile, rows: Iterator[tuple[int, list]]) -> _Column:
    """Column A of all rows after the first that holds anything, with the columns it goes on in."""
    column, last, header = _Column(), 0, None
    for number, cells in rows:
        if header is None and cells:
            # a first-column text that goes on in columns named <header>+1, <header>+2, ... is joined again
            header = number
            names = _shared(z, {int(v) for _, t, v in cells if t == "s"})
            text = {"s": lambda v: names[int(v)], "inlineStr": str, "str": unescape_ooxml, "e": unescape_ooxml}
            head = {c: text[t](v) for c, t, v in reversed(cells) if t in text}
            while isinstance(head.get(0), str) and head.get(last + 1) == f"{head[0]}+{last + 1}":
                last += 1
        elif number != header:
            seen = -1
            for c, t, v in cells:
                if seen < c <= last:  # of cells that claim one place the first counts
                    column.add(number, t, v)
                    seen = c
    return column


def column_rows(content: bytes, text_only: bool = False) -> Iterator[tuple[int, object]]:
    """``(row number, value)`` of the first column (A) of the first sheet, data
    rows only (the first row is the header), in row order. Strings stay ``str``; numbers come
    back as ``float``, booleans as ``bool``; empty cells are omitted.

    The sheet is read row by row and only column A (and the columns its long texts go on in) is kept, as
    numbers and one text buffer; of the shared strings only those in use. Nothing is yielded before the
    whole sheet has been read and checked, so a damaged file yields nothing, nor does one with a value that
    is no text, with ``text_only``.
    """
    z = zipfile.ZipFile(io.BytesIO(content))
    try:
        column = _read_column(z, _numbered(z, _parts(z)))
    except _Disorder:  # no program writes rows out of order, but a file may hold them so
        column = _read_column(z, iter(sorted(_numbered(z, _parts(z), check=False), key=lambda r: r[0])))
    at, n = 0, len(column.row)
    if text_only and column.others:
        for i in range(n):
            if (i == 0 or column.row[i] != column.row[i - 1]) and -column.ref[i] - 1 in column.others:
                raise TypeError(f"non-text cell in row {column.row[i]}: {column.own(column.ref[i])!r}")
    texts = _shared(z, {r for r in column.ref if r >= 0})
    while at < n:
        number, value = column.row[at], None
        while at < n and column.row[at] == number:
            ref = column.ref[at]
            part = texts[ref] if ref >= 0 else column.own(ref)
            if value is None:
                value = part
            elif isinstance(value, str) and isinstance(part, str):
                value += part
            at += 1
        yield number, value


def parse_first_column(content: bytes) -> list[tuple[int, object]]:
    """All rows of :func:`column_rows`."""
    return list(column_rows(content))


CHUNK_ROWS = 20_000


def read_sheets(files: DataFrame, na_strings=NA_STRINGS, non_string: str = "fail") -> DataFrame:
    """Sheet rows ``(path, file_name, row_pos, cell, error)``.

    ``na_strings`` become missing before anything else. A non-string cell
    fails its whole file with ``non_string="fail"`` (one row carrying
    ``error``); ``"cast"`` keeps it as text. A file that cannot be parsed is
    also isolated as one error row; the other files are unaffected.
    """
    na = set(na_strings or ())

    def kept(rows):
        for rnum, v in rows:
            if not isinstance(v, str):
                yield rnum, _num_text(v)
            elif v not in na:
                yield rnum, v

    def frame(path, name, rows, error=None) -> pd.DataFrame:
        return pd.DataFrame({"path": path, "file_name": name, "row_pos": pd.Series([r for r, _ in rows], dtype="Int64"),
                             "cell": pd.Series([v for _, v in rows], dtype=object), "error": error}, columns=["path", "file_name", "row_pos", "cell", "error"])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, name, content in zip(pdf["path"], pdf["file_name"], pdf["content"]):
                try:
                    # a bad file or cell fails here, before a row is given out
                    rows = kept(column_rows(bytes(content), text_only=non_string != "cast"))
                    chunk = list(itertools.islice(rows, CHUNK_ROWS))
                except Exception as e:  # noqa: BLE001 - per-file isolation
                    yield frame(path, name, [(None, None)], f"{type(e).__name__}: {e}")
                    continue
                while chunk:
                    yield frame(path, name, chunk)
                    chunk = list(itertools.islice(rows, CHUNK_ROWS))

    return files.select("path", "file_name", "content").mapInPandas(parse, ROW_SCHEMA)


def _num_text(v) -> str:
    if isinstance(v, bool):
        return str(v)
    return str(int(v)) if float(v).is_integer() else repr(v)


def split_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    ok = rows.filter(F.col("error").isNull()).drop("error")
    rejects = rows.filter(F.col("error").isNotNull()).select("path", "file_name", "error")
    return ok, rejects


def _part_name(name_col: str, part_col: str):
    """``x.xlsx`` -> ``x_<k>.xlsx`` for parts after the first (the name keeps its
    intent prefix and polarity marker)."""
    stem = F.regexp_replace(F.col(name_col), r"\.xlsx$", "")
    return (F.when(F.col(part_col) == 0, F.col(name_col))
             .otherwise(F.concat(stem, F.lit("_"), F.col(part_col).cast("string"), F.lit(".xlsx"))))


def write_sheets(rows: DataFrame, directory: str, name_col: str = "file_name", cell_col: str = "cell",
                 order_col: str = "row_pos", header: str = "text",
                 max_rows_per_sheet: int = MAX_SHEET_ROWS - 1,
                 max_bytes_per_sheet: int = MAX_SHEET_BYTES) -> DataFrame:
    """Write one .xlsx per ``name_col`` value into ``directory`` (any filesystem
    pyarrow reaches: local, HDFS, object stores); cells in ``order_col`` order.

    A worksheet holds at most ``max_rows_per_sheet`` data rows (the format's
    limit minus the header) and ``max_bytes_per_sheet`` of text. A larger group
    is cut, in order, into numbered parts ``<name>_<k>.xlsx`` by distributed
    running sums of rows and bytes, so no task ever holds more than one bounded
    sheet (or one longer row) and no row is dropped.
    Returns ``(file_name, n_rows, n_bytes)`` per written file.
    """
    rows = rows.select(name_col, cell_col, order_col)
    size = F.coalesce(F.octet_length(cell_col), F.lit(0)).cast("long")
    per = rows.groupBy(name_col).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b"))
    biggest = per.agg(F.max("n").alias("n"), F.max("b").alias("b")).first()
    if (biggest["n"] or 0) > max_rows_per_sheet or (biggest["b"] or 0) > max_bytes_per_sheet:
        from utterspark.operators.ranking import running_totals

        summed = running_totals(rows.select("*", F.lit(1).cast("long").alias("_one"), size.alias("_b")), [order_col, cell_col],
                                ["_one", "_b"], [name_col], total_prefix=None)
        # both terms only grow and each grows by at most 1 within a part
        part = F.floor((F.col("cum__one") - 1) / F.lit(float(max_rows_per_sheet))
                       + (F.col("cum__b") - F.col("_b")) / F.lit(float(max_bytes_per_sheet))).cast("long")
        rows = (summed.withColumn("_part", part)
                      .select(_part_name(name_col, "_part").alias(name_col), cell_col, order_col))
    base = directory.rstrip("/")

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        import pyarrow.fs as pafs

        pdf = pdf.sort_values(order_col, kind="stable")
        name = pdf[name_col].iloc[0]
        cells = [None if pd.isna(v) else v for v in pdf[cell_col]]
        data = sheet_bytes(header, cells)
        if base.startswith("file:"):
            fs, root = pafs.LocalFileSystem(), "/" + re.sub(r"^file:/*", "", base)
        elif "://" in base:
            fs, root = pafs.FileSystem.from_uri(base)
        else:
            fs, root = pafs.LocalFileSystem(), base
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{name}") as out:
            out.write(data)
        return pd.DataFrame({"file_name": [name], "n_rows": [len(cells)], "n_bytes": [len(data)]})

    return rows.groupBy(name_col).applyInPandas(write, "file_name string, n_rows long, n_bytes long")
