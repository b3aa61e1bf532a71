import os

import pytest

from pyspark.sql import functions as F

from tests.xlsx_writer import write_xlsx
from utterspark.sources.sheets import write_sheets
from utterspark.sources.xlsx import escape_ooxml, unescape_ooxml
from utterspark.operators.corpus import dedup, to_utterances
from utterspark.sources.sheets import corpus_files, parse_first_column, read_sheets, split_rejects


def _make_corpus(d):
    write_xlsx(os.path.join(d, "Phone_call_[contact_name]_validated_20250310_1200.xlsx"),
               [["utterance", "score"], ["Call mom", 5], ["  Call mom  ", 4], ["NA", 1], [None, 1],
                ["　", 2], ["None", 3], ["打电话给妈妈", 5]])
    write_xlsx(os.path.join(d, "Take a picture_validated_20250310.xlsx"),
               [["text"], ["take a photo"], ["take a photo"]], inline=True)
    write_xlsx(os.path.join(d, "Take a picture_validated_negative_20250310.xlsx"),
               [["text"], ["how do I take a photo?"], ["take a photo"]])
    write_xlsx(os.path.join(d, "Battery_check_validated_20250310.xlsx"),
               [["text"], ["battery level"], [42]])
    write_xlsx(os.path.join(d, "notes.xlsx"), [["x"], ["ignored"]])
    with open(os.path.join(d, "Broken_validated_1.xlsx"), "wb") as f:
        f.write(b"not a zip")


def test_read_sheets_end_to_end(spark, tmp_dir):
    _make_corpus(tmp_dir)
    files = corpus_files(spark, tmp_dir)
    names = sorted(r["file_name"] for r in files.collect())
    assert "notes.xlsx" not in names and len(names) == 5
    assert "Phone_call_[contact_name]_validated_20250310_1200.xlsx" in names
    ok, rejects = split_rejects(read_sheets(files))
    bad = {r["file_name"] for r in rejects.collect()}
    assert bad == {"Battery_check_validated_20250310.xlsx", "Broken_validated_1.xlsx"}
    utts = dedup(to_utterances(ok), "file")
    got = sorted((r["intent"], r["is_negative"], r["text"]) for r in utts.collect())
    assert got == [
        ("INVALID", True, "how do I take a photo?"),
        ("INVALID", True, "take a photo"),
        ("Phone_call_[contact_name]", False, "Call mom"),
        ("Phone_call_[contact_name]", False, "打电话给妈妈"),
        ("Take a picture", False, "take a photo"),
    ]


def test_cast_option_keeps_numeric_cells(spark, tmp_dir):
    write_xlsx(os.path.join(tmp_dir, "Timer_validated_1.xlsx"), [["h"], [42], [1.5], ["ok"]])
    rows = read_sheets(corpus_files(spark, tmp_dir), non_string="cast")
    assert sorted(r["cell"] for r in rows.collect()) == ["1.5", "42", "ok"]


def test_missing_directory_is_empty(spark, tmp_dir):
    assert corpus_files(spark, os.path.join(tmp_dir, "nope")).count() == 0


def test_negatives_read_without_positives(spark, tmp_dir):
    write_xlsx(os.path.join(tmp_dir, "Weather_validated_negative_1.xlsx"), [["h"], ["is it a good day"]])
    ok, rejects = split_rejects(read_sheets(corpus_files(spark, tmp_dir)))
    assert rejects.count() == 0
    assert to_utterances(ok).filter(F.col("intent") == "INVALID").count() == 1


def test_ooxml_escape_roundtrip():
    for s in ["plain", "a\x0bb\x1c\r\n", "_x0041_ literal", "퟿", "tab\there"]:
        assert unescape_ooxml(escape_ooxml(s)) == s


def test_write_then_read_sheets(spark, tmp_dir):
    rows = spark.createDataFrame(
        [("A_validated_1.xlsx", 1, "hello"), ("A_validated_1.xlsx", 3, "ctrl\x0bchar\r\nx"),
         ("A_validated_1.xlsx", 2, None), ("B_validated_negative_1.xlsx", 7, "  _x0041_ ")],
        "file_name string, row_pos long, cell string")
    written = {r["file_name"]: r["n_rows"] for r in write_sheets(rows, tmp_dir).collect()}
    assert written == {"A_validated_1.xlsx": 3, "B_validated_negative_1.xlsx": 1}
    back = read_sheets(corpus_files(spark, tmp_dir)).collect()
    got = sorted((r["file_name"], r["row_pos"], r["cell"]) for r in back)
    assert got == [("A_validated_1.xlsx", 2, "hello"), ("A_validated_1.xlsx", 4, "ctrl\x0bchar\r\nx"),
                   ("B_validated_negative_1.xlsx", 2, "  _x0041_ ")]


def test_hot_sheet_is_cut_into_bounded_parts(spark, tmp_dir):
    hot = [("Hot_validated_negative_1.xlsx", i, f"u{i}") for i in range(7)]
    rows = spark.createDataFrame(hot + [("Cold_validated_1.xlsx", 0, "c")],
                                 "file_name string, row_pos long, cell string")
    written = {r["file_name"]: r["n_rows"] for r in write_sheets(rows, tmp_dir, max_rows_per_sheet=3).collect()}
    assert written == {"Hot_validated_negative_1.xlsx": 3, "Hot_validated_negative_1_1.xlsx": 3,
                       "Hot_validated_negative_1_2.xlsx": 1, "Cold_validated_1.xlsx": 1}
    back = read_sheets(corpus_files(spark, tmp_dir))
    cells = sorted(r["cell"] for r in back.collect())
    assert cells == sorted([c for _, _, c in hot] + ["c"])  # every row, once
    parts = {r["file_name"]: r for r in to_utterances(back).select(
        F.col("source_file").alias("file_name"), "intent", "is_negative").distinct().collect()}
    assert all(r["intent"] == "INVALID" and r["is_negative"] for n, r in parts.items() if "Hot" in n)
    first = sorted((r["file_name"], r["row_pos"], r["cell"]) for r in back.collect()
                   if r["file_name"] == "Hot_validated_negative_1.xlsx")
    assert [c for _, _, c in first] == ["u0", "u1", "u2"]  # order kept across parts


def _raw_sheet(rows_xml, shared=()):
    import io
    import zipfile

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
                   '<sheets><sheet name="s" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        if shared:
            z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">' + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>")
        with z.open("xl/worksheets/sheet1.xml", "w") as f:
            f.write(f'<worksheet xmlns="{main}"><sheetData>'.encode())
            for r in rows_xml:
                f.write(r.encode())
            f.write(b"</sheetData></worksheet>")
    return out.getvalue()


def test_rows_out_of_order_and_places_claimed_twice():
    text = lambda ref, t: f'<c r="{ref}" t="inlineStr"><is><t>{t}</t></is></c>'
    rows = [f'<row r="1">{text("A1", "h")}</row>', f'<row r="4">{text("A4", "four")}{text("A4", "again")}</row>', f'<row r="2">{text("B2", "b")}{text("A2", "two")}</row>',
            '<row r="3"><c r="A3" t="s"><v>1</v></c></row>', '<row r="6"><c r="B6"><v>7</v></c></row>']
    assert parse_first_column(_raw_sheet(rows, ["unused", "three"])) == [(2, "two"), (3, "three"), (4, "four")]


def test_a_shared_string_that_is_missing_rejects_the_file():
    rows = ['<row r="1"><c t="s"><v>0</v></c></row>', '<row r="2"><c t="s"><v>5</v></c></row>']
    with pytest.raises(IndexError):
        parse_first_column(_raw_sheet(rows, ["h", "x"]))


def test_chunks_and_no_rows_from_a_file_with_a_bad_cell(spark, monkeypatch):
    from utterspark.sources import sheets

    monkeypatch.setattr(sheets, "CHUNK_ROWS", 3)
    good = _raw_sheet([f'<row><c t="str"><v>t{i}</v></c></row>' for i in range(11)])
    bad = _raw_sheet([f'<row><c t="str"><v>t{i}</v></c></row>' for i in range(10)] + ["<row><c><v>7</v></c></row>"])
    files = spark.createDataFrame([("p/g_validated_.xlsx", "g", good), ("p/b_validated_.xlsx", "b", bad)], "path string, file_name string, content binary")
    rows = read_sheets(files).collect()
    assert [(r.row_pos, r.cell) for r in rows if r.file_name == "g"] == [(i + 1, f"t{i}") for i in range(1, 11)]
    wrong = [r for r in rows if r.file_name == "b"]
    assert len(wrong) == 1 and wrong[0].cell is None and "row 11" in wrong[0].error


_MILLION = """
import resource, sys
sys.path.insert(0, {root!r})
from tests.test_sheets import _raw_sheet
from utterspark.sources.sheets import column_rows
content = _raw_sheet((f'<row r="{{i}}"><c r="A{{i}}" t="s"><v>{{i % 5000}}</v></c><c r="B{{i}}"><v>{{i}}</v></c></row>' for i in range(1, 1_000_001)),
                     [f"text number {{i}} of the shared strings" for i in range(5000)])
n = sum(1 for _ in column_rows(content))
print(n, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""


def test_a_million_rows_under_300_megabytes():
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", _MILLION.format(root=root)], capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) == 999_999 and int(out[1]) < 300
