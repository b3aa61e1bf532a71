from pyspark.sql import functions as F

from utterspark.functions.text import WHITESPACE_CHARS, clean_text, strip_punct, tokenize_mixed, tokenize_ws

EDGE = [" a b ", "　", "　x　", "\x1cq\x1f", "a  b", "  ", "", "x\x0by",
        "Phone_call_[contact_name]", "你好 世界", "Café, déjà-vu!", "\u0085tail\u0085"]


def test_whitespace_set_is_python_isspace():
    expected = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
    assert WHITESPACE_CHARS == expected
    assert len(WHITESPACE_CHARS) == 29


def test_clean_text_matches_python_strip(spark):
    df = spark.createDataFrame([(s,) for s in EDGE] + [(None,)], "t string")
    got = {r["t"]: r["c"] for r in df.select("t", clean_text("t").alias("c")).collect()}
    for s in EDGE:
        want = s.strip() or None
        assert got[s] == want, repr(s)
    assert got[None] is None


def test_all_single_whitespace_chars_strip(spark):
    rows = [(f"{ch}x{ch}",) for ch in WHITESPACE_CHARS]
    out = spark.createDataFrame(rows, "t string").select(clean_text("t").alias("c")).collect()
    assert all(r["c"] == "x" for r in out)


def test_tokenize_ws_matches_python_split(spark):
    df = spark.createDataFrame([(s,) for s in EDGE], "t string")
    for r in df.select("t", tokenize_ws("t").alias("k")).collect():
        assert r["k"] == r["t"].split(), repr(r["t"])


def test_strip_punct_keeps_letters_marks_numbers_space(spark):
    df = spark.createDataFrame([("Café, déjà-vu! 42 你好。",)], "t string")
    assert df.select(strip_punct("t")).first()[0] == "Café déjàvu 42 你好"


def test_tokenize_mixed_cjk_and_accents(spark):
    df = spark.createDataFrame([("Héllo 世界 abc123, x",)], "t string")
    assert df.select(tokenize_mixed("t")).first()[0] == ["Héllo", "世", "界", "abc123", "x"]
    df2 = spark.createDataFrame([(None,)], "t string")
    assert df2.select(F.size(tokenize_ws("t"))).first()[0] in (-1, None)
