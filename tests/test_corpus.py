from pyspark.sql import functions as F

from utterspark.operators import corpus as C


def test_polarity_and_intent_rules(spark):
    names = ["Phone_call_[contact_name]_validated_20250310_1200.xlsx",
             "拍照_validated_negative_20250310.xlsx", "Take a picture_validated_2025.xlsx",
             "noMarker.xlsx"]
    df = spark.createDataFrame([(n,) for n in names], "file_name string")
    out = {r["file_name"]: r for r in C.with_intent(C.with_polarity(df)).collect()}
    assert out[names[0]]["intent"] == "Phone_call_[contact_name]"
    assert out[names[0]]["is_negative"] is False
    assert out[names[1]]["intent"] == "拍照" and out[names[1]]["is_negative"] is True
    assert out[names[2]]["intent"] == "Take a picture"
    assert out[names[3]]["intent"] == "noMarker.xlsx"


def test_polarity_uses_file_name_not_directory(spark):
    df = spark.createDataFrame([("/data/_negative_/Battery_validated_2025.xlsx",)], "path string")
    df = df.withColumn("file_name", F.substring_index("path", "/", -1))
    assert C.with_polarity(df).first()["is_negative"] is False


def test_legacy_intent_rule(spark):
    paths = ["dataset/Volume_up_validated_20250310_1200.xlsx", "a_b.xlsx"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    out = {r["path"]: r["intent"] for r in C.with_intent(df, "path", "drop_last_3").collect()}
    for p in paths:
        assert out[p] == "_".join(p.split("_")[:-3])


def test_drop_blank_and_sentinel(spark):
    df = spark.createDataFrame([("a",), (None,), ("unknown",)], "text string")
    assert C.drop_blank(df).count() == 2
    assert [r[0] for r in C.drop_blank(df, sentinel="unknown").collect()] == ["a"]


def _utts(spark, rows):
    return spark.createDataFrame(rows, "text string, intent string, is_negative boolean, "
                                       "source_file string, row_pos long")


def test_dedup_scopes(spark):
    u = _utts(spark, [("hi", "A", False, "f1", 2), ("hi", "A", False, "f1", 5),
                      ("hi", "A", False, "f2", 1), ("hi", "INVALID", True, "f3", 1)])
    per_file = C.dedup(u, "file").collect()
    assert len(per_file) == 3
    assert {(r["source_file"], r["row_pos"]) for r in per_file} == {("f1", 2), ("f2", 1), ("f3", 1)}
    per_intent = C.dedup(u, "intent").collect()
    assert len(per_intent) == 2
    first = [r for r in per_intent if r["intent"] == "A"][0]
    assert (first["source_file"], first["row_pos"]) == ("f1", 2)


def test_dedup_hot_group(spark):
    rows = [("same", "A", False, "f", i) for i in range(3000)] + \
           [(f"t{i}", "A", False, "f", 10_000 + i) for i in range(6000)]
    u = _utts(spark, rows).repartition(16)
    d = C.dedup(u, "file")
    assert d.count() == 6001
    assert d.filter(F.col("text") == "same").first()["row_pos"] == 0


def test_accept_scored_edges(spark):
    u = _utts(spark, [("a", "X", False, "f", 1), ("b", "X", False, "f", 2), ("c", "INVALID", True, "f", 3),
                      ("d", "INVALID", True, "f", 4), ("e", "X", False, "f", 5)])
    scores = spark.createDataFrame([
        ("a", "X", False, 1, 4), ("a", "X", False, 2, 5),   # both > 3 -> keep
        ("b", "X", False, 1, 4), ("b", "X", False, 2, 3),   # equal to cutoff -> drop
        ("c", "INVALID", True, 1, 3), ("c", "INVALID", True, 2, 3),  # negative cutoff 2 -> keep
        ("d", "INVALID", True, 1, 5), ("d", "INVALID", True, 2, None),  # missing score -> drop
        ("e", "X", False, 1, 5)],  # only one score -> drop
        "text string, intent string, is_negative boolean, scorer int, score int")
    kept = sorted(r["text"] for r in C.accept_scored(u, scores).collect())
    assert kept == ["a", "c"]


def test_increment_adds_only_new(spark):
    u = _utts(spark, [("a", "X", False, "f", 1)])
    b = _utts(spark, [("a", "X", False, "g", 1), ("z", "NEW", False, "g", 2)])
    out = C.increment(u, b)
    assert sorted((r["text"], r["intent"]) for r in out.collect()) == [("a", "X"), ("z", "NEW")]


def test_cross_split_duplicates(spark):
    rows = [("hi", "a", "train"), ("hi", "a", "test"),       # leaks across splits
            ("yo", "a", "train"), ("yo", "INVALID", "train"),  # contradictory labels
            ("ok", "b", "train"), ("ok", "b", "train"),       # same split, same label: fine
            ("solo", "c", "valid")]
    df = spark.createDataFrame(rows, "text string, intent string, split string")
    got = {r["text"]: (r["n_rows"], r["n_splits"], r["n_intents"])
           for r in C.cross_split_duplicates(df).collect()}
    assert got == {"hi": (2, 2, 1), "yo": (2, 1, 2)}


def test_legacy_utterances(spark):
    rows = [("data/Play_music_validated_20250310_1200.xlsx", 2, "  play  "),
            ("data/Play_music_validated_20250310_1200.xlsx", 3, "unknown"),   # equal to the sentinel
            ("data/Play_music_validated_20250310_1200.xlsx", 4, "　"),
            ("data/_negative_/Pause_validated_20250310_1200.xlsx", 2, "pause"),  # directory flips it
            ("data/Pause_validated_negative_20250310_1200.xlsx", 2, "no")]
    df = spark.createDataFrame(rows, "path string, row_pos long, cell string")
    got = [(r["text"], r["intent"], r["is_negative"]) for r in C.to_legacy_utterances(df).collect()]
    assert got == [("play", "data/Play_music", False)]


def test_embedding_flow_intent_rule(spark):
    rows = [("data/x_y/Play_music_validated_20250310_1200.xlsx", "Play_music_validated_20250310_1200.xlsx", 2, " a "),
            ("data/Pause_validated_negative_1.xlsx", "Pause_validated_negative_1.xlsx", 2, "b")]
    df = spark.createDataFrame(rows, "path string, file_name string, row_pos long, cell string")
    got = [(r["text"], r["intent"]) for r in C.to_legacy_utterances(df, intent_rule="validated").collect()]
    assert got == [("a", "Play_music")]
