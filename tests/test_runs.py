"""Run folders: complete or invisible, models of both flows, tables and documents; empty corpora."""

import pytest

from utterspark.operators import training as T
from utterspark.sources import runs as R


def small(spark):
    rows = [(f"u{i}", ["red green", "blue sky", "tall tree"][i % 3] + f" w{i % 5}", i % 3, i % 3 == 0, [float(i % 3), float(i % 2)]) for i in range(60)]
    return spark.createDataFrame(rows, "uid string, text string, label_idx int, is_negative boolean, vector array<double>")


def test_models_of_both_flows_tables_and_document(spark, tmp_dir):
    df = small(spark)
    weighted, ovr = T.fit_weighted(df, max_iter=5, num_features=64), T.fit_ovr(df, max_iter=5)
    run = R.Run.start(spark, tmp_dir)
    run.add_model("weighted", weighted)
    run.add_model("ovr", ovr)
    written = run.add_table("labels", spark.createDataFrame([("a", 0)], "label string, idx int"))
    run.add_document("metrics", spark.createDataFrame([('{"accuracy": 0.5, "name": "é"}',)], "document string"))
    assert R.finished_runs(spark, tmp_dir) == [] and written.count() == 1
    run.finish(seed=42)
    back = R.latest_run(spark, tmp_dir)
    assert back.folder == run.folder and back.manifest["about"] == {"seed": 42}
    assert back.document("metrics") == {"accuracy": 0.5, "name": "é"}
    assert [tuple(r) for r in back.table("labels").collect()] == [("a", 0)]
    of = lambda m: sorted((r.uid, tuple(r.p)) for r in T.score(m, df).collect())
    assert of(back.model("weighted")) == of(weighted)
    raw = lambda m: sorted((r.uid, tuple(r.raw)) for r in T.ovr_margins(m, df).collect())
    assert raw(back.model("ovr")) == raw(ovr)
    for call in (lambda: back.model("labels"), lambda: back.table("ovr"), lambda: back.table("nothing"), lambda: back.document("labels")):
        with pytest.raises(KeyError):
            call()
    with pytest.raises(ValueError):
        back.add_table("more", df)


def test_a_run_killed_half_way_is_invisible(spark, tmp_dir, monkeypatch):
    first = R.Run.start(spark, tmp_dir)
    first.add_table("labels", spark.range(3))
    first.finish()
    second = R.Run.start(spark, tmp_dir)
    second.add_table("labels", spark.range(9))
    monkeypatch.setattr(R._Files, "write_last", lambda self, p, text: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        second.finish()
    assert [r.folder for r in R.finished_runs(spark, tmp_dir)] == [first.folder]
    assert R.latest_run(spark, tmp_dir).table("labels").count() == 3


def test_runs_are_listed_in_order_and_parts_are_unique(spark, tmp_dir):
    made = [R.Run.start(spark, tmp_dir).finish(i=i) for i in range(3)]
    assert [r.manifest["about"]["i"] for r in R.finished_runs(spark, tmp_dir)] == [0, 1, 2]
    assert len({r.folder for r in made}) == 3
    run = R.Run.start(spark, tmp_dir)
    run.add_table("t", spark.range(1))
    with pytest.raises(ValueError):
        run.add_table("t", spark.range(1))
    with pytest.raises(ValueError):
        run.add_model("m", object())


def test_no_run_and_no_corpus(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        R.latest_run(spark, f"{tmp_dir}/nowhere")
    with pytest.raises(R.EmptyCorpus, match="no sheets"):
        R.require_rows(spark.range(0), "sheets")
    assert R.require_rows(spark.range(1), "sheets").count() == 1


def test_an_empty_corpus_ends_the_run_with_a_message(spark, tmp_dir):
    from utterspark.plans.model_plans import weighted_fit

    spark.createDataFrame([], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    with pytest.raises(R.EmptyCorpus, match="labelled utterances"):
        weighted_fit(spark, tmp_dir)
