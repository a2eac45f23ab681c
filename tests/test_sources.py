from datetime import datetime as dt

import pytest

from monthglass.operators.features import KEYS
from monthglass.operators.temporal import feature_label_join
from monthglass.plans import stages as st
from monthglass.plans.views import view
from monthglass.sources import stores, tables
from monthglass.sources.registry import source
from monthglass.streaming.ingest import ingest_new_files

SF = "/root/testdata/sf0.01"


def month_rows(spark, rows):
    return spark.createDataFrame(rows, "Customer_ID string, snapshot_date timestamp, x int")


def test_only_the_months_present_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_monthly(month_rows(spark, [("a", dt(2023, 1, 1), 1), ("a", dt(2023, 2, 1), 1), ("b", None, 1)]), path)
    tables.write_monthly(month_rows(spark, [("c", dt(2023, 2, 1), 2)]), path)
    got = sorted((r.Customer_ID, r.x) for r in tables.read_table(spark, path).collect())
    assert got == [("a", 1), ("b", 1), ("c", 2)]
    assert (tmp_path / "t" / "year_month=NaT").is_dir()
    one = tables.read_month(spark, path, "2023-02")
    assert one.columns == ["Customer_ID", "snapshot_date", "x"] and one.count() == 1
    with pytest.raises(ValueError):
        tables.read_month(spark, path, "2024-01")


def test_table_without_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_monthly(spark.range(3), path)
    assert tables.read_table(spark, path).count() == 3


def test_csv_quotes_and_missing_words(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Customer_ID,Name\nC1,"say ""hi"", you"\nC2,NA\nC3,na\nC4,\n')
    rows = {r.Customer_ID: r.Name for r in tables.read_raw(spark, str(tmp_path / "a.csv")).collect()}
    assert rows == {"C1": 'say "hi", you', "C2": None, "C3": "na", "C4": None}
    with pytest.raises(Exception, match="(?i)not.*exist|path"):
        tables.read_raw(spark, str(tmp_path / "none.csv"))


def test_unknown_source():
    assert source("loans").keys == ("loan_id", "Customer_ID", "snapshot_date")
    with pytest.raises(ValueError):
        source("nope")


def test_map_columns_become_json(spark, tmp_path):
    df = spark.createDataFrame([(dt(2023, 1, 1), {"a": 0.5})], "snapshot_date timestamp, psi_scores map<string,double>")
    stores.write_csv(df, str(tmp_path / "m"))
    back = stores.read_csv(spark, str(tmp_path / "m"), "snapshot_date timestamp, psi_scores string").first()
    assert (back.snapshot_date, back.psi_scores) == (dt(2023, 1, 1), '{"a":0.5}')


def test_new_files_only(spark, tmp_path):
    raw, path, mark = (str(tmp_path / n) for n in ("raw", "table", "mark"))
    (tmp_path / "raw").mkdir()

    def deliver(name, lines):
        (tmp_path / "raw" / name).write_text("Customer_ID,snapshot_date,x\n" + "\n".join(lines) + "\n")
        ingest_new_files(spark, ["Customer_ID", "snapshot_date", "x"], raw, path, mark).awaitTermination()

    deliver("a.csv", [f"C{i},2023-0{1 + i % 2}-01,1" for i in range(120)])
    deliver("b.csv", [f"C{i},2023-02-01,NA" for i in range(100)])
    got = tables.read_table(spark, path).groupBy("snapshot_date", "x").count().collect()
    assert {(r.snapshot_date.month, r.x): r["count"] for r in got} == {(1, "1"): 60, (2, "1"): 60, (2, None): 100}
    assert tables.read_month(spark, path, "2023-01").count() == 60


def test_streamed_rows_join_the_batch_rows(spark, tmp_path):
    raw, path, mark = (str(tmp_path / n) for n in ("raw", "table", "mark"))
    (tmp_path / "raw").mkdir()
    batch = month_rows(spark, [(f"B{i}", dt(2023, 1 + i % 2, 1), i) for i in range(50)]).selectExpr("Customer_ID", "snapshot_date", "string(x) x")
    tables.write_monthly(batch, path)
    (tmp_path / "raw" / "a.csv").write_text("Customer_ID,snapshot_date,x\n" + "".join(f"S{i},2023-02-01,{i}\n" for i in range(7)))
    take = lambda m: ingest_new_files(spark, ["Customer_ID", "snapshot_date", "x"], raw, path, m).awaitTermination()
    take(mark)
    assert tables.read_table(spark, path).count() == 57
    assert tables.read_month(spark, path, "2023-02").count() == 32
    # The last batch is run again: its mark of completion is lost, its rows are not doubled.
    for f in (tmp_path / "mark" / "commits").iterdir():
        f.unlink()
    take(mark)
    assert tables.read_table(spark, path).count() == 57
    tables.write_monthly(batch, path)
    assert tables.read_table(spark, path).distinct().count() == 57
    # A second stream into the same table has numbers of its own.
    take(str(tmp_path / "other"))
    assert tables.read_table(spark, path).count() == 64


def test_headers_that_differ_fail(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_text("id,amount\n1,10\n")
    (tmp_path / "raw" / "b.csv").write_text("amount,id\n999,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_raw(spark, str(tmp_path / "raw")).collect()
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_raw(spark, str(tmp_path / "raw" / "a.csv"), columns=["id", "sum"]).collect()
    assert tables.read_raw(spark, str(tmp_path / "raw" / "a.csv"), columns=["id", "amount"]).first().amount == "10"


def test_local_staging_only_with_a_local_master(spark, tmp_path, monkeypatch):
    from types import SimpleNamespace

    from monthglass import session

    far = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d), sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError, match="checkpoint"):
        session.staging_path(far, "x")
    with session.staged_files(spark):
        rows = session.stage_table(spark.range(5), "five")
        where = rows.inputFiles()[0].removeprefix("file://")
        assert rows.count() == 5
    import os

    assert not os.path.exists(where)


def test_whole_run(spark, tmp_path):
    """Raw CSV to monitoring tables on the test data, with the four source files written first."""
    folders = st.Folders(str(tmp_path / "raw"), str(tmp_path / "base"))
    frames = {
        "clickstream": view(spark, SF, "click_months"),
        "attributes": view(spark, SF, "attr_snapshots"),
        "financials": view(spark, SF, "fin_snapshots"),
        "loans": view(spark, SF, "loan_snapshots"),
    }
    for name, df in frames.items():
        df.write.option("header", True).csv(f"{folders.raw}/{source(name).file}")
    with pytest.raises(ValueError, match="failed to ingest"):
        st.ingest_all(spark, st.Folders(str(tmp_path / "nothing"), folders.base))
    st.ingest_all(spark, folders)
    st.refine_all(spark, folders)
    attributes = tables.read_table(spark, folders.silver("attributes"))
    assert attributes.where("Age < 18 or Age > 75").count() == 0
    st.write_stores(spark, folders)
    rows = st.labelled_rows(spark, folders)
    assert rows.where("label_snapshot_date <> feature_snapshot_date + interval 6 month").count() == 0
    assert not {"dpd", "overdue_amt"} & set(rows.columns)

    quick = {"logistic_regression": {"max_iter": [5]}, "random_forest": {"n_estimators": 3, "max_depth": [2]}}
    trained = st.train_models(
        spark, folders, "20240101_000000", None, None, ["logistic_regression", "random_forest", "nope"], quick, strict=False
    )
    assert set(trained.models) == {"logistic_regression", "random_forest"} and "nope" in trained.failures
    assert trained.best()["roc_auc"] == max(r["roc_auc"] for r in trained.results)
    for r in trained.results:
        (tn, fp), (fn, tp) = r["confusion_matrix"]
        assert tn + fp + fn + tp == r["test_samples"] and fn + tp == r["positive_class_count"]

    with pytest.raises(ValueError, match="nope"):
        st.train_models(spark, folders, "20240101_000000", None, None, ["logistic_regression", "nope"], quick)
    features = stores.read_store(spark, folders.gold("feature_store"))
    # Row by row, although keys repeat; on the keys alone each of k rows meets all k.
    assert rows.count() == features.count() == stores.read_store(spark, folders.gold("label_store")).count()
    by_key = feature_label_join(features, stores.read_store(spark, folders.gold("label_store")), by_key_only=True)
    assert by_key.count() == features.groupBy(*KEYS).count().selectExpr("sum(count * count)").first()[0] > rows.count()

    scores = st.score_all(spark, folders, "2024-01-01 00:00:00")
    assert scores.count() == stores.read_store(spark, folders.gold("feature_store")).count()
    top = scores.first()
    assert top.prediction_proba_0 + top.prediction_proba_1 == pytest.approx(1.0)
    assert top.prediction == int(top.prediction_proba_1 > 0.5)
    day = str(scores.agg({"feature_snapshot_date": "min"}).first()[0])
    assert st.score_snapshot(spark, folders, "2024-01-01 00:00:00", day).count() > 0
    with pytest.raises(ValueError, match="no rows"):
        st.score_snapshot(spark, folders, "2024-01-01 00:00:00", "1900-01-01")

    out = st.monitor(spark, folders)
    n = out["performance"].count()
    assert out["stability"].count() == n == out["dashboard"].count()
    assert out["performance_long"].count() == 5 * n and out["stability_long"].count() == 6 * n
    assert out["alerts"].count() == n and out["drift_summary"].first().features == out["drift_report"].count()
    assert {r.half: r.n for r in out["quality_by_half"].collect()}.keys() == {"reference", "current"}
    assert sum(r.n for r in out["quality_by_half"].collect()) == scores.count()
    assert out["category_shares"].count() > 0
    assert out["drift_report"].where("kind = 'categorical'").count() > 0
    assert (tmp_path / "base" / "monitoring" / "performance_metrics" / "_SUCCESS").exists()

    # Month by month, the stability table is that of the whole run.
    months = sorted(r.m for r in scores.selectExpr("date_format(feature_snapshot_date, 'yyyy-MM') m").distinct().collect())
    st.monitor_months(spark, folders, months[0], months[-2])
    added = st.monitor_months(spark, folders, months[-1])
    rounded = lambda df: sorted((r.snapshot_date, round(r.mean_psi, 9), round(r.max_ks, 9), round(r.prediction_drift, 9)) for r in df.collect())
    assert rounded(added) == rounded(out["stability"]) and len(months) > 3
