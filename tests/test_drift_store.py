"""Drift kept month by month against the same from all rows at once."""

from datetime import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthglass.operators import drift as dr
from monthglass.operators import drift_store as ds
from monthglass.sources import tables

rng = np.random.default_rng(23)
NAMES = ["mean_psi", "max_psi", "mean_ks", "max_ks", "prediction_drift", "label_drift"]


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    data = []
    for m in range(14):
        for _ in range(120):
            day = dt(2022 + m // 12, 1 + m % 12, int(rng.integers(1, 28)))
            x = None if rng.random() < 0.05 else float(rng.normal(m / 10))
            data.append((day, x, float(rng.integers(0, 4)), float(rng.random()), int(rng.random() < 0.3 + m / 50)))
    path = str(tmp_path_factory.mktemp("rows") / "t")
    df = spark.createDataFrame(data, "d timestamp, x double, k double, p double, y int")
    tables.write_monthly(df, path, "d")
    return spark.read.parquet(path).drop(tables.MONTH)


def table(df):
    out = {}
    for r in df.collect():
        out[r.snapshot_date] = ([getattr(r, c) for c in NAMES], r.reference_sample_count, r.current_sample_count, r.psi_scores, r.ks_scores)
    return out


def same(a, b):
    assert a.keys() == b.keys()
    for k, (numbers, *counts, psi, ks) in a.items():
        other, *others, psi2, ks2 = b[k]
        assert numbers == pytest.approx(other) and counts == others and psi == pytest.approx(psi2) and ks == pytest.approx(ks2)


def test_months_added_equal_one_run(spark, rows, tmp_path):
    whole = table(dr.stability_over_time(rows, "d", ["x", "k"], "p", "y"))
    store = ds.start(spark, str(tmp_path / "s"), rows, "d", ["x", "k"], "p", "y")
    ds.add(store, rows, "2022-01", "2022-10")
    assert len(table(ds.stability(store))) == 10
    for month in ("2022-11", "2022-12", "2023-01", "2023-02"):
        ds.add(ds.open_store(spark, str(tmp_path / "s")), rows, month)
    same(table(ds.stability(store)), whole)
    ds.add(store, rows, "2022-12")
    same(table(ds.stability(store)), whole)
    # A month delivered anew replaces its numbers, and no other month's.
    moved = rows.withColumn("x", F.when(F.month("d") == 12, F.col("x") + 9).otherwise(F.col("x")))
    ds.add(store, moved, "2022-12")
    got = table(ds.stability(store))
    changed = [k for k in got if got[k][0] != pytest.approx(whole[k][0])]
    assert [(k.year, k.month) for k in changed] == [(2022, 12)]


def test_counts_of_months_add_up(spark, rows, tmp_path):
    store = ds.start(spark, str(tmp_path / "s"), rows, "d", ["x", "k"], "p", "y")
    ds.add(store, rows, "2022-01", "2023-02")
    marked = dr.mark(rows, F.lit(False), F.date_trunc("quarter", "d"))
    ref, kept = store._fixed()
    direct = dr.bin_counts(ref, dr.unfold_cells(marked, kept["splits"])).withColumnRenamed(dr.WIN, "q")
    quarter = F.date_trunc("quarter", F.to_timestamp(F.concat("month", F.lit("-01")), "yyyy-MM-dd"))
    added = store._read("bins").groupBy(quarter.alias("q"), "feature", "bin").agg(F.sum("n").alias("n"))
    rows_of = lambda df: sorted(map(str, df.select("q", "feature", "bin", "n").collect()))
    assert rows_of(direct) == rows_of(added)


def test_adding_a_month_reads_that_month(spark, rows, tmp_path, monkeypatch):
    store = ds.start(spark, str(tmp_path / "s"), rows, "d", ["x"], "p", "y")
    staged, written = [], []
    stage, write = ds.stage_table, ds.DriftStore._write
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(ds, "stage_table", lambda df, name: staged.append(plan(df)) or stage(df, name))
    monkeypatch.setattr(ds.DriftStore, "_write", lambda self, df, t: written.append((t, plan(df))) or write(self, df, t))
    ds.add(store, rows, "2022-07")
    assert [t for t, _ in written] == ["sums", "bins", "ks"] and len(staged) == 1
    scans = [x for x in staged[0].splitlines() if "FileScan" in x]
    assert len(scans) == 1 and "GreaterThanOrEqual(d,2022-07-01" in scans[0] and "LessThan(d,2022-08-01" in scans[0]
    assert "ReadSchema: struct<d:timestamp,x:double,p:double,y:int>" in scans[0]
    source = rows.inputFiles()[0].split("/t/")[0]
    assert not any(source in text for _, text in written) and source not in plan(ds.stability(store))


def test_no_feature_has_values(spark, rows, tmp_path):
    empty = rows.withColumn("x", F.lit(None).cast("double"))
    store = ds.start(spark, str(tmp_path / "s"), empty, "d", ["x"], None, None)
    ds.add(store, empty, "2022-01", "2022-02")
    got = ds.stability(store).collect()
    assert len(got) == 2 and all(r.mean_psi is None and r.prediction_drift is None for r in got)
