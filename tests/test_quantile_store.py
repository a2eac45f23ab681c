"""Quantiles from stored summaries against numpy over all rows."""

from datetime import datetime as dt

import numpy as np
import pytest

from monthglass.operators import quantile_store as qs

rng = np.random.default_rng(41)
PROBS = [0.0, 0.01, 0.25, 0.5, 0.95, 1.0]
COLUMNS = ["x", "hot", "tiny", "none"]


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    data = []
    for m in range(8):
        for i in range(250):
            x = float(rng.normal(m))
            hot = 7.0 if i % 3 else float(rng.integers(0, 20))
            data.append((dt(2023, 1 + m, 1 + i % 28), x if i % 11 else (None if i % 2 else float("nan")), hot, float(m) if i == 5 else None, None))
    path = str(tmp_path_factory.mktemp("q") / "t")
    spark.createDataFrame(data, "d timestamp, x double, hot double, tiny double, none double").repartition(3).write.parquet(path)
    return spark.read.parquet(path), data


def want(data, last=8):
    out = {}
    for k, c in enumerate(COLUMNS, 1):
        v = [r[k] for r in data if r[k] is not None and r[k] == r[k] and r[0].month <= last]
        out[c] = np.quantile(v, PROBS).tolist() if v else [None] * len(PROBS)
    return out


def same(got, expected):
    assert got.keys() == expected.keys()
    for c in got:
        assert got[c] == (pytest.approx(expected[c]) if expected[c][0] is not None else expected[c]), c


@pytest.mark.parametrize("ranges", [1, 8, 256])
def test_quantiles_of_added_months(spark, rows, tmp_path, ranges):
    df, data = rows
    # Cut on the first month alone, from which the later ones move away.
    store = qs.start(spark, str(tmp_path / "s"), df.where("month(d) = 1"), COLUMNS, ranges)
    qs.add(store, df, "d", "2023-01", "2023-05")
    same(qs.stored_quantiles(store, df.where("month(d) <= 5"), PROBS), want(data, 5))
    for month in (6, 7, 8, 7):
        qs.add(qs.QuantileStore(spark, str(tmp_path / "s")), df, "d", f"2023-0{month}")
    same(qs.stored_quantiles(store, df, PROBS), want(data))
    near = {r.feature: r for r in qs.estimates(store, [0.25, 0.5]).collect()}
    assert set(near) == {"x", "hot", "tiny"} and near["x"].n == sum(1 for r in data if r[1] is not None and r[1] == r[1])
    assert near["x"].quantiles == pytest.approx(want(data)["x"][2:4], abs=0.3)


def test_only_the_wanted_ranges_are_read(spark, rows, tmp_path, monkeypatch):
    df, data = rows
    store = qs.start(spark, str(tmp_path / "s"), df, ["x"], 64)
    qs.add(store, df, "d", "2023-01", "2023-08")
    seen = []
    sizes = qs._range_sizes
    monkeypatch.setattr(qs, "_range_sizes", lambda sub, wanted: seen.append(sub) or sizes(sub, wanted))
    assert qs.stored_quantiles(store, df, [0.5])["x"] == pytest.approx([want(data)["x"][3]])
    (sub,) = seen
    plan = sub._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<x:double>" in plan and "GreaterThanOrEqual(x," in plan and "LessThan(x," in plan
    assert sub.count() < 250


def test_empty_store(spark, rows, tmp_path):
    df, _ = rows
    store = qs.start(spark, str(tmp_path / "s"), df.limit(0), ["x"])
    qs.add(store, df.where("month(d) = 99"), "d", "2023-01")
    qs.add(store, df, "d", "2023-02")
    v = [r[1] for r in rows[1] if r[0].month == 2 and r[1] is not None and r[1] == r[1]]
    assert qs.stored_quantiles(store, df.where("month(d) = 2"), [0.5])["x"] == pytest.approx([np.median(v)])
