import random
from collections import defaultdict
from datetime import datetime as dt
from datetime import timedelta

import pytest

from monthglass.operators import temporal as tm
from monthglass.operators import lookback as lb
from monthglass.operators.lookback import add_lookback, lookback


@pytest.fixture(scope="module")
def frames(spark):
    feats = spark.createDataFrame(
        [("C1", dt(2023, 1, 1), 1.0), ("C1", dt(2023, 2, 1), 2.0), ("C2", dt(2023, 8, 31), 3.0), (None, dt(2023, 1, 1), 4.0)],
        "Customer_ID string, snapshot_date timestamp, f double",
    )
    loans = spark.createDataFrame(
        [
            ("C1", dt(2023, 7, 1), 6, 30, 1.0),
            ("C1", dt(2023, 7, 1), 6, 29, 2.0),
            ("C1", dt(2023, 7, 1), 5, 99, 3.0),
            ("C1", dt(2023, 8, 1), 7, 99, 3.0),
            ("C2", dt(2024, 2, 29), 6, None, 4.0),
            (None, dt(2023, 7, 1), 6, 40, 5.0),
        ],
        "Customer_ID string, snapshot_date timestamp, mob int, dpd int, overdue_amt double",
    )
    return feats, loans


def test_label_join(frames):
    rows = tm.temporal_label_join(*frames).collect()
    got = sorted((r.Customer_ID, r.feature_snapshot_date, r.label_snapshot_date, r.label, r.dpd) for r in rows)
    assert [(r[0], r[3], r[4]) for r in got[:2]] == [("C1", 0, 29), ("C1", 1, 30)]
    # The last day of a month is cut to the shorter month; a missing dpd is no default.
    assert got[2] == ("C2", dt(2023, 8, 31), dt(2024, 2, 29), 0, None)
    assert len(got) == 3
    assert tm.temporal_label_join(*frames, null_safe=True).count() == 4


def test_no_leakage(frames):
    rows = tm.temporal_label_join(*frames).collect()
    assert all(r.label_snapshot_date > r.feature_snapshot_date for r in rows)


def test_coverage(frames):
    got = {r.feature_snapshot_date: r.has_label_date for r in tm.snapshot_coverage(*frames).collect()}
    # Any outcome at the date counts, whatever its months on book.
    assert got == {dt(2023, 1, 1): True, dt(2023, 2, 1): True, dt(2023, 8, 31): True}


def test_two_loans_give_four_rows(spark, frames):
    feats, loans = frames
    people = spark.createDataFrame([("C1", dt(2023, 1, 1), 30.0)], "Customer_ID string, snapshot_date timestamp, Age double")
    out = tm.join_attributes(tm.temporal_label_join(feats, loans), people, loans, ["Age"])
    assert sorted(r.dpd for r in out.collect()) == [29, 29, 30, 30]


def test_filters(frames):
    feats, _ = frames
    assert tm.in_date_range(feats, "snapshot_date", "2023-01-01", "2023-02-01").count() == 3
    assert tm.exact_snapshot(feats, "snapshot_date", "2023-02-01").count() == 1
    with pytest.raises(ValueError):
        tm.exact_snapshot(feats, "snapshot_date", "2020-01-01")


def brute(pairs, rows, k):
    by_key = defaultdict(list)
    for key, d, tie, x in rows:
        by_key[key].append((d, tie, x))
    out = {}
    for key, t in pairs:
        last = sorted(r for r in by_key[key] if r[0] <= t)[-k:]
        xs = [r[2] for r in last if r[2] is not None]
        if not last:
            out[key, t] = (0.0, 0.0, 0.0)
        else:
            out[key, t] = (sum(xs) / len(xs) if xs else None, max(xs) if xs else None, float(sum(xs)))
    return out


@pytest.mark.parametrize("cuts", [4096, 9, 2])
def test_lookback_against_brute_force(spark, cuts):
    rnd = random.Random(3)
    start = dt(2023, 1, 1)
    # A third of all rows belongs to one key.
    keys = ["hot"] * 10 + [f"k{i}" for i in range(20)]
    rows = [
        (rnd.choice(keys), start + timedelta(hours=rnd.randrange(24 * 40) // 6 * 6), i, None if rnd.random() < 0.2 else float(rnd.randrange(50)))
        for i in range(900)
    ]
    pairs = sorted({(rnd.choice([*keys, "absent"]), start + timedelta(days=rnd.randrange(-3, 45))) for _ in range(150)})
    hist = spark.createDataFrame(rows, "Customer_ID string, snapshot_date timestamp, tie int, x double")
    qs = spark.createDataFrame(pairs * 2, "Customer_ID string, feature_snapshot_date timestamp")
    found = lookback(qs, hist, ["x"], tie_break="tie", cuts=cuts).collect()
    got = {(r.Customer_ID, r.feature_snapshot_date): (r.x_mean, r.x_max, r.x_sum) for r in found}
    want = brute(pairs, rows, 6)
    assert len(found) == len(pairs) and set(got) == set(want)
    for p, w in want.items():
        assert got[p] == pytest.approx(w), p


@pytest.mark.parametrize("dates", [1, 20_000])
def test_lookback_limits_a_hot_key_before_the_shuffle(spark, dates, monkeypatch):
    hist = spark.createDataFrame([("a", dt(2023, 1, 1), 1.0)], "Customer_ID string, snapshot_date timestamp, x double")
    qs = spark.range(dates).selectExpr("'a' AS Customer_ID", "timestamp_seconds(1675209600 + id) AS feature_snapshot_date")
    # With the plans of what is stored on the way.
    parts, stage = [], lb.stage_table
    text = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(lb, "stage_table", lambda df, name: parts.append(text(df)) or stage(df, name))
    parts.append(text(lookback(qs, hist, ["x"])))
    plan = "\n".join(parts)
    assert "row_number(), 6, Partial" in plan
    # The rows themselves are never ordered over a whole key: only what is carried, k rows a piece.
    windows = [line for line in plan.splitlines() if "Window [" in line or "WindowGroupLimit" in line]
    assert windows and all("_piece" in line or "collect_list" in line for line in windows)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_lookback_boundaries(spark):
    hist = spark.createDataFrame(
        [("a", dt(2023, 1, d), float(d)) for d in range(1, 9)] + [("b", dt(2023, 1, 2), None)],
        "Customer_ID string, snapshot_date timestamp, fe_1 double",
    )
    qs = spark.createDataFrame(
        [("a", dt(2023, 1, 8), 1), ("a", dt(2023, 1, 8), 2), ("a", dt(2022, 12, 31), 3), ("b", dt(2023, 1, 2), 4)],
        "Customer_ID string, feature_snapshot_date timestamp, row int",
    )
    got = {r.row: (r.fe_1_mean, r.fe_1_max, r.fe_1_sum) for r in add_lookback(qs, hist, ["fe_1"]).collect()}
    # A row exactly at the date counts; the two oldest of eight do not.
    assert got == {1: (5.5, 8.0, 33.0), 2: (5.5, 8.0, 33.0), 3: (0.0, 0.0, 0.0), 4: (None, None, 0.0)}


def test_lookback_reads_its_inputs_once(spark, monkeypatch, tmp_path):
    """The query dates are read once and the history once; what follows reads their stored rows."""
    spark.range(900).selectExpr("id % 7 AS Customer_ID", "timestamp_seconds(1675209600 + id * 3600) AS snapshot_date", "double(id) AS x").write.parquet(str(tmp_path / "h"))
    spark.range(40).selectExpr("id % 7 AS Customer_ID", "timestamp_seconds(1676209600 + id % 5 * 86400) AS feature_snapshot_date").write.parquet(str(tmp_path / "q"))
    parts, stage = [], lb.stage_table
    text = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(lb, "stage_table", lambda df, name: parts.append(text(df)) or stage(df, name))
    found = lookback(spark.read.parquet(str(tmp_path / "q")), spark.read.parquet(str(tmp_path / "h")), ["x"])
    parts.append(text(found))
    scans = [line for part in parts for line in part.splitlines() if "FileScan" in line]
    assert sum(str(tmp_path / "h") in line for line in scans) == 1 == sum(str(tmp_path / "q") in line for line in scans)
    exchanges = [line for line in parts[-1].splitlines() if "Exchange hashpartitioning" in line]
    assert len(scans) == 6 and len(exchanges) == 2 and "BroadcastExchange" not in parts[-1]
    assert found.count() == 35
