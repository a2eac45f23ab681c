"""The physical plans that the design relies on."""

import pytest
from pyspark.sql import functions as F

from monthglass.operators import classify as cl
from monthglass.operators import clean, drift, temporal
from monthglass.plans.views import table, view
from monthglass.sources import tables

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def orders(spark):
    return table(spark, SF, "orders")


def test_date_filters_reach_the_scan(orders):
    text = plan(temporal.in_date_range(orders, "o_orderdate", "1996-01-01", "1997-01-01").select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate" in text
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThanOrEqual" in plan(
        orders.where(drift.first_months(orders, "o_orderdate")).select("o_orderkey")
    )


def test_one_month_is_one_folder(spark, orders, tmp_path):
    path = str(tmp_path / "orders")
    tables.write_monthly(orders, path, "o_orderdate")
    rows = spark.read.parquet(path).where(F.col(tables.MONTH) == "1997-03")
    assert "PartitionFilters: [isnotnull(year_month" in plan(rows.select("o_orderkey"))
    assert rows.count() == tables.read_month(spark, path, "1997-03").count()


def test_days_past_due_aggregates_before_the_shuffle(spark):
    text = plan(clean.add_days_past_due(view(spark, SF, "loan_snapshots")))
    assert "partial_min" in text and "Window" not in text


def test_label_join_is_an_equi_join_on_key_and_date(spark):
    loans = clean.clean_loans(view(spark, SF, "loan_snapshots"))
    text = plan(temporal.temporal_label_join(view(spark, SF, "fin_snapshots"), loans))
    assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text


def test_quality_reads_the_rows_twice_and_sorts_inside_ranges(spark):
    scored = view(spark, SF, "scored_orders")
    text = plan(cl.performance(scored, "label", "prediction", "prediction_proba_1", ["priority"]))
    assert text.count("FileScan") == 2
    assert "SinglePartition" not in text and "Python" not in text


def test_checks_shuffle_the_keys_only(orders):
    from monthglass.operators import validate as v
    from monthglass.sources.registry import SourceSpec

    spec = SourceSpec("orders", "orders.csv", ("o_custkey", "o_orderdate"))
    text = plan(v.run_checks(orders, [*v.bronze_checks(orders, spec, "o_orderdate"), v.InRange("o_totalprice", 0, 1e9)]))
    # Once for the sums, which leave a task as one row, and once for the keys.
    assert text.count("FileScan") == 2
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and "o_custkey" in exchanges[0] and "o_totalprice" not in exchanges[0]
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp>" in text.replace("timestamp_ntz", "timestamp")


def test_no_window_over_a_whole_range_of_a_quantile(spark, monkeypatch, orders):
    """Values are numbered inside fine ranges of the range that holds the rank."""
    from monthglass.operators import quantiles as qt

    seen = []
    collect = type(orders).collect
    monkeypatch.setattr(type(orders), "collect", lambda self: seen.append(plan(self)) or collect(self))
    qt.exact_quantiles(orders.select("o_totalprice"), ["o_totalprice"], [0.5])
    windows = [line for text in seen for line in text.splitlines() if "Window [sum(n" in line]
    assert windows and any("value" in w for w in windows)
    assert all("_bucket" in w for w in windows)


def test_bucketed_stores_join_without_a_shuffle(spark, tmp_path):
    from monthglass.operators.features import KEYS, ROW
    from monthglass.sources import stores

    keys = (*KEYS, ROW)
    rows = spark.range(2000).selectExpr(
        "concat('c', id % 40) AS Customer_ID", "timestamp_seconds(1672531200 + id % 12 * 86400) AS feature_snapshot_date",
        "timestamp_seconds(1682531200 + id % 12 * 86400) AS label_snapshot_date", f"id AS {ROW}", "double(id) AS x", "int(id % 2) AS label",
        "int(id % 3 = 0) AS prediction", "id / 2000 AS prediction_proba_1",
    )
    paths = {n: str(tmp_path / n) for n in ("f", "l", "p")}
    stores.write_store(rows.select(*keys, "x"), paths["f"], 6, keys)
    stores.write_store(rows.select(*keys, "label"), paths["l"], 6, keys)
    stores.write_predictions(rows.select(*keys, "prediction", "prediction_proba_1"), paths["p"], 6, keys)
    for forgotten in (False, True):
        session = spark.newSession()
        if forgotten:  # as in another application
            for path in (paths["f"], paths["l"], f"{paths['p']}/parquet"):
                spark.sql(f"DROP TABLE {stores._table_name(path)}")
        session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        features, labels, scores = stores.read_store(session, paths["f"]), stores.read_store(session, paths["l"]), stores.read_predictions(session, paths["p"])
        joined = temporal.scored_join(temporal.feature_label_join(features, labels), scores)
        text = plan(joined)
        assert "Exchange" not in text and text.count("SelectedBucketsCount: 6 out of 6") == 3 and text.count("SortMergeJoin") == 2
        assert joined.count() == 2000 and joined.where("label <> int(x) % 2 OR prediction_proba_1 <> x / 2000").count() == 0
    # Written anew without buckets, and with others.
    stores.write_store(rows.select(*keys, "x").limit(5), paths["f"])
    assert stores.read_store(spark, paths["f"]).count() == 5
    stores.write_store(rows.select(*keys, "x").limit(7), paths["f"], 3, keys)
    assert stores.read_store(spark, paths["f"]).count() == 7 and stores.read_store(spark.newSession(), paths["f"]).count() == 7
