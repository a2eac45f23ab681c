"""Inputs of the stores that are read once, and no more of them than is needed."""

from datetime import datetime as dt

from pyspark.sql import functions as F

from monthglass.operators import lookback as lb
from monthglass.plans import stages


def test_loan_rows_are_read_once_for_both_stores(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    loans = spark.sql("""SELECT id % 5 AS Customer_ID, add_months(DATE'2024-01-01', 6)::timestamp AS snapshot_date, 6 AS mob,
        (id % 2 * 40)::double AS dpd, 1.0D AS overdue_amt FROM range(15)""")
    loans = loans.mapInArrow(count, loans.schema)
    people = "SELECT id AS Customer_ID, DATE'2024-01-01'::timestamp AS snapshot_date"
    features, labels = stages.build_stores(
        spark.sql(f"{people}, id * 10.0D AS Annual_Income FROM range(5)"),
        spark.sql(f"{people}, 30.0D AS Age, 'x' AS Occupation FROM range(5)"),
        spark.sql(f"{people}, id * 1.0D AS fe_1 FROM range(5)"),
        loans,
    )
    # Three loans a customer: three labelled rows, each with three copies of the attributes.
    assert features.count() == labels.count() == 45
    assert labels.agg(F.sum("label")).first()[0] == 21
    assert seen.value == 15


def test_clicks_that_no_feature_row_sees_are_not_ranked(spark, monkeypatch):
    """Of the customers without an outcome, and of months after the last feature date of a customer."""
    clicks = spark.sql("""SELECT if(id = 4, NULL, id) AS Customer_ID, add_months(DATE'2023-10-01', m)::timestamp AS snapshot_date, id * 10.0D + m AS fe_1
        FROM range(5) JOIN (SELECT explode(sequence(0, 5)) AS m)""")
    loans = spark.sql("SELECT id AS Customer_ID, DATE'2024-07-01'::timestamp AS snapshot_date, 6 AS mob, 40.0D AS dpd, 1.0D AS overdue_amt FROM range(2)")
    people = "SELECT id AS Customer_ID, DATE'2024-01-01'::timestamp AS snapshot_date"
    given, look = [], lb.lookback
    monkeypatch.setattr(stages, "lookback", lambda queries, history, *a: given.append(history) or look(queries, history, *a))
    features, _ = stages.build_stores(
        spark.sql(f"{people}, id * 10.0D AS Annual_Income FROM range(5)"), spark.sql(f"{people}, 30.0D AS Age, 'x' AS Occupation FROM range(5)"), clicks, loans
    )
    got = {r.Customer_ID: (r.fe_1_max, r.fe_1_sum) for r in features.select("Customer_ID", "fe_1_max", "fe_1_sum").collect()}
    assert set(got) == {0, 1}
    seen = {(r.Customer_ID, r.snapshot_date) for r in given[0].collect()}
    assert seen == {(c, dt(y, m, 1)) for c in (0, 1) for y, m in ((2023, 10), (2023, 11), (2023, 12), (2024, 1))}


def test_visible_history_leaves_the_look_back_as_it_is(spark):
    hist = spark.sql("""SELECT if(id % 7 = 6, NULL, id % 7) AS Customer_ID, if(id % 11 = 0, NULL, timestamp_seconds(1675209600 + id * 3600)) AS snapshot_date,
        double(id) AS x FROM range(300)""")
    asked = spark.sql("""SELECT if(id % 4 = 3, NULL, id % 4) AS Customer_ID, if(id % 5 = 4, NULL, timestamp_seconds(1675209600 + id % 5 * 90000)) AS feature_snapshot_date
        FROM range(40) UNION ALL SELECT 9, NULL UNION ALL SELECT 5, NULL""")
    cut = lb.visible_history(hist, asked)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(lb.lookback(asked, cut, ["x"])) == rows(lb.lookback(asked, hist, ["x"]))
    assert 0 < cut.count() < hist.count() / 2
