import pytest
from pyspark.sql import functions as F

from monthglass.operators import validate as v
from monthglass.sources.registry import SourceSpec


@pytest.fixture(scope="module")
def people(spark):
    """Six parcels: one weighs nothing known, one is far too heavy, one has a badly written code."""
    rows = [
        ("P-01", 12, 3.25, "AB/104", 0.15),
        ("P-02", 48, None, "CD/226", 0.95),
        ("P-03", 7, 18.5, "EF/371", 0.0),
        ("P-04", 31, 2.0, "GH-480", 1.0),
        ("P-05", 904, 9.75, "IJ/595", 0.4),
        ("P-06", 22, 6.0, "KL/613", 0.62),
    ]
    return spark.createDataFrame(rows, "parcel string, kilos int, price double, code string, filled double")


def one(df, check):
    return v.run_checks(df, [check]).first()


def test_columns(people):
    assert one(people, v.RequiredColumns(["parcel", "kilos"], v.CRITICAL)).passed
    row = one(people, v.RequiredColumns(["parcel", "sender"], v.CRITICAL))
    assert (row.passed, row.level, row.details["missing"]) == (False, "critical", "sender")


def test_passed_check_is_a_warning(people):
    assert one(people, v.RowCount(1, 10, v.CRITICAL)).level == "warning"


def test_missing(people):
    row = one(people, v.MissingShare(["price", "kilos", "not_there"], 0.0, v.ERROR))
    assert (row.passed, row.level) == (False, "error")
    assert row.details == {"price.count": "1", "price.percentage": str(1 / 6)}
    # The limit itself is allowed.
    assert one(people, v.MissingShare(["price"], 1 / 6)).passed


def test_missing_on_an_empty_table_passes(people):
    assert one(people.limit(0), v.MissingShare(["price"])).passed


def test_duplicates(spark, people):
    assert one(people, v.NoDuplicates(["parcel"])).passed
    df = spark.createDataFrame([(9, 1), (4, 4), (4, 4), (4, 8), (None, 3), (None, 3), (None, 5)], "A int, B int")
    row = one(df, v.NoDuplicates())
    assert (row.passed, row.details["duplicate_count"]) == (False, "2")
    # NULL keys are equal to each other.
    assert one(df, v.NoDuplicates(["A"])).details["duplicate_count"] == "4"


def test_range(spark, people):
    assert one(people, v.InRange("filled", 0, 1)).passed
    row = one(people, v.InRange("kilos", 5, 60))
    assert (row.passed, row.details["violations"], row.details["actual_max"]) == (False, "1", "904.0")
    text = spark.createDataFrame([("18",), ("75",), ("25_",), (None,), ("17.9",)], "x string")
    row = one(text, v.InRange("x", 18, 75))
    assert (row.details["violations"], row.details["non_numeric_values"]) == ("2", "1")
    assert float(row.details["violation_percentage"]) == 0.5


def test_range_on_a_missing_column_is_critical(people):
    row = one(people, v.InRange("nope", 0, 1, v.WARNING))
    assert (row.passed, row.level) == (False, "critical")


def test_pattern(people):
    row = one(people, v.MatchesPattern("code", r"[A-Z]{2}/\d{3}$"))
    assert (row.passed, row.details["violations"]) == (False, "1")
    assert one(people.where("code <> 'GH-480'"), v.MatchesPattern("code", r"^[A-Z]{2}/\d{3}$")).passed
    assert one(people, v.MatchesPattern("nope", ".")).level == "critical"


def test_row_count(people):
    assert one(people, v.RowCount(1, 10)).passed
    assert not one(people, v.RowCount(10)).passed
    assert not one(people, v.RowCount(1, 4)).passed


def test_suite_summary_and_gate(people):
    results = v.run_checks(people, [v.RequiredColumns(["nope"], v.CRITICAL), v.InRange("kilos", 5, 60), v.RowCount(1)])
    s = v.summarize(results).first()
    assert (s.total_checks, s.passed, s.failed, s.failed_critical, s.failed_error) == (3, 1, 2, 1, 1)
    assert s.has_critical_failures
    with pytest.raises(ValueError, match="nope"):
        v.require_no_critical(results, "people")
    v.require_no_critical(v.run_checks(people, [v.InRange("kilos", 5, 60)]), "people")


def test_bronze_checks(spark, people):
    spec = SourceSpec("people", "p.csv", ("parcel",))
    dated = people.withColumn("snapshot_date", F.lit("2/28/2023"))
    names = ["row_count_check", "schema_validation", "missing_values_check", "duplicate_check"]
    assert [r.check_name for r in v.run_checks(people, v.bronze_checks(people, spec)).collect()] == names
    rows = v.run_checks(dated, v.bronze_checks(dated, spec)).collect()
    assert [r.check_name for r in rows] == [*names, "missing_values_check", "date_check_snapshot_date"]
    assert rows[-1].passed and rows[-1].details["first"].startswith("2023-02-28")
    assert len(v.silver_checks("loans")) == 2


def test_dates(spark):
    df = spark.createDataFrame([("2023-01-05",), ("1/31/2023",), (None,), ("5. Mai",)], "d string")
    row = one(df, v.ParsesAsDate("d"))
    assert (row.passed, row.level, row.details["unreadable"]) == (False, "critical", "1")
    assert (row.details["first"][:10], row.details["last"][:10]) == ("2023-01-05", "2023-01-31")
    assert one(df, v.ParsesAsDate("nope")).level == "critical"


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (9.0,)], "x double")
    assert one(df, v.MissingShare(["x"])).details["x.count"] == "2"
    row = one(df, v.InRange("x", 0, 5))
    assert (row.details["violations"], row.details["violation_percentage"]) == ("1", "0.5")
