"""Registered queries: sources, sinks and validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import validate as v
from ..operators.clean import clean_attributes, clean_clickstream, clean_financials, clean_loans
from ..session import staging_path
from ..sources.registry import SourceSpec
from ..sources.stores import read_csv, read_predictions, write_predictions
from ..sources.tables import read_month, read_raw, read_table, write_monthly
from .registry import query
from .views import table, view, with_views

_SSN = r"\d{3}-\d{2}-\d{4}$"


@query(
    "csv_scan",
    with_views(
        "dirty_rows",
        body="""
    SELECT CAST(id AS STRING) AS id,
           CASE WHEN placeholder_text IN ('', 'NA') THEN NULL ELSE placeholder_text END AS placeholder_text,
           CASE WHEN number_text IN ('', 'NaN') THEN NULL ELSE number_text END AS number_text,
           duration_text, spaced_text
    FROM dirty_rows""",
    ),
)
def csv_scan(spark, sf_dir):
    """Write text columns as CSV, read them back with the usual missing words as NULL."""
    path = staging_path(spark, "csv")
    columns = ["id", "placeholder_text", "number_text", "duration_text", "spaced_text"]
    rows = view(spark, sf_dir, "dirty_rows").select(columns)
    rows.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return read_raw(spark, path)


@query(
    "monthly_sink_roundtrip",
    with_views(
        "scored_orders",
        body="""
    SELECT date_trunc('month', feature_snapshot_date) AS month, count(*) AS n, round(sum(amount), 2) AS amount,
           CAST(sum(CASE WHEN feature_snapshot_date < TIMESTAMP '1996-01-01 00:00:00' THEN label ELSE 0 END) AS BIGINT) AS rewritten
    FROM scored_orders GROUP BY 1""",
    ),
)
def monthly_sink_roundtrip(spark, sf_dir):
    """Write all months, then replace those before 1996; the other months must stay."""
    path = staging_path(spark, "monthly")
    rows = view(spark, sf_dir, "scored_orders").select("Customer_ID", "feature_snapshot_date", "amount", "label")
    write_monthly(rows.withColumn("version", F.lit(1)), path, "feature_snapshot_date")
    early = rows.where(F.col("feature_snapshot_date") < F.lit("1996-01-01"))
    write_monthly(early.withColumn("version", F.lit(2)), path, "feature_snapshot_date")
    return (
        read_table(spark, path)
        .groupBy(F.date_trunc("month", "feature_snapshot_date").alias("month"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.sum("amount"), 2).alias("amount"),
            F.sum(F.when(F.col("version") == 2, F.col("label")).otherwise(0)).alias("rewritten"),
        )
    )


@query(
    "month_partition_read",
    with_views(
        "scored_orders",
        body="""
    SELECT Customer_ID, feature_snapshot_date, amount FROM scored_orders
    WHERE feature_snapshot_date >= TIMESTAMP '1997-03-01 00:00:00'
      AND feature_snapshot_date < TIMESTAMP '1997-04-01 00:00:00'""",
    ),
)
def month_partition_read(spark, sf_dir):
    path = staging_path(spark, "month")
    rows = view(spark, sf_dir, "scored_orders").select("Customer_ID", "feature_snapshot_date", "amount")
    write_monthly(rows, path, "feature_snapshot_date")
    return read_month(spark, path, "1997-03")


@query(
    "predictions_roundtrip",
    with_views(
        "scored_orders",
        body="""
    SELECT Customer_ID, feature_snapshot_date, prediction, prediction_proba_1 FROM scored_orders""",
    ),
)
def predictions_roundtrip(spark, sf_dir):
    path = staging_path(spark, "predictions")
    columns = ["Customer_ID", "feature_snapshot_date", "prediction", "prediction_proba_1"]
    write_predictions(view(spark, sf_dir, "scored_orders").select(columns), path)
    return read_predictions(spark, path)


@query(
    "predictions_csv",
    with_views("scored_orders", body="SELECT Customer_ID, feature_snapshot_date, prediction, prediction_proba_1 FROM scored_orders"),
)
def predictions_csv(spark, sf_dir):
    """The half written for people, read back with its types."""
    path = staging_path(spark, "predictions")
    columns = ["Customer_ID", "feature_snapshot_date", "prediction", "prediction_proba_1"]
    rows = view(spark, sf_dir, "scored_orders").select(columns)
    write_predictions(rows, path)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return read_csv(spark, f"{path}/csv", schema)


def _typed(results: DataFrame, **details: str) -> DataFrame:
    """Check rows with some of their details as typed columns."""
    return results.select(
        "check_name",
        "passed",
        "level",
        *[F.col("details")[k.replace("__", ".")].cast(t).alias(k) for k, t in details.items()],
    )


@query(
    "validate_schema",
    """
    SELECT 'schema_validation' AS check_name, count(*) FILTER (column_name IN ('o_orderkey', 'o_custkey', 'snapshot_date')) = 3 AS passed,
           'critical' AS level, 'snapshot_date' AS missing
    FROM (DESCRIBE orders)""",
)
def validate_schema(spark, sf_dir):
    checks = [v.RequiredColumns(["o_orderkey", "o_custkey", "snapshot_date"], v.CRITICAL)]
    return _typed(v.run_checks(table(spark, sf_dir, "orders"), checks), missing="string")


@query(
    "validate_missing",
    with_views(
        "dirty_rows",
        body="""
    SELECT 'missing_values_check' AS check_name, p <= 0.1 AND b <= 0.1 AS passed,
           CASE WHEN p <= 0.1 AND b <= 0.1 THEN 'warning' ELSE 'error' END AS level, c AS price__count, round(p, 6) AS price__percentage
    FROM (SELECT count(*) FILTER (price IS NULL) AS c, CAST(count(*) FILTER (price IS NULL) AS DOUBLE) / count(*) AS p,
                 CAST(count(*) FILTER (brand IS NULL) AS DOUBLE) / count(*) AS b FROM dirty_rows)""",
    ),
)
def validate_missing(spark, sf_dir):
    checks = [v.MissingShare(["price", "brand", "not_there"], 0.1, v.ERROR)]
    rows = v.run_checks(view(spark, sf_dir, "dirty_rows"), checks)
    typed = _typed(rows, price__count="bigint", price__percentage="double")
    return typed.withColumn("price__percentage", F.round("price__percentage", 6))


@query(
    "validate_duplicates",
    """
    SELECT 'duplicate_check' AS check_name, d = 0 AS passed, 'warning' AS level, d AS duplicate_count,
           round(CAST(d AS DOUBLE) / n, 6) AS duplicate_percentage
    FROM (SELECT CAST(sum(c - 1) AS BIGINT) AS d, CAST(sum(c) AS BIGINT) AS n
          FROM (SELECT count(*) AS c FROM orders GROUP BY o_custkey, o_orderdate))""",
)
def validate_duplicates(spark, sf_dir):
    rows = v.run_checks(table(spark, sf_dir, "orders"), [v.NoDuplicates(["o_custkey", "o_orderdate"])])
    return _typed(rows, duplicate_count="bigint", duplicate_percentage="double").withColumn(
        "duplicate_percentage", F.round("duplicate_percentage", 6)
    )


_NUMBER_SQL = r"""CASE WHEN regexp_matches({0}, '^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$')
                 THEN TRY_CAST(trim({0}) AS DOUBLE) END"""


@query(
    "validate_range",
    with_views(
        "dirty_rows",
        body=f"""
    SELECT 'range_check_age_text' AS check_name, violations = 0 AS passed, 'error' AS level, violations,
           non_numeric_values, round(CAST(violations AS DOUBLE) / checked, 6) AS violation_percentage, actual_min, actual_max
    FROM (SELECT count(*) FILTER (age_text IS NOT NULL AND (x IS NULL OR x < 18 OR x > 75)) AS violations,
                 count(*) FILTER (age_text IS NOT NULL AND x IS NULL) AS non_numeric_values,
                 count(age_text) AS checked, min(x) AS actual_min, max(x) AS actual_max
          FROM (SELECT age_text, {_NUMBER_SQL.format('age_text')} AS x FROM dirty_rows))""",
    ),
)
def validate_range(spark, sf_dir):
    rows = v.run_checks(view(spark, sf_dir, "dirty_rows"), [v.InRange("age_text", 18, 75)])
    typed = _typed(
        rows,
        violations="bigint",
        non_numeric_values="bigint",
        violation_percentage="double",
        actual_min="double",
        actual_max="double",
    )
    return typed.withColumn("violation_percentage", F.round("violation_percentage", 6))


@query(
    "validate_pattern",
    with_views(
        "dirty_rows",
        body=rf"""
    SELECT 'pattern_check_ssn_text' AS check_name, bad = 0 AS passed, 'warning' AS level, bad AS violations,
           round(CAST(bad AS DOUBLE) / n, 6) AS violation_percentage
    FROM (SELECT count(ssn_text) AS n, count(*) FILTER (NOT regexp_matches(ssn_text, '^(?:{_SSN})')) AS bad FROM dirty_rows)""",
    ),
)
def validate_pattern(spark, sf_dir):
    rows = v.run_checks(view(spark, sf_dir, "dirty_rows"), [v.MatchesPattern("ssn_text", _SSN, v.WARNING)])
    return _typed(rows, violations="bigint", violation_percentage="double").withColumn(
        "violation_percentage", F.round("violation_percentage", 6)
    )


@query(
    "validate_row_count",
    """
    SELECT 'row_count_check' AS check_name, n BETWEEN 1 AND 100 AS passed,
           CASE WHEN n BETWEEN 1 AND 100 THEN 'warning' ELSE 'critical' END AS level, n AS row_count
    FROM (SELECT count(*) AS n FROM lineitem)""",
)
def validate_row_count(spark, sf_dir):
    return _typed(v.run_checks(table(spark, sf_dir, "lineitem"), [v.RowCount(1, 100)]), row_count="bigint")


_ORDERS_SPEC = SourceSpec("orders", "orders.csv", ("o_custkey", "o_orderdate"))

_BRONZE_SQL = """
    SELECT 'row_count_check' AS check_name, count(*) >= 100 AS passed,
           CASE WHEN count(*) >= 100 THEN 'warning' ELSE 'critical' END AS level, count(*) AS found FROM orders
    UNION ALL SELECT 'schema_validation', n = 2, CASE WHEN n = 2 THEN 'warning' ELSE 'critical' END, 0
              FROM (SELECT count(*) FILTER (column_name IN ('o_custkey', 'o_orderdate')) AS n FROM (DESCRIBE orders))
    UNION ALL SELECT 'missing_values_check', n = 0, CASE WHEN n = 0 THEN 'warning' ELSE 'critical' END, 0
              FROM (SELECT count(*) FILTER (o_custkey IS NULL OR o_orderdate IS NULL) AS n FROM orders)
    UNION ALL SELECT 'duplicate_check', sum(c - 1) = 0, 'warning', CAST(sum(c - 1) AS BIGINT)
              FROM (SELECT count(*) AS c FROM orders GROUP BY o_custkey, o_orderdate)
    UNION ALL SELECT 'missing_values_check', n = 0, CASE WHEN n = 0 THEN 'warning' ELSE 'critical' END, 0
              FROM (SELECT count(*) FILTER (o_orderdate IS NULL) AS n FROM orders)
    UNION ALL SELECT 'date_check_o_orderdate', count(*) = count(o_orderdate), 'warning', 0 FROM orders"""


def _bronze_results(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return v.run_checks(orders, v.bronze_checks(orders, _ORDERS_SPEC, "o_orderdate"))


@query(
    "bronze_validation_suite",
    f"""SELECT b.*, CASE WHEN check_name LIKE 'date_check%' THEN (SELECT min(o_orderdate) FROM orders) END AS first_date,
               CASE WHEN check_name LIKE 'date_check%' THEN (SELECT max(o_orderdate) FROM orders) END AS last_date FROM ({_BRONZE_SQL}) b""",
)
def bronze_validation_suite(spark, sf_dir):
    detail = lambda k: F.col("details")[k]
    found = F.coalesce(detail("row_count"), detail("duplicate_count"), F.lit("0")).cast("bigint")
    dates = [detail(k).cast("timestamp").alias(f"{k}_date") for k in ("first", "last")]
    return _bronze_results(spark, sf_dir).select("check_name", "passed", "level", found.alias("found"), *dates)


@query(
    "validation_summary",
    f"""
    SELECT count(*) AS total_checks, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed,
           count(*) FILTER (NOT passed AND level = 'warning') AS failed_warning,
           count(*) FILTER (NOT passed AND level = 'error') AS failed_error,
           count(*) FILTER (NOT passed AND level = 'critical') AS failed_critical,
           count(*) FILTER (NOT passed AND level = 'critical') > 0 AS has_critical_failures
    FROM ({_BRONZE_SQL})""",
)
def validation_summary(spark, sf_dir):
    return v.summarize(_bronze_results(spark, sf_dir))


@query(
    "silver_validation_suite",
    with_views(
        "loan_snapshots",
        body="""
    SELECT 'row_count_check' AS check_name, count(*) >= 10 AS passed, 'warning' AS level FROM loan_snapshots
    UNION ALL
    SELECT 'missing_values_check', count(*) FILTER (Customer_ID IS NULL OR loan_id IS NULL OR loan_start_date IS NULL) = 0, 'warning'
    FROM loan_snapshots""",
    ),
)
def silver_validation_suite(spark, sf_dir):
    loans = clean_loans(view(spark, sf_dir, "loan_snapshots"))
    return v.run_checks(loans, v.silver_checks("loans")).select("check_name", "passed", "level")


def _silver_sql(rows: str, missing: str) -> str:
    return f"""
    SELECT 'row_count_check' AS check_name, count(*) >= 10 AS passed, 'warning' AS level FROM ({rows})
    UNION ALL
    SELECT 'missing_values_check', n = 0, CASE WHEN n = 0 THEN 'warning' ELSE 'critical' END
    FROM (SELECT count(*) FILTER ({missing}) AS n FROM ({rows}))"""


def _silver(df, name) -> DataFrame:
    return v.run_checks(df, v.silver_checks(name)).select("check_name", "passed", "level")


@query(
    "silver_suite_attributes",
    with_views("attr_snapshots", body=_silver_sql("SELECT * FROM attr_snapshots WHERE Age BETWEEN 18 AND 75", "Customer_ID IS NULL OR Age IS NULL")),
)
def silver_suite_attributes(spark, sf_dir):
    return _silver(clean_attributes(view(spark, sf_dir, "attr_snapshots")), "attributes")


@query(
    "silver_suite_financials",
    with_views(
        "fin_snapshots",
        body=_silver_sql("SELECT * FROM fin_snapshots WHERE Annual_Income IS NULL OR Annual_Income BETWEEN 0 AND 10000000", "Customer_ID IS NULL"),
    ),
)
def silver_suite_financials(spark, sf_dir):
    return _silver(clean_financials(view(spark, sf_dir, "fin_snapshots")), "financials")


@query(
    "silver_suite_clickstream",
    with_views("click_months", body=_silver_sql("SELECT * FROM click_months", "Customer_ID IS NULL OR snapshot_date IS NULL")),
)
def silver_suite_clickstream(spark, sf_dir):
    return _silver(clean_clickstream(view(spark, sf_dir, "click_months")), "clickstream")


@query(
    "validate_nan",
    with_views(
        "holed_orders",
        body="""
    SELECT 'missing_values_check' AS check_name, missing = 0 AS passed, missing AS found, CAST(NULL AS DOUBLE) AS share FROM n
    UNION ALL SELECT 'range_check_amount', outside = 0, outside, round(CAST(outside AS DOUBLE) / there, 6) FROM n""",
        more={
            "n": """SELECT count(*) FILTER (amount IS NULL OR isnan(amount)) AS missing,
                 count(*) FILTER (NOT isnan(amount)) AS there,
                 count(*) FILTER (NOT isnan(amount) AND (amount < 1000 OR amount > 200000)) AS outside FROM holed_orders"""
        },
    ),
)
def validate_nan(spark, sf_dir):
    """NaN is missing: it counts for the share of missing cells and not for the range."""
    found = v.run_checks(view(spark, sf_dir, "holed_orders"), [v.MissingShare(["amount"]), v.InRange("amount", 1000, 200_000)])
    count = F.coalesce(F.col("details")["amount.count"], F.col("details")["violations"]).cast("bigint")
    share = F.round(F.col("details")["violation_percentage"].cast("double"), 6)
    return found.select("check_name", "passed", count.alias("found"), share.alias("share"))


