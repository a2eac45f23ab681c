"""Registered queries: the rows that cleaning removes, with the rule that each broke."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rejects as rj
from .queries_checks import _NUMBER_SQL
from .registry import query
from .views import view, with_views

# Raw rows with keys missing and dates that are none; the same text for both engines.
_KEY = "CASE WHEN id % 23 = 0 THEN NULL ELSE id END AS Customer_ID, id"
_DATE = "CASE WHEN id % 29 = 5 THEN 'soon' WHEN id % 31 = 7 THEN NULL ELSE date_text END AS snapshot_date"
_ROWS = {
    "attributes": f"{_KEY}, {_DATE}, age_text AS Age, ssn_text AS SSN, placeholder_text AS Occupation",
    "financials": f"{_KEY}, {_DATE}, CASE WHEN id % 5 = 1 THEN concat(number_text, '0000000') ELSE number_text END AS Annual_Income",
    "clickstream": f"{_KEY}, {_DATE}, number_text AS fe_1",
}
_LOANS = """CASE WHEN loan_id % 41 = 3 THEN NULL ELSE loan_id END AS loan_id, CASE WHEN loan_id % 43 = 4 THEN NULL ELSE Customer_ID END AS Customer_ID,
    loan_id AS id, snapshot_date, overdue_amt,
    CASE WHEN loan_id % 37 = 1 THEN 'unknown' WHEN loan_id % 37 = 2 THEN NULL ELSE '2023-01-01' END AS loan_start_date"""

_NO_DATE = "{0} IS NOT NULL AND try_cast({0} AS TIMESTAMP) IS NULL"
_INCOME = f"coalesce({_NUMBER_SQL.format('Annual_Income')}, {_NUMBER_SQL.format("regexp_replace(Annual_Income, '[^0-9.-]', '', 'g')")})"
#: Per source: (condition, rule, column) in order.
_RULES = {
    "attributes": [
        ("Customer_ID IS NULL", "Customer_ID is missing", "Customer_ID"),
        (_NO_DATE.format("snapshot_date"), "snapshot_date is no date", "snapshot_date"),
        (f"NOT coalesce({_NUMBER_SQL.format('Age')} BETWEEN 18 AND 75, FALSE)", "Age outside 18 to 75", "Age"),
        (r"SSN IS NOT NULL AND NOT regexp_matches(SSN, '^\d{3}-\d{2}-\d{4}$')", "SSN unlike its pattern", "SSN"),
    ],
    "financials": [
        ("Customer_ID IS NULL", "Customer_ID is missing", "Customer_ID"),
        (_NO_DATE.format("snapshot_date"), "snapshot_date is no date", "snapshot_date"),
        (f"{_INCOME} IS NOT NULL AND {_INCOME} NOT BETWEEN 0 AND 10000000", "Annual_Income outside 0 to 10000000", "Annual_Income"),
    ],
    "clickstream": [
        ("Customer_ID IS NULL", "Customer_ID is missing", "Customer_ID"),
        (_NO_DATE.format("snapshot_date"), "snapshot_date is no date", "snapshot_date"),
    ],
    "loans": [
        ("loan_id IS NULL", "loan_id is missing", "loan_id"),
        ("Customer_ID IS NULL", "Customer_ID is missing", "Customer_ID"),
        (_NO_DATE.format("loan_start_date"), "loan_start_date is no date", "loan_start_date"),
    ],
}


def _sql(name: str) -> str:
    cases = lambda pick: "CASE " + " ".join(f"WHEN {c} THEN {pick(rule, column)}" for c, rule, column in _RULES[name]) + " END"
    rule, value = cases(lambda r, _: f"'{r}'"), cases(lambda _, c: f"CAST({c} AS VARCHAR)")
    rows = f"SELECT {_LOANS} FROM loan_snapshots" if name == "loans" else f"SELECT {_ROWS[name]} FROM dirty_rows"
    body = f"SELECT id, try_cast(snapshot_date AS TIMESTAMP) AS snapshot_date, rule, value FROM (SELECT *, {rule} AS rule, {value} AS value FROM raw) WHERE rule IS NOT NULL"
    return with_views("loan_snapshots" if name == "loans" else "dirty_rows", more={"raw": rows}, body=body)


def raw_rows(spark, sf_dir, name):
    columns, source = (_LOANS, "loan_snapshots") if name == "loans" else (_ROWS[name], "dirty_rows")
    return spark.sql(f"SELECT {columns} FROM {{rows}}", rows=view(spark, sf_dir, source))


def _rejects(spark, sf_dir, name):
    found = rj.rejected(rj.tag(raw_rows(spark, sf_dir, name), name))
    return found.select(F.get_json_object("row", "$.id").cast("long").alias("id"), F.col("snapshot_date").cast("timestamp").alias("snapshot_date"), "rule", "value")


@query("rejects_attributes", _sql("attributes"))
def rejects_attributes(spark, sf_dir):
    return _rejects(spark, sf_dir, "attributes")


@query("rejects_financials", _sql("financials"))
def rejects_financials(spark, sf_dir):
    return _rejects(spark, sf_dir, "financials")


@query("rejects_clickstream", _sql("clickstream"))
def rejects_clickstream(spark, sf_dir):
    return _rejects(spark, sf_dir, "clickstream")


@query("rejects_loans", _sql("loans"))
def rejects_loans(spark, sf_dir):
    return _rejects(spark, sf_dir, "loans")
