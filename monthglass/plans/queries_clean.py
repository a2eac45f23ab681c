"""Registered queries: cleaning, features, stores and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numeric as num
from ..functions import text
from ..operators import clean
from ..operators import features as ft
from ..operators import quantiles as qt
from ..operators import temporal as tm
from ..operators.lookback import add_lookback, lookback, lookback_names
from .queries_checks import _NUMBER_SQL
from .registry import query
from .stages_sql import CLEAN_LOANS, ENGINEERED_SQL, GOLD_BODY, LABELLED, lookback_sql
from .views import table, view, with_views


def _dirty(spark, sf_dir):
    return view(spark, sf_dir, "dirty_rows")


def _loans(spark, sf_dir):
    return clean.clean_loans(view(spark, sf_dir, "loan_snapshots"))


def _round(df, columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("coerce_numeric", with_views("dirty_rows", body=f"SELECT id, {_NUMBER_SQL.format('number_text')} AS x FROM dirty_rows"))
def coerce_numeric(spark, sf_dir):
    return clean.coerce_numeric(_dirty(spark, sf_dir), ["number_text"]).select("id", F.col("number_text").alias("x"))


@query(
    "filter_range_strict",
    with_views(
        "dirty_rows",
        body=f"SELECT * FROM (SELECT id, {_NUMBER_SQL.format('age_text')} AS age FROM dirty_rows) WHERE age BETWEEN 18 AND 75",
    ),
)
def filter_range_strict(spark, sf_dir):
    ages = clean.coerce_numeric(_dirty(spark, sf_dir), ["age_text"]).select("id", F.col("age_text").alias("age"))
    return clean.filter_range(ages, "age", 18, 75)


@query(
    "filter_range_keep_null",
    with_views("dirty_rows", body="SELECT id, price FROM dirty_rows WHERE price IS NULL OR price BETWEEN 950 AND 1050"),
)
def filter_range_keep_null(spark, sf_dir):
    return clean.filter_range(_dirty(spark, sf_dir).select("id", "price"), "price", 950, 1050, keep_null=True)


@query(
    "filter_pattern_keep_null",
    with_views(
        "dirty_rows",
        body=r"SELECT id, ssn_text FROM dirty_rows WHERE ssn_text IS NULL OR regexp_matches(ssn_text, '^\d{3}-\d{2}-\d{4}$')",
    ),
)
def filter_pattern_keep_null(spark, sf_dir):
    return clean.filter_pattern(_dirty(spark, sf_dir).select("id", "ssn_text"), "ssn_text", clean.SSN_PATTERN)


@query(
    "strip_whitespace",
    with_views(
        "dirty_rows",
        body=r"SELECT id, regexp_replace(regexp_replace(spaced_text, '^\s+', ''), '\s+$', '') AS stripped FROM dirty_rows",
    ),
)
def strip_whitespace(spark, sf_dir):
    return _dirty(spark, sf_dir).select("id", text.strip_whitespace(F.col("spaced_text")).alias("stripped"))


@query(
    "null_placeholders",
    with_views(
        "dirty_rows",
        body="""
    SELECT id,
           CASE WHEN placeholder_text NOT IN ('_', 'NA', 'na', 'N/A', '!@9#%8', '', ' ') THEN placeholder_text END AS financial,
           CASE WHEN trim(placeholder_text) NOT IN ('_______', 'N/A', 'na', 'NA', '') THEN trim(placeholder_text) END AS occupation
    FROM dirty_rows""",
    ),
)
def null_placeholders(spark, sf_dir):
    raw = F.col("placeholder_text")
    return _dirty(spark, sf_dir).select(
        "id",
        text.null_if_in(raw, text.FINANCIAL_NULLS).alias("financial"),
        text.null_if_in(text.strip_whitespace(raw), text.OCCUPATION_NULLS).alias("occupation"),
    )


_STRIPPED = "regexp_replace(number_text, '[^0-9.-]', '', 'g')"


@query(
    "strip_non_numeric",
    with_views("dirty_rows", body=f"SELECT id, coalesce({_NUMBER_SQL.format('number_text')}, {_NUMBER_SQL.format(_STRIPPED)}) AS x FROM dirty_rows"),
)
def strip_non_numeric(spark, sf_dir):
    return _dirty(spark, sf_dir).select("id", text.strip_non_numeric(F.col("number_text")).alias("x"))


@query(
    "strip_exponents",
    with_views(
        "part_numbers",
        body=f"SELECT id, coalesce({_NUMBER_SQL.format('exponent_text')}, {_NUMBER_SQL.format(_STRIPPED.replace('number_text', 'exponent_text'))}) AS x FROM part_numbers",
    ),
)
def strip_exponents(spark, sf_dir):
    """A column of clean numbers, some of them with exponents."""
    return view(spark, sf_dir, "part_numbers").select("id", text.strip_non_numeric(F.col("exponent_text")).alias("x"))


@query(
    "parse_dates",
    with_views(
        "order_dates",
        body="""
    SELECT id, coalesce(TRY_CAST(date_text AS TIMESTAMP), try_strptime(date_text, '%m/%d/%Y'), try_strptime(date_text, '%Y/%m/%d'),
           try_strptime(date_text, '%Y%m%d'), try_strptime(date_text, '%d-%b-%Y')) AS parsed FROM order_dates""",
    ),
)
def parse_dates(spark, sf_dir):
    rows = clean.coerce_dates(view(spark, sf_dir, "order_dates"), ["date_text"])
    return rows.select("id", F.col("date_text").alias("parsed"))


_MONTHS_SQL = r"""CASE WHEN duration_text IS NOT NULL THEN
        12 * coalesce(TRY_CAST(regexp_extract(duration_text, '(\d+)\s+Years?', 1, 'i') AS BIGINT), 0)
           + coalesce(TRY_CAST(regexp_extract(duration_text, '(\d+)\s+Months?', 1, 'i') AS BIGINT), 0) END"""


@query("parse_duration_months", with_views("dirty_rows", body=f"SELECT id, {_MONTHS_SQL} AS months FROM dirty_rows"))
def parse_duration_months(spark, sf_dir):
    return _dirty(spark, sf_dir).select("id", text.parse_duration_months(F.col("duration_text")).alias("months"))


@query(
    "months_on_book",
    with_views(
        "loan_snapshots",
        body="""
    SELECT mob, count(*) AS n FROM (
        SELECT CAST((year(snapshot_date) - year(loan_start_date)) * 12 + month(snapshot_date) - month(loan_start_date) AS INTEGER) AS mob
        FROM loan_snapshots) GROUP BY mob""",
    ),
)
def months_on_book(spark, sf_dir):
    loans = clean.add_months_on_book(view(spark, sf_dir, "loan_snapshots"))
    return loans.groupBy("mob").agg(F.count(F.lit(1)).alias("n"))


@query(
    "days_past_due",
    with_views("loan_snapshots", body=f"SELECT loan_id, snapshot_date, overdue_amt, dpd FROM ({CLEAN_LOANS})"),
)
def days_past_due(spark, sf_dir):
    return clean.add_days_past_due(view(spark, sf_dir, "loan_snapshots")).select(
        "loan_id", "snapshot_date", "overdue_amt", "dpd"
    )


@query(
    "clean_attributes",
    with_views(
        "dirty_rows",
        body=rf"""
    SELECT * FROM (
      SELECT id AS Customer_ID, {_NUMBER_SQL.format('age_text')} AS Age, ssn_text AS SSN,
             CASE WHEN trim(placeholder_text) NOT IN ('_______', 'N/A', 'na', 'NA', '') THEN trim(placeholder_text) END AS Occupation,
             CASE WHEN s NOT IN ('_______', '') THEN s END AS Name, CAST(date_text AS TIMESTAMP) AS snapshot_date
      FROM (SELECT *, regexp_replace(regexp_replace(spaced_text, '^\s+', ''), '\s+$', '') AS s FROM dirty_rows)
      WHERE ssn_text IS NULL OR regexp_matches(ssn_text, '^\d{{3}}-\d{{2}}-\d{{4}}$'))
    WHERE Age BETWEEN 18 AND 75""",
    ),
)
def clean_attributes(spark, sf_dir):
    raw = _dirty(spark, sf_dir).select(
        F.col("id").alias("Customer_ID"),
        F.col("age_text").alias("Age"),
        F.col("ssn_text").alias("SSN"),
        F.col("placeholder_text").alias("Occupation"),
        F.col("spaced_text").alias("Name"),
        F.col("date_text").alias("snapshot_date"),
    )
    return clean.clean_attributes(raw)


@query(
    "clean_financials",
    with_views(
        "dirty_rows",
        body=rf"""
    SELECT * FROM (
      SELECT id AS Customer_ID,
             coalesce({_NUMBER_SQL.format("number_text")}, {_NUMBER_SQL.format("regexp_replace(number_text, '[^0-9.-]', '', 'g')")}) AS Annual_Income,
             price AS Outstanding_Debt,
             CASE WHEN placeholder_text NOT IN ('_', 'NA', 'na', 'N/A', '!@9#%8', '', ' ')
                  THEN trim(placeholder_text) END AS Credit_Mix,
             duration_text AS Credit_History_Age, {_MONTHS_SQL} AS Credit_History_Age_Months,
             CAST(date_text AS TIMESTAMP) AS snapshot_date
      FROM dirty_rows)
    WHERE Annual_Income IS NULL OR Annual_Income BETWEEN 0 AND 10000000""",
    ),
)
def clean_financials(spark, sf_dir):
    raw = _dirty(spark, sf_dir).select(
        F.col("id").alias("Customer_ID"),
        F.col("number_text").alias("Annual_Income"),
        F.col("price").alias("Outstanding_Debt"),
        F.col("placeholder_text").alias("Credit_Mix"),
        F.col("duration_text").alias("Credit_History_Age"),
        F.col("date_text").alias("snapshot_date"),
    )
    return clean.clean_financials(raw)


@query(
    "clean_clickstream",
    with_views(
        "dirty_rows",
        body=f"SELECT id AS Customer_ID, {_NUMBER_SQL.format('number_text')} AS fe_1, price AS fe_2, CAST(date_text AS TIMESTAMP) AS snapshot_date FROM dirty_rows",
    ),
)
def clean_clickstream(spark, sf_dir):
    raw = _dirty(spark, sf_dir).select(
        F.col("id").alias("Customer_ID"),
        F.col("number_text").alias("fe_1"),
        F.col("price").alias("fe_2"),
        F.col("date_text").alias("snapshot_date"),
    )
    return clean.clean_clickstream(raw)


@query("clean_loans", with_views("loan_snapshots", body=CLEAN_LOANS))
def clean_loans(spark, sf_dir):
    return _loans(spark, sf_dir)


@query(
    "log_transform",
    with_views(
        "dirty_rows",
        body="SELECT id, round(CASE WHEN coalesce(price, 0) > -1 THEN ln(1 + coalesce(price, 0)) END, 6) AS y FROM dirty_rows",
    ),
)
def log_transform(spark, sf_dir):
    return _dirty(spark, sf_dir).select("id", F.round(num.log1p_filled(F.col("price")), 6).alias("y"))


@query(
    "safe_ratios",
    """
    SELECT c_custkey, round(c_acctbal / nullif(c_nationkey - 3 + 1.0::DOUBLE, 0), 6) AS ratio FROM customer""",
)
def safe_ratios(spark, sf_dir):
    ratio = num.safe_ratio(F.col("c_acctbal"), F.col("c_nationkey") - 3)
    return table(spark, sf_dir, "customer").select("c_custkey", F.round(ratio, 6).alias("ratio"))


_ENGINEERED = [
    "log_annual_income", "log_monthly_salary", "debt_to_income", "emi_to_salary", "balance_to_debt",
    "investment_to_income", "total_financial_products", "loans_per_credit_product", "inquiries_per_month",
    "delayed_payments_per_month",
]


@query(
    "financial_features",
    with_views(
        "fin_snapshots",
        body=f"""
    SELECT Customer_ID, snapshot_date, {", ".join(f"round({c}, 6) AS {c}" for c in _ENGINEERED)}
    FROM (SELECT *, {ENGINEERED_SQL} FROM fin_snapshots)""",
    ),
)
def financial_features(spark, sf_dir):
    rows = ft.financial_features(view(spark, sf_dir, "fin_snapshots"))
    return _round(rows.select("Customer_ID", "snapshot_date", *_ENGINEERED), _ENGINEERED)


_AGE_GROUP = """CASE WHEN Age > 0 AND Age <= 25 THEN '18-25' WHEN Age > 25 AND Age <= 35 THEN '26-35'
       WHEN Age > 35 AND Age <= 45 THEN '36-45' WHEN Age > 45 AND Age <= 55 THEN '46-55'
       WHEN Age > 55 AND Age <= 100 THEN '56+' END"""


@query(
    "bin_right_closed",
    with_views(
        "attr_snapshots",
        body=f"SELECT {_AGE_GROUP} AS age_group, count(*) AS n, min(Age) AS lo, max(Age) AS hi FROM attr_snapshots GROUP BY 1",
    ),
)
def bin_right_closed(spark, sf_dir):
    rows = view(spark, sf_dir, "attr_snapshots").withColumn(
        "age_group", num.bin_right_closed(F.col("Age"), num.AGE_EDGES, num.AGE_LABELS)
    )
    return rows.groupBy("age_group").agg(F.count(F.lit(1)).alias("n"), F.min("Age").alias("lo"), F.max("Age").alias("hi"))


@query(
    "attribute_features",
    with_views(
        "attr_snapshots",
        body=f"""
    SELECT Customer_ID, snapshot_date, Age, coalesce(Occupation, 'Unknown') AS Occupation, {_AGE_GROUP} AS age_group
    FROM attr_snapshots""",
    ),
)
def attribute_features(spark, sf_dir):
    return ft.attribute_features(view(spark, sf_dir, "attr_snapshots")).select(
        "Customer_ID", "snapshot_date", "Age", "Occupation", "age_group"
    )


@query(
    "impute_category",
    with_views(
        "fin_snapshots",
        body="SELECT coalesce(Credit_Mix, 'Unknown') AS Credit_Mix, count(*) AS n FROM fin_snapshots GROUP BY 1",
    ),
)
def impute_category(spark, sf_dir):
    rows = ft.fill_category(view(spark, sf_dir, "fin_snapshots"), ["Credit_Mix"])
    return rows.groupBy("Credit_Mix").agg(F.count(F.lit(1)).alias("n"))


@query(
    "snapshot_filter",
    with_views(
        "fin_snapshots",
        body="""
    SELECT Customer_ID, snapshot_date, Outstanding_Debt FROM fin_snapshots
    WHERE snapshot_date BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-09-30 00:00:00'""",
    ),
)
def snapshot_filter(spark, sf_dir):
    rows = view(spark, sf_dir, "fin_snapshots").select("Customer_ID", "snapshot_date", "Outstanding_Debt")
    return tm.in_date_range(rows, "snapshot_date", "1997-01-01", "1997-09-30")


_LABEL_COLUMNS = "Customer_ID, feature_snapshot_date, label_snapshot_date, Outstanding_Debt, Num_Bank_Accounts, label, dpd, overdue_amt"


def labelled(spark, sf_dir):
    return tm.temporal_label_join(view(spark, sf_dir, "fin_snapshots"), _loans(spark, sf_dir))


@query(
    "temporal_label_join",
    with_views("fin_snapshots", "loan_snapshots", body=f"SELECT {_LABEL_COLUMNS} FROM ({LABELLED})"),
)
def temporal_label_join(spark, sf_dir):
    return labelled(spark, sf_dir).select(*_LABEL_COLUMNS.split(", "))


@query(
    "temporal_label_join_spread",
    with_views("fin_snapshots", "loan_snapshots", body=f"SELECT {_LABEL_COLUMNS} FROM ({LABELLED})"),
)
def temporal_label_join_spread(spark, sf_dir):
    """The same rows with frequent keys dealt out by salts."""
    found = tm.temporal_label_join(view(spark, sf_dir, "fin_snapshots"), _loans(spark, sf_dir), spread=True)
    return found.select(*_LABEL_COLUMNS.split(", "))


@query(
    "label_store",
    with_views(
        "fin_snapshots",
        "loan_snapshots",
        body=f"SELECT Customer_ID, feature_snapshot_date, label_snapshot_date, label, dpd, overdue_amt FROM ({LABELLED})",
    ),
)
def label_store(spark, sf_dir):
    return ft.label_store(labelled(spark, sf_dir))


@query(
    "snapshot_coverage",
    with_views(
        "fin_snapshots",
        "loan_snapshots",
        body="""
    SELECT d AS feature_snapshot_date, d + INTERVAL 6 MONTH AS label_snapshot_date,
           d + INTERVAL 6 MONTH IN (SELECT snapshot_date FROM loan_snapshots) AS has_label_date
    FROM (SELECT DISTINCT snapshot_date AS d FROM fin_snapshots)""",
    ),
)
def snapshot_coverage(spark, sf_dir):
    return tm.snapshot_coverage(view(spark, sf_dir, "fin_snapshots"), view(spark, sf_dir, "loan_snapshots"))


def joined_people(spark, sf_dir):
    people = ft.attribute_features(view(spark, sf_dir, "attr_snapshots"))
    return tm.join_attributes(
        labelled(spark, sf_dir), people, _loans(spark, sf_dir), ["Age", "Occupation", "age_group"]
    )


@query(
    "feature_store_join",
    with_views(
        "fin_snapshots",
        "loan_snapshots",
        "attr_snapshots",
        body=f"""
    SELECT Customer_ID, feature_snapshot_date, label_snapshot_date, Outstanding_Debt, label, dpd, Age, Occupation, age_group
    FROM ({GOLD_BODY})""",
    ),
)
def feature_store_join(spark, sf_dir):
    return joined_people(spark, sf_dir).select(
        "Customer_ID", "feature_snapshot_date", "label_snapshot_date", "Outstanding_Debt", "label", "dpd",
        "Age", "Occupation", "age_group",
    )


_FE5 = [f"fe_{i}" for i in range(1, 6)]
_DATES_SQL = "(SELECT Customer_ID, feature_snapshot_date AS t FROM click_dates)"


def _rounded_lookback(df, columns):
    return df.withColumns(
        {n: F.round(n, 4 if n.endswith("_sum") else 6) for n in lookback_names(columns) if not n.endswith("_max")}
    )


@query(
    "clickstream_last6",
    with_views(
        "click_days",
        "click_dates",
        body=lookback_sql("(SELECT Customer_ID AS c, snapshot_date AS d, * FROM click_days)", _DATES_SQL, _FE5, "h.d DESC"),
    ),
)
def clickstream_last6(spark, sf_dir):
    found = add_lookback(view(spark, sf_dir, "click_dates"), view(spark, sf_dir, "click_days"), _FE5)
    return _rounded_lookback(found, _FE5)


@query(
    "lookback_events",
    with_views(
        "click_dates",
        body=lookback_sql("(SELECT user_id AS c, ts AS d, event_id, value FROM events)", _DATES_SQL, ["value"], "h.d DESC, h.event_id DESC"),
    ),
)
def lookback_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("Customer_ID"), "ts", "event_id", "value")
    found = lookback(view(spark, sf_dir, "click_dates"), events, ["value"], date="ts", tie_break="event_id")
    return _rounded_lookback(found, ["value"])


_CAPPED = ["amount", "customer_group", "part_amount"]


def _cap_sql(bounds: str) -> str:
    clipped = ", ".join(
        f"round(CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, lo_{c}), hi_{c}) END, 4) AS {c}" for c in _CAPPED
    )
    return with_views("scored_orders", body=f"SELECT Customer_ID, {clipped} FROM scored_orders, (SELECT {bounds} FROM scored_orders)")


def _capped(spark, sf_dir, **options):
    rows = view(spark, sf_dir, "scored_orders").select("Customer_ID", *_CAPPED)
    return _round(qt.apply_caps(rows, qt.fit_caps(rows, _CAPPED, **options)), _CAPPED, 4)


@query(
    "cap_outliers",
    _cap_sql(", ".join(f"quantile_cont({c}, 0.01) AS lo_{c}, quantile_cont({c}, 0.95) AS hi_{c}" for c in _CAPPED)),
)
def cap_outliers(spark, sf_dir):
    return _capped(spark, sf_dir)


@query(
    "cap_outliers_iqr",
    _cap_sql(
        ", ".join(
            f"quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo_{c}, "
            f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi_{c}"
            for c in _CAPPED
        )
    ),
)
def cap_outliers_iqr(spark, sf_dir):
    return _capped(spark, sf_dir, method="iqr")


@query(
    "cap_outliers_zscore",
    _cap_sql(
        ", ".join(
            f"avg({c}) - 1.5 * stddev_samp({c}) AS lo_{c}, avg({c}) + 1.5 * stddev_samp({c}) AS hi_{c}" for c in _CAPPED
        )
    ),
)
def cap_outliers_zscore(spark, sf_dir):
    return _capped(spark, sf_dir, method="zscore", sigmas=1.5)


@query(
    "impute_median",
    with_views(
        "scored_orders",
        body="""
    SELECT Customer_ID, round(coalesce(part_amount, m), 4) AS part_amount
    FROM scored_orders, (SELECT quantile_cont(part_amount, 0.5) AS m FROM scored_orders)""",
    ),
)
def impute_median(spark, sf_dir):
    rows = view(spark, sf_dir, "scored_orders").select("Customer_ID", "part_amount")
    return _round(qt.apply_fill(rows, qt.fit_fill(rows, ["part_amount"])), ["part_amount"], 4)


@query(
    "impute_mean",
    with_views(
        "scored_orders",
        body="""
    SELECT Customer_ID, round(coalesce(part_amount, m), 4) AS part_amount
    FROM scored_orders, (SELECT avg(part_amount) AS m FROM scored_orders)""",
    ),
)
def impute_mean(spark, sf_dir):
    rows = view(spark, sf_dir, "scored_orders").select("Customer_ID", "part_amount")
    return _round(qt.apply_fill(rows, qt.fit_fill(rows, ["part_amount"], "mean")), ["part_amount"], 4)


@query(
    "impute_mode",
    with_views(
        "scored_orders",
        body="""
    SELECT Customer_ID, coalesce(status, m) AS status
    FROM scored_orders, (SELECT status AS m FROM scored_orders WHERE status IS NOT NULL
                         GROUP BY status ORDER BY count(*) DESC, status LIMIT 1)""",
    ),
)
def impute_mode(spark, sf_dir):
    rows = view(spark, sf_dir, "scored_orders").select("Customer_ID", "status")
    return ft.fill_category(rows, ["status"], qt.most_frequent(rows, "status"))


def _scaled_sql(fit: str) -> str:
    return with_views(
        "scored_orders",
        body=f"""
    SELECT Customer_ID, round((part_amount - a) / CASE WHEN b = 0 THEN 1 ELSE b END, 6) AS part_amount
    FROM scored_orders, (SELECT {fit} FROM scored_orders)""",
    )


def _scaled(spark, sf_dir, method):
    rows = view(spark, sf_dir, "scored_orders").select("Customer_ID", "part_amount")
    return _round(qt.apply_scale(rows, qt.fit_scale(rows, ["part_amount"], method)), ["part_amount"])


@query("standard_scale", _scaled_sql("avg(part_amount) AS a, stddev_pop(part_amount) AS b"))
def standard_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, "standard")


@query("minmax_scale", _scaled_sql("min(part_amount) AS a, max(part_amount) - min(part_amount) AS b"))
def minmax_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, "minmax")


@query(
    "robust_scale",
    _scaled_sql(
        "quantile_cont(part_amount, 0.5) AS a, quantile_cont(part_amount, 0.75) - quantile_cont(part_amount, 0.25) AS b"
    ),
)
def robust_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, "robust")


_STATUSES = ("F", "O", "P")


@query(
    "one_hot",
    with_views(
        "scored_orders",
        body=f"""
    SELECT Customer_ID, {", ".join(f"CASE WHEN status = '{s}' THEN 1 ELSE 0 END AS status_{s}" for s in _STATUSES)}
    FROM scored_orders""",
    ),
)
def one_hot(spark, sf_dir):
    rows = view(spark, sf_dir, "scored_orders").select("Customer_ID", "status")
    return ft.one_hot(rows, "status", _STATUSES)


@query(
    "one_hot_sparse",
    with_views(
        "scored_orders",
        body="""
    SELECT count(*) AS n, count(DISTINCT customer_group) AS categories, 0 AS lowest, count(DISTINCT customer_group) - 1 AS highest,
           count(*) - count(customer_group) AS without FROM scored_orders""",
    ),
)
def one_hot_sparse(spark, sf_dir):
    """Any number of categories as places; they are numbered without gaps."""
    rows = view(spark, sf_dir, "scored_orders").select("Customer_ID", F.col("customer_group").cast("string").alias("g"))
    hot = ft.one_hot_sparse(rows, "g", ft.category_index(rows, "g"), "place")
    return hot.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("place").alias("categories"),
        F.min("place").cast("int").alias("lowest"),
        F.max("place").alias("highest"),
        F.count_if(F.col("place").isNull()).alias("without"),
    )


@query(
    "target_encode",
    with_views(
        "scored_orders",
        body="""
    SELECT Customer_ID, priority, round(m, 6) AS encoded
    FROM scored_orders JOIN (SELECT priority AS p, avg(label) AS m FROM scored_orders
          WHERE feature_snapshot_date < TIMESTAMP '1999-01-01 00:00:00' GROUP BY 1) ON p = priority""",
    ),
)
def target_encode(spark, sf_dir):
    rows = view(spark, sf_dir, "scored_orders").select("Customer_ID", "priority", "label", "feature_snapshot_date")
    train = rows.where(F.col("feature_snapshot_date") < F.lit("1999-01-01"))
    encoded = ft.target_encode(rows, train, "priority", "label", "encoded")
    return encoded.select("Customer_ID", "priority", F.round("encoded", 6).alias("encoded"))
