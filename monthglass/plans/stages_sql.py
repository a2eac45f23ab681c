"""SQL text for the joined snapshot tables, used in the equivalent statements only."""

CLEAN_LOANS = """
    SELECT l.loan_id, l.Customer_ID, l.snapshot_date, l.loan_start_date, l.overdue_amt,
           CAST((year(snapshot_date) - year(loan_start_date)) * 12 + month(snapshot_date) - month(loan_start_date) AS INTEGER) AS mob,
           greatest(coalesce(date_diff('day', f.first_date, l.snapshot_date), 0), 0) AS dpd
    FROM loan_snapshots l LEFT JOIN (
        SELECT loan_id, min(snapshot_date) AS first_date FROM loan_snapshots WHERE overdue_amt > 0 GROUP BY loan_id) f
      ON l.loan_id = f.loan_id"""

LABELLED = f"""
    SELECT f.* EXCLUDE (snapshot_date), f.snapshot_date AS feature_snapshot_date, l.snapshot_date AS label_snapshot_date,
           CASE WHEN l.dpd >= 30 THEN 1 ELSE 0 END AS label, l.dpd, l.overdue_amt
    FROM fin_snapshots f JOIN ({CLEAN_LOANS}) l
      ON l.Customer_ID = f.Customer_ID AND l.snapshot_date = f.snapshot_date + INTERVAL 6 MONTH AND l.mob = 6"""

GOLD_BODY = f"""
    SELECT x.*, a.Age, coalesce(a.Occupation, 'Unknown') AS Occupation,
           CASE WHEN Age > 0 AND Age <= 25 THEN '18-25' WHEN Age > 25 AND Age <= 35 THEN '26-35'
                WHEN Age > 35 AND Age <= 45 THEN '36-45' WHEN Age > 45 AND Age <= 55 THEN '46-55'
                WHEN Age > 55 AND Age <= 100 THEN '56+' END AS age_group
    FROM ({LABELLED}) x JOIN attr_snapshots a
      ON a.Customer_ID = x.Customer_ID AND a.snapshot_date = x.feature_snapshot_date
    JOIN ({CLEAN_LOANS}) l2
      ON l2.Customer_ID = a.Customer_ID AND l2.snapshot_date = a.snapshot_date + INTERVAL 6 MONTH AND l2.mob = 6"""

ENGINEERED_SQL = """
       ln(1 + coalesce(Annual_Income, 0)) AS log_annual_income,
       ln(1 + coalesce(Monthly_Inhand_Salary, 0)) AS log_monthly_salary,
       Outstanding_Debt / nullif(Annual_Income + 1, 0) AS debt_to_income,
       Total_EMI_per_month / nullif(Monthly_Inhand_Salary + 1, 0) AS emi_to_salary,
       (Monthly_Balance + 1) / nullif(Outstanding_Debt + 1, 0) AS balance_to_debt,
       Amount_invested_monthly / nullif(Monthly_Inhand_Salary + 1, 0) AS investment_to_income,
       CAST(coalesce(Num_Bank_Accounts, 0) + coalesce(Num_Credit_Card, 0) + coalesce(Num_of_Loan, 0) AS DOUBLE) AS total_financial_products,
       CAST(Num_of_Loan AS DOUBLE) / nullif(Num_Bank_Accounts + Num_Credit_Card + 1, 0) AS loans_per_credit_product,
       CAST(Num_Credit_Inquiries AS DOUBLE) / nullif(Credit_History_Age_Months + 1, 0) AS inquiries_per_month,
       CAST(Num_of_Delayed_Payment AS DOUBLE) / nullif(Credit_History_Age_Months + 1, 0) AS delayed_payments_per_month"""


def lookback_sql(history: str, dates: str, columns: list[str], order: str, digits: tuple[int, int] = (6, 4)) -> str:
    aggs = ", ".join(
        f"CASE WHEN count(h.d) = 0 THEN 0.0::DOUBLE ELSE round(avg(h.{c}), {digits[0]}) END AS {c}_mean, "
        f"CASE WHEN count(h.d) = 0 THEN 0.0::DOUBLE ELSE max(h.{c}) END AS {c}_max, "
        f"round(coalesce(sum(h.{c}), 0.0::DOUBLE), {digits[1]}) AS {c}_sum"
        for c in columns
    )
    # Oracle only: every pair is formed and ranked, which the Spark side avoids.
    return f"""
    SELECT q.Customer_ID, q.t AS feature_snapshot_date, {aggs}
    FROM {dates} q LEFT JOIN (
        SELECT q.Customer_ID, q.t, h.*, row_number() OVER (PARTITION BY q.Customer_ID, q.t ORDER BY {order}) AS rn
        FROM {dates} q JOIN {history} h ON h.c = q.Customer_ID AND h.d <= q.t) h
      ON h.Customer_ID = q.Customer_ID AND h.t = q.t AND h.rn <= 6
    GROUP BY q.Customer_ID, q.t"""


_CAPPED = (
    "Annual_Income Monthly_Inhand_Salary Outstanding_Debt Total_EMI_per_month Amount_invested_monthly Monthly_Balance "
    "Num_Credit_Inquiries Num_of_Delayed_Payment Credit_History_Age_Months log_annual_income log_monthly_salary "
    "debt_to_income emi_to_salary balance_to_debt investment_to_income total_financial_products loans_per_credit_product "
    "inquiries_per_month delayed_payments_per_month fe_1_mean fe_1_max fe_1_sum fe_2_mean fe_2_max fe_2_sum "
    "fe_3_mean fe_3_max fe_3_sum"
).split()
_FILLED = [*_CAPPED, "Age", "Num_Bank_Accounts", "Num_Credit_Card", "Num_of_Loan"]
_GOLD_KEYS = "Customer_ID, feature_snapshot_date, label_snapshot_date"


def feature_store_ctes() -> dict[str, str]:
    """The feature store step by step: join, look-back, caps, medians of the capped columns, fill."""
    clicks = "(SELECT Customer_ID AS c, snapshot_date AS d, fe_1, fe_2, fe_3 FROM click_months)"
    dates = "(SELECT DISTINCT Customer_ID, feature_snapshot_date AS t FROM gold)"
    clipped = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, lo_{c}), hi_{c}) END AS {c}" for c in _CAPPED)
    return {
        "gold": f"SELECT *, {ENGINEERED_SQL} FROM ({GOLD_BODY})",
        "clicks": lookback_sql(clicks, dates, ["fe_1", "fe_2", "fe_3"], "h.d DESC", (12, 12)),
        "wide": "SELECT * FROM gold JOIN clicks USING (Customer_ID, feature_snapshot_date)",
        "bounds": "SELECT "
        + ", ".join(f"quantile_cont({c}, 0.01) AS lo_{c}, quantile_cont({c}, 0.95) AS hi_{c}" for c in _CAPPED)
        + " FROM wide",
        "capped": f"""SELECT {_GOLD_KEYS}, {clipped}, Age, Num_Bank_Accounts, Num_Credit_Card, Num_of_Loan,
                      Credit_Mix, Occupation, age_group FROM wide, bounds""",
        "medians": "SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in _FILLED) + " FROM capped",
    }


FEATURE_STORE = f"""
    SELECT {_GOLD_KEYS}, {", ".join(f"round(CAST(coalesce({c}, m_{c}) AS DOUBLE), 6) AS {c}" for c in _FILLED)},
           coalesce(Credit_Mix, 'Unknown') AS Credit_Mix, Occupation, coalesce(age_group, 'Unknown') AS age_group
    FROM capped, medians"""
