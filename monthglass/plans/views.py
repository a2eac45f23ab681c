"""Snapshot-shaped views over the star-schema tables.

The text is plain SQL without engine-specific functions; table names stand in braces.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    # One row per loan and month; ship dates are unrelated to order dates, so mob may be negative.
    "loan_snapshots": """
        SELECT l.l_orderkey AS loan_id, o.o_custkey AS Customer_ID,
               date_trunc('month', l.l_shipdate) AS snapshot_date,
               date_trunc('month', o.o_orderdate) AS loan_start_date,
               CASE WHEN l.l_returnflag = 'R' THEN l.l_extendedprice
                    WHEN l.l_linenumber = 7 THEN NULL
                    ELSE CAST(0 AS DOUBLE) END AS overdue_amt
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey""",
    "fin_snapshots": """
        SELECT o_custkey AS Customer_ID, date_trunc('month', o_orderdate) AS snapshot_date,
               CASE WHEN o_custkey % 11 = 3 THEN NULL ELSE max(o_totalprice) END AS Annual_Income,
               max(o_totalprice) / 12 AS Monthly_Inhand_Salary,
               min(o_totalprice) AS Outstanding_Debt,
               CASE WHEN o_custkey % 13 = 5 THEN NULL ELSE min(o_totalprice) / 24 END AS Total_EMI_per_month,
               max(o_totalprice) / 50 AS Amount_invested_monthly,
               max(o_totalprice) - min(o_totalprice) AS Monthly_Balance,
               count(*) AS Num_Bank_Accounts,
               o_custkey % 9 AS Num_Credit_Card,
               CASE WHEN o_custkey % 7 = 2 THEN NULL ELSE o_custkey % 5 END AS Num_of_Loan,
               o_custkey % 13 AS Num_Credit_Inquiries,
               o_custkey % 8 AS Num_of_Delayed_Payment,
               CASE WHEN o_custkey % 17 = 1 THEN NULL ELSE o_custkey % 240 END AS Credit_History_Age_Months,
               CASE WHEN o_custkey % 10 = 4 THEN NULL ELSE min(o_orderpriority) END AS Credit_Mix
        FROM {orders}
        GROUP BY o_custkey, date_trunc('month', o_orderdate)""",
    "attr_snapshots": """
        SELECT c.c_custkey AS Customer_ID, m.snapshot_date,
               CAST(15 + c.c_custkey % 70 AS DOUBLE) AS Age,
               CASE WHEN c.c_custkey % 6 = 0 THEN NULL ELSE c.c_mktsegment END AS Occupation
        FROM {customer} c
        JOIN (SELECT DISTINCT o_custkey, date_trunc('month', o_orderdate) AS snapshot_date FROM {orders}) m
          ON c.c_custkey = m.o_custkey""",
    # Monthly behaviour of the customers that also have loans.
    "click_months": """
        SELECT o.o_custkey AS Customer_ID, date_trunc('month', l.l_shipdate) AS snapshot_date,
               max(l.l_quantity) AS fe_1,
               max(CASE WHEN l.l_linenumber < 3 THEN l.l_extendedprice END) AS fe_2,
               min(l.l_discount) AS fe_3
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
        GROUP BY o.o_custkey, date_trunc('month', l.l_shipdate)""",
    "click_days": """
        SELECT user_id AS Customer_ID, date_trunc('day', ts) AS snapshot_date,
               max(CASE WHEN event_type = 'click' THEN value END) AS fe_1,
               max(CASE WHEN event_type = 'view' THEN value END) AS fe_2,
               max(CASE WHEN event_type = 'error' THEN value END) AS fe_3,
               max(value) AS fe_4,
               min(value) AS fe_5
        FROM {events} GROUP BY user_id, date_trunc('day', ts)""",
    # Every user at the start of every week in which the user was seen.
    "click_dates": """
        SELECT DISTINCT user_id AS Customer_ID, date_trunc('week', ts) AS feature_snapshot_date FROM {events}""",
    "dirty_rows": """
        SELECT p_partkey AS id,
               CASE p_partkey % 12 WHEN 0 THEN '_' WHEN 1 THEN 'NA' WHEN 2 THEN ' NA ' WHEN 3 THEN '!@9#%8'
                    WHEN 4 THEN '' WHEN 5 THEN ' ' WHEN 6 THEN NULL WHEN 7 THEN '_______' WHEN 8 THEN 'na'
                    ELSE p_brand END AS placeholder_text,
               CASE p_partkey % 10 WHEN 0 THEN concat(CAST(p_partkey AS STRING), '_') WHEN 1 THEN '1-2'
                    WHEN 2 THEN '5d' WHEN 3 THEN 'NaN' WHEN 4 THEN ' 7 ' WHEN 5 THEN '' WHEN 6 THEN NULL
                    WHEN 7 THEN '1e3' WHEN 8 THEN concat('-', CAST(p_partkey AS STRING), '.5')
                    ELSE CAST(p_size AS STRING) END AS number_text,
               CASE p_partkey % 7
                    WHEN 0 THEN concat(CAST(p_partkey % 30 AS STRING), ' Years and ', CAST(p_partkey % 12 AS STRING), ' Months')
                    WHEN 1 THEN '1 Year' WHEN 2 THEN concat(CAST(p_partkey % 40 AS STRING), ' months')
                    WHEN 3 THEN 'foo' WHEN 4 THEN NULL WHEN 5 THEN '2 YEARS and 1 month'
                    ELSE concat('about ', CAST(p_size AS STRING), ' years') END AS duration_text,
               CASE p_partkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '123-45-67890' WHEN 2 THEN 'x123-45-6789'
                    WHEN 3 THEN 'invalid'
                    ELSE concat(CAST(100 + p_partkey % 900 AS STRING), '-', CAST(10 + p_size AS STRING), '-',
                                CAST(1000 + p_partkey % 9000 AS STRING)) END AS ssn_text,
               CASE WHEN p_partkey % 5 = 0 THEN concat(chr(9), ' ', p_name, ' ')
                    WHEN p_partkey % 5 = 1 THEN concat('  ', p_type) ELSE p_name END AS spaced_text,
               CASE WHEN p_partkey % 8 = 0 THEN concat(CAST(18 + p_size AS STRING), '_')
                    WHEN p_partkey % 8 = 1 THEN NULL
                    WHEN p_partkey % 8 = 2 THEN CAST(-p_size AS STRING)
                    ELSE CAST(10 + p_partkey % 80 AS STRING) END AS age_text,
               CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_retailprice END AS price,
               p_brand AS brand, p_type AS kind,
               concat('2023-0', CAST(1 + p_partkey % 9 AS STRING), '-01') AS date_text
        FROM {part}""",
    "part_numbers": """
        SELECT p_partkey AS id,
               CASE p_partkey % 5 WHEN 0 THEN '1e-05' WHEN 1 THEN '1.5e3' WHEN 2 THEN concat(CAST(p_size AS STRING), 'E2')
                    WHEN 3 THEN NULL ELSE CAST(p_partkey AS STRING) END AS exponent_text
        FROM {part}""",
    # One date in the ways that raw files write it.
    "order_dates": """
        SELECT o_orderkey AS id,
               CASE o_orderkey % 6
                    WHEN 0 THEN concat(CAST(m AS STRING), '/', CAST(d AS STRING), '/', CAST(y AS STRING))
                    WHEN 1 THEN concat(CAST(y AS STRING), '/', mm, '/', dd)
                    WHEN 2 THEN concat(CAST(y AS STRING), mm, dd)
                    WHEN 3 THEN concat(dd, '-', substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(3 * m - 2 AS INT), 3), '-', CAST(y AS STRING))
                    WHEN 4 THEN NULL
                    ELSE concat(CAST(y AS STRING), '-', mm, '-', dd) END AS date_text
        FROM (SELECT o_orderkey, y, m, d, lpad(CAST(m AS STRING), 2, '0') AS mm, lpad(CAST(d AS STRING), 2, '0') AS dd
              FROM (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d FROM {orders}) x) z""",
    "holed_orders": """
        SELECT o_orderkey, o_custkey,
               CASE WHEN o_orderkey % 5 = 0 THEN CAST('NaN' AS DOUBLE) WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS amount
        FROM {orders}""",
    "scored_orders": """
        SELECT o_orderkey AS Customer_ID, o_orderdate AS feature_snapshot_date,
               CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
               CASE WHEN (o_orderkey * 7919) % 1000 >= 500 THEN 1 ELSE 0 END AS prediction,
               CAST((o_orderkey * 7919) % 1000 AS DOUBLE) / 1000 AS prediction_proba_1,
               o_totalprice AS amount,
               CAST(o_custkey % 97 AS DOUBLE) AS customer_group,
               CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice / (1 + o_orderkey % 3) END AS part_amount,
               o_orderpriority AS priority,
               CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderstatus END AS status
        FROM {orders}""",
    # Loan rows by customer and month of order; many customers have several in a month.
    "store_rows": """
        SELECT l.l_orderkey * 10 + l.l_linenumber AS loan_id, o.o_custkey AS Customer_ID,
               date_trunc('month', o.o_orderdate) AS feature_snapshot_date, l.l_extendedprice AS amount,
               CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
               CASE WHEN l.l_linenumber > 3 THEN 1 ELSE 0 END AS prediction, l.l_discount AS prediction_proba_1
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey""",
    "scored_docs": """
        SELECT d.doc_id, d.lang, l.quality AS label, CASE WHEN d.n_chars > 500 THEN 1 ELSE 0 END AS prediction,
               CAST(d.n_chars AS DOUBLE) AS score
        FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in set(re.findall(r"\{(\w+)\}", text))})


def with_views(*names: str, body: str, more: dict[str, str] | None = None) -> str:
    """The same views, and further named subqueries, in front of a query."""
    named = {n: re.sub(r"[{}]", "", VIEWS[n]) for n in names} | (more or {})
    return "WITH " + ", ".join(f"{n} AS ({text})" for n, text in named.items()) + " " + body
