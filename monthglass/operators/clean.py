"""Raw text to typed, filtered rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import DATE_FORMATS, elapsed_days, months_between_calendar, parse_date
from ..functions.text import (
    FINANCIAL_NULLS,
    NAME_NULLS,
    OCCUPATION_NULLS,
    finite,
    matches_from_start,
    null_if_in,
    parse_duration_months,
    safe_double,
    strip_non_numeric,
    strip_whitespace,
)

# Fixed value: the pattern of a valid number.
SSN_PATTERN = r"^\d{3}-\d{2}-\d{4}$"

# Column groups of the raw sources.
FINANCIAL_NUMBERS = (
    "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card",
    "Interest_Rate", "Num_of_Loan", "Delay_from_due_date", "Num_of_Delayed_Payment",
    "Num_Credit_Inquiries", "Outstanding_Debt", "Credit_Utilization_Ratio",
    "Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Balance",
)
FINANCIAL_CATEGORIES = ("Type_of_Loan", "Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour")
LOAN_NUMBERS = ("installment_num", "loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance")


def _is_text(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.StringType)


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def coerce_dates(df: DataFrame, columns: Sequence[str], formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Text to timestamps; text that is no date in any of the formats makes the job fail."""

    def date(c: str) -> Column:
        parsed = parse_date(F.col(c), formats)
        wrong = F.raise_error(F.concat(F.lit(f"{c} is no date: "), F.col(c))).cast("timestamp")
        return F.when(parsed.isNull() & F.col(c).isNotNull(), wrong).otherwise(parsed)

    return df.withColumns({c: date(c) for c in _present(df, columns) if _is_text(df, c)})


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """To double; text that is no number becomes NULL."""
    return df.withColumns(
        {
            c: safe_double(F.col(c)) if _is_text(df, c) else finite(F.col(c).cast("double"))
            for c in _present(df, columns)
        }
    )


def filter_range(df: DataFrame, column: str, low: float, high: float, keep_null: bool = False) -> DataFrame:
    inside = F.col(column).between(low, high)
    return df.where(F.col(column).isNull() | inside if keep_null else inside)


def filter_pattern(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose text matches from its first character, or is NULL."""
    return df.where(F.col(column).isNull() | matches_from_start(F.col(column), pattern))


def null_placeholders(df: DataFrame, columns: Sequence[str], placeholders: Sequence[str]) -> DataFrame:
    return df.withColumns({c: null_if_in(F.col(c), placeholders) for c in _present(df, columns) if _is_text(df, c)})


def strip_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: strip_whitespace(F.col(c)) for c in _present(df, columns) if _is_text(df, c)})


def with_ages(df: DataFrame) -> DataFrame:
    """Known customers with their age as a number, NULL where it is none."""
    return coerce_numeric(coerce_dates(df.na.drop(subset=["Customer_ID"]), ["snapshot_date"]), ["Age"])


def clean_attributes(
    df: DataFrame,
    age_min: float = 18,
    age_max: float = 75,
    ssn_pattern: str = SSN_PATTERN,
) -> DataFrame:
    out = filter_range(with_ages(df), "Age", age_min, age_max)
    if "SSN" in df.columns:
        out = filter_pattern(out, "SSN", ssn_pattern)
    return tidy_attributes(out)


def tidy_attributes(df: DataFrame) -> DataFrame:
    out = strip_columns(df, ["Occupation", "Name"])
    out = null_placeholders(out, ["Occupation"], OCCUPATION_NULLS)
    return null_placeholders(out, ["Name"], NAME_NULLS)


def with_amounts(df: DataFrame) -> DataFrame:
    """Known customers with placeholders as NULL and the amounts as numbers."""
    # The date is converted before the placeholders are looked at, so it is left alone.
    out = coerce_dates(df.na.drop(subset=["Customer_ID"]), ["snapshot_date"])
    return amounts(out, out.columns)


def amounts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    out = null_placeholders(df, columns, FINANCIAL_NULLS)
    return out.withColumns(
        {
            c: strip_non_numeric(F.col(c)) if _is_text(out, c) else finite(F.col(c).cast("double"))
            for c in _present(out, FINANCIAL_NUMBERS)
        }
    )


def clean_financials(df: DataFrame, income_min: float = 0, income_max: float = 10_000_000) -> DataFrame:
    out = with_amounts(df)
    if "Annual_Income" in out.columns:
        out = filter_range(out, "Annual_Income", income_min, income_max, keep_null=True)
    return tidy_financials(out)


def tidy_financials(df: DataFrame) -> DataFrame:
    out = strip_columns(df, FINANCIAL_CATEGORIES)
    if "Credit_History_Age" in out.columns:
        out = out.withColumn("Credit_History_Age_Months", parse_duration_months(F.col("Credit_History_Age")))
    return out


def clickstream_columns(df: DataFrame, prefix: str = "fe_") -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def clean_clickstream(df: DataFrame, prefix: str = "fe_") -> DataFrame:
    out = coerce_dates(df.na.drop(subset=["Customer_ID"]), ["snapshot_date"])
    return coerce_numeric(out, clickstream_columns(out, prefix))


def overdue_flag(amount: Column) -> Column:
    return F.coalesce(amount > 0, F.lit(False))


def add_days_past_due(
    df: DataFrame,
    loan: str = "loan_id",
    date: str = "snapshot_date",
    overdue: str = "overdue_amt",
    into: str = "dpd",
    first_of: DataFrame | None = None,
) -> DataFrame:
    """Days since the loan's first overdue snapshot; 0 before it and when there is none.

    ``first_of`` gives the same rows from another plan, for the first dates.

    The first date is a partial aggregate (one row per overdue loan leaves each
    task) joined back, not a window over the loan: a loan with very many rows is
    then an ordinary skewed join side, which adaptive execution can split.
    """
    first = (
        (df if first_of is None else first_of).where(overdue_flag(F.col(overdue)) & F.col(loan).isNotNull())
        .groupBy(F.col(loan).alias("_loan"))
        .agg(F.min(date).alias("_first"))
    )
    days = F.greatest(F.coalesce(elapsed_days(F.col(date), F.col("_first")), F.lit(0)), F.lit(0))
    return (
        df.join(first, F.col(loan) == F.col("_loan"), "left")
        .withColumn(into, days.cast("bigint"))
        .drop("_loan", "_first")
    )


def add_months_on_book(df: DataFrame, into: str = "mob") -> DataFrame:
    """The installment number where there is one, else the calendar months since the start."""
    if "installment_num" in df.columns:
        return df.withColumn(into, F.col("installment_num"))
    if {"loan_start_date", "snapshot_date"} <= set(df.columns):
        return df.withColumn(into, months_between_calendar(F.col("snapshot_date"), F.col("loan_start_date")))
    return df


def clean_loans(df: DataFrame) -> DataFrame:
    out = df.na.drop(subset=["loan_id", "Customer_ID"])
    out = coerce_dates(out, ["loan_start_date", "snapshot_date"])
    out = coerce_numeric(out, LOAN_NUMBERS)
    return add_days_past_due(add_months_on_book(out))
