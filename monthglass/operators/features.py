"""Row-wise features, category encodings and the column choices of the stores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import AGE_EDGES, AGE_LABELS, bin_right_closed, log1p_filled, safe_ratio
from ..session import split_count
from .running import BUCKET, add_running, sums_before

# Keys, dropped and uncapped columns, and what each engineered column is made of.
KEYS = ("Customer_ID", "feature_snapshot_date", "label_snapshot_date")
# Number of a stored row, the same in the feature store, the label store and the predictions.
ROW = "store_row"
LABEL_COLUMNS = ("label", "dpd", "overdue_amt")
PII = ("Name", "SSN")
NEVER_CAPPED = (
    "Customer_ID", "label", "dpd", "overdue_amt",
    "Age", "Num_Bank_Accounts", "Num_Credit_Card", "Num_of_Loan",
)

# name -> (numerator, denominator)
RATIOS = {
    "debt_to_income": ("Outstanding_Debt", "Annual_Income"),
    "emi_to_salary": ("Total_EMI_per_month", "Monthly_Inhand_Salary"),
    "investment_to_income": ("Amount_invested_monthly", "Monthly_Inhand_Salary"),
    "inquiries_per_month": ("Num_Credit_Inquiries", "Credit_History_Age_Months"),
    "delayed_payments_per_month": ("Num_of_Delayed_Payment", "Credit_History_Age_Months"),
}
LOGS = {"log_annual_income": "Annual_Income", "log_monthly_salary": "Monthly_Inhand_Salary"}
PRODUCTS = ("Num_Bank_Accounts", "Num_Credit_Card", "Num_of_Loan")


def financial_features(df: DataFrame) -> DataFrame:
    """Up to ten columns; each appears only when the columns it reads are there."""
    have = set(df.columns)
    new: dict[str, Column] = {}
    for name, c in LOGS.items():
        if c in have:
            new[name] = log1p_filled(F.col(c))
    for name, (num, den) in RATIOS.items():
        if {num, den} <= have:
            new[name] = safe_ratio(F.col(num), F.col(den))
    if {"Monthly_Balance", "Outstanding_Debt"} <= have:
        new["balance_to_debt"] = safe_ratio(F.col("Monthly_Balance") + 1.0, F.col("Outstanding_Debt"))
    if set(PRODUCTS) <= have:
        accounts, cards, loans = (F.col(c).cast("double") for c in PRODUCTS)
        new["total_financial_products"] = sum(F.coalesce(c, F.lit(0.0)) for c in (accounts, cards, loans))
        new["loans_per_credit_product"] = safe_ratio(loans, accounts + cards)
    return df.withColumns(new)


def fill_category(df: DataFrame, columns: Sequence[str], value: str | None = "Unknown") -> DataFrame:
    """NULL text replaced; without a value (the mode of a column that holds none) all stays as it is."""
    return df if value is None else df.na.fill(value, [c for c in columns if c in df.columns])


def attribute_features(df: DataFrame) -> DataFrame:
    out = df
    if "Age" in df.columns:
        out = out.withColumn("age_group", bin_right_closed(F.col("Age"), AGE_EDGES, AGE_LABELS))
    return fill_category(out, ["Occupation"])


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def text_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def binary_label(metric: Column, threshold: float) -> Column:
    return F.coalesce(metric >= threshold, F.lit(False)).cast("int")


def label_store(df: DataFrame) -> DataFrame:
    return df.select(*KEYS, *[c for c in (ROW,) if c in df.columns], *LABEL_COLUMNS)


def feature_columns(df: DataFrame) -> DataFrame:
    """Without personal data, the label and what the label was made from."""
    return df.drop(*PII, *LABEL_COLUMNS)


def one_hot(df: DataFrame, column: str, categories: Sequence[str]) -> DataFrame:
    """One 0/1 column per known category; an unknown one gives zeros everywhere."""
    hot = {f"{column}_{v}": F.coalesce(F.col(column) == v, F.lit(False)).cast("int") for v in categories}
    return df.withColumns(hot).drop(column)


def category_index(df: DataFrame, column: str) -> DataFrame:
    """(category, index): the distinct values numbered from 0 without gaps, however many there are.

    They are numbered inside hash ranges, and the sizes of the earlier ranges are added;
    the number depends on the set of values alone (and on the number of ranges).
    """
    ranges = split_count(df.sparkSession)
    kinds = df.where(F.col(column).isNotNull()).select(F.col(column).alias("category")).distinct()
    kinds = kinds.withColumn("_all", F.lit(0)).withColumn(BUCKET, F.pmod(F.xxhash64("category"), F.lit(ranges)).cast("int"))
    sizes = kinds.groupBy("_all", BUCKET).agg(F.count(F.lit(1)).alias("n"))
    numbered = add_running(
        kinds.withColumn("n", F.lit(1)), sizes.select("_all", BUCKET, *sums_before(["_all"], ["n"])), ["_all"], "category", ["n"]
    )
    return numbered.select("category", (F.col("n_run") - 1).cast("bigint").alias("index"))


def one_hot_sparse(df: DataFrame, column: str, index: DataFrame, into: str) -> DataFrame:
    """The place of the row's only 1 in ``into``; NULL (all zeros) for NULL and unknown categories."""
    known = index.select(F.col("category").alias("_category"), F.col("index").alias(into))
    return df.join(known, F.col(column) == F.col("_category"), "left").drop("_category", column)


def target_encode(df: DataFrame, train: DataFrame, column: str, target: str, into: str) -> DataFrame:
    """Mean of the target per category over the training rows; unseen ones get the overall mean.

    The per-category means are joined back (never collected), so any number of
    categories works.
    """
    means = train.groupBy(column).agg(F.avg(target).alias(into))
    overall = train.agg(F.avg(target)).first()[0]
    joined = df.join(means.withColumnRenamed(column, "_category"), F.col(column).eqNullSafe(F.col("_category")), "left")
    return joined.withColumn(into, F.coalesce(into, F.lit(overall))).drop("_category")
