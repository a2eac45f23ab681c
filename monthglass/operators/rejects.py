"""What cleaning removes: the same conversions, with the rule that each removed row broke.

``tag`` converts all rows of a raw table and marks those that the cleaner of the source
would drop, with the first rule they break and the offending value. The unmarked rows
are the cleaned table, the marked ones the table of rejects: together all rows. A date
that can't be read, at which a cleaner fails, is a rule like the others here.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import DATE_FORMATS, parse_date
from ..functions.text import matches_from_start
from . import clean

RAW, REJECT = "_raw", "_reject"
#: Key and date columns of the sources.
KEYS = {"attributes": ("Customer_ID",), "financials": ("Customer_ID",), "clickstream": ("Customer_ID",), "loans": ("loan_id", "Customer_ID")}
DATES = {"loans": ("loan_start_date", "snapshot_date")}


@dataclass(frozen=True)
class Rule:
    """A row breaks it where ``broken`` is true; ``column`` holds the offending value."""

    name: str
    column: str
    broken: Column


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def _read_dates(df: DataFrame, columns: Sequence[str], formats: Sequence[str]) -> DataFrame:
    return df.withColumns({c: parse_date(F.col(c), formats) for c in columns if c in df.columns and _is_text(df, c)})


def _converted(df: DataFrame, name: str) -> DataFrame:
    """All conversions of a source's cleaner, none of its filters."""
    if name == "attributes":
        return clean.tidy_attributes(clean.coerce_numeric(df, ["Age"]))
    if name == "financials":
        return clean.tidy_financials(clean.amounts(df, [c for c in df.columns if c != RAW]))
    if name == "clickstream":
        return clean.coerce_numeric(df, clean.clickstream_columns(df))
    if name == "loans":
        return clean.add_months_on_book(clean.coerce_numeric(df, clean.LOAN_NUMBERS))
    raise ValueError(f"unknown source {name!r}")


def rules(df: DataFrame, name: str, formats: Sequence[str] = DATE_FORMATS, age=(18, 75), income=(0, 10_000_000), ssn: str = clean.SSN_PATTERN) -> list[Rule]:
    """The rules of a source, in the order in which its cleaner applies them."""
    raw = lambda c: F.col(f"{RAW}.`{c}`")
    out = [Rule(f"{c} is missing", c, raw(c).isNull()) for c in KEYS[name]]
    for c in DATES.get(name, ("snapshot_date",)):
        if c in df.columns and _is_text(df, c):
            out.append(Rule(f"{c} is no date", c, raw(c).isNotNull() & F.col(c).isNull()))
    if name == "attributes":
        out.append(Rule(f"Age outside {age[0]} to {age[1]}", "Age", ~F.coalesce(F.col("Age").between(*age), F.lit(False))))
        if "SSN" in df.columns:
            out.append(Rule("SSN unlike its pattern", "SSN", raw("SSN").isNotNull() & ~matches_from_start(raw("SSN"), ssn)))
    if name == "financials" and "Annual_Income" in df.columns:
        amount = F.col("Annual_Income")
        out.append(Rule(f"Annual_Income outside {income[0]} to {income[1]}", "Annual_Income", amount.isNotNull() & ~amount.between(*income)))
    return out


def tag(df: DataFrame, name: str, formats: Sequence[str] = DATE_FORMATS, **bounds) -> DataFrame:
    """The converted columns, ``_raw`` with the row as it was, and ``_reject`` (rule, value), null for rows that are kept."""
    held = df.withColumn(RAW, F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    out = _converted(_read_dates(held, DATES.get(name, ("snapshot_date",)), formats), name)
    marks = [
        F.when(r.broken, F.struct(F.lit(r.name).alias("rule"), F.col(f"{RAW}.`{r.column}`").cast("string").alias("value")))
        for r in rules(df, name, formats, **bounds)
    ]
    return out.withColumn(REJECT, F.coalesce(*marks))


def reject_counts(df: DataFrame, name: str, **bounds) -> dict[str, Column]:
    """An aggregate over a tagged frame per rule of the raw frame `df`."""
    return {r.name: F.count_if(F.coalesce(F.col(f"{REJECT}.rule") == r.name, F.lit(False))) for r in rules(df, name, **bounds)}


def kept(tagged: DataFrame, name: str, watched: DataFrame | None = None) -> DataFrame:
    """The cleaned table. ``watched`` is the tagged frame as it is being observed: it is read once."""
    rows = lambda t: t.where(F.col(REJECT).isNull()).drop(RAW, REJECT)
    out = rows(tagged if watched is None else watched)
    return clean.add_days_past_due(out, first_of=rows(tagged)) if name == "loans" else out


def rejected(tagged: DataFrame) -> DataFrame:
    """(snapshot_date where there is one, rule, value, row): the removed rows as they were, as JSON."""
    date = [F.col("snapshot_date")] if "snapshot_date" in tagged.columns else []
    gone = tagged.where(F.col(REJECT).isNotNull())
    return gone.select(*date, f"{REJECT}.rule", f"{REJECT}.value", F.to_json(RAW).alias("row"))
