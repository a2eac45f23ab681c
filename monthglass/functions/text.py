"""Text cleaning expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that a raw file uses for "missing".
CSV_NULLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
OCCUPATION_NULLS = ("_______", "N/A", "na", "NA", "")
NAME_NULLS = ("_______", "")
FINANCIAL_NULLS = ("_", "NA", "na", "N/A", "!@9#%8", "", " ")

NUMBER = r"^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)\s*$"


def finite(c: Column) -> Column:
    """NaN and infinities become NULL, so NULL is the only kind of missing (NaN sorts above all)."""
    return F.when(F.abs(c) < float("inf"), c)


def safe_double(c: Column) -> Column:
    """Text to double; anything that is not a plain number becomes NULL.

    A cast alone accepts text such as ``5d`` or ``NaN``, so the number is cut out by
    pattern first; without a match that leaves empty text, which is no number.
    """
    return finite(F.regexp_extract(c, NUMBER, 1).try_cast("double"))


def strip_whitespace(c: Column) -> Column:
    """Remove every kind of white space at both ends (``trim`` knows blanks only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def null_if_in(c: Column, placeholders: Sequence[str]) -> Column:
    return F.when(~c.isin(list(placeholders)), c)


def strip_non_numeric(c: Column) -> Column:
    """A number as it is; other text keeps its digits, minus and dot: ``1000_`` is 1000, ``1-2`` is NULL.

    So ``1e-05`` stays what it is, and ``5d`` is 5.
    """
    return F.coalesce(safe_double(c), safe_double(F.regexp_replace(c, "[^0-9.-]", "")))


def _count_of(c: Column, unit: str) -> Column:
    found = F.regexp_extract(c, rf"(?i)([0-9]+)\s+{unit}s?", 1)
    return F.coalesce(found.try_cast("bigint"), F.lit(0))


def parse_duration_months(c: Column) -> Column:
    """``X Years and Y Months`` to months. Either part may be absent; other text is 0."""
    return F.when(c.isNotNull(), _count_of(c, "Year") * 12 + _count_of(c, "Month"))


def matches_from_start(c: Column, pattern: str) -> Column:
    """True when the pattern matches at the first character (``rlike`` alone searches)."""
    return c.rlike(f"^(?:{pattern})")
