"""Data checks: one aggregate over the table, one result row per check.

Every check is described by a small value object; ``run_checks`` turns the list
into a single ``agg`` and unfolds its one row. Distinct keys are counted apart, over
the key columns only, so that the other sums need no shuffle but that of one row a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import ratio_or_zero
from ..functions.dates import DATE_FORMATS, parse_date
from ..functions.text import finite, matches_from_start, safe_double
from ..sources.registry import SourceSpec

WARNING, ERROR, CRITICAL = "warning", "error", "critical"
LEVELS = (WARNING, ERROR, CRITICAL)


@dataclass(frozen=True)
class RequiredColumns:
    columns: Sequence[str]
    level: str = ERROR


@dataclass(frozen=True)
class MissingShare:
    columns: Sequence[str]
    max_share: float = 0.0
    level: str = WARNING


@dataclass(frozen=True)
class NoDuplicates:
    columns: Sequence[str] | None = None
    level: str = WARNING


@dataclass(frozen=True)
class InRange:
    column: str
    low: float | None = None
    high: float | None = None
    level: str = ERROR


@dataclass(frozen=True)
class MatchesPattern:
    column: str
    pattern: str
    level: str = ERROR


@dataclass(frozen=True)
class RowCount:
    low: int = 1
    high: int | None = None
    level: str = CRITICAL


@dataclass(frozen=True)
class ParsesAsDate:
    """Text that is there is a date in one of the formats; reports the first and last date."""

    column: str
    formats: Sequence[str] = DATE_FORMATS
    level: str = CRITICAL


@dataclass
class _Plan:
    """Named aggregates for one check and the result row built from them."""

    name: str
    level: str
    passed: Column
    message: Column
    details: dict[str, Column] = field(default_factory=dict)
    aggregates: dict[str, Column] = field(default_factory=dict)
    #: Aggregate name -> columns whose distinct combinations are counted.
    distinct: dict[str, list[str]] = field(default_factory=dict)


def is_missing(df: DataFrame, column: str) -> Column:
    """NULL, or NaN in a floating-point column."""
    c = F.col(column)
    return c.isNull() | F.isnan(c) if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)) else c.isNull()


def _as_number(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, T.StringType):
        return safe_double(F.col(column))
    return finite(F.col(column).cast("double"))


def _missing_column(name: str, column: str) -> _Plan:
    return _Plan(name, CRITICAL, F.lit(False), F.lit(f"no column {column}"))


def _plan_columns(df: DataFrame, c: RequiredColumns, tag: str) -> _Plan:
    missing = sorted(set(c.columns) - set(df.columns))
    extra = sorted(set(df.columns) - set(c.columns))
    text = f"{len(missing)} of {len(c.columns)} columns absent: {', '.join(missing)}" if missing else "no column absent"
    details = {"missing": F.lit(",".join(missing)), "extra": F.lit(",".join(extra))}
    return _Plan("schema_validation", c.level, F.lit(not missing), F.lit(text), details)


def _plan_missing(df: DataFrame, c: MissingShare, tag: str) -> _Plan:
    present = [col for col in c.columns if col in df.columns]
    count = {col: F.col(f"{tag}_{i}") for i, col in enumerate(present)}
    share = {col: F.try_divide(n.cast("double"), F.col("n_rows").cast("double")) for col, n in count.items()}
    over = {col: F.coalesce(s > c.max_share, F.lit(False)) for col, s in share.items()}
    n_over = sum((o.cast("int") for o in over.values()), F.lit(0))
    passed = n_over == 0
    details = {}
    for col in present:
        # A failed check reports the failing columns only.
        shown = passed | over[col]
        details[f"{col}.count"] = F.when(shown, count[col])
        details[f"{col}.percentage"] = F.when(shown, share[col])
    message = F.when(passed, F.lit(f"no column over the share {c.max_share} of missing cells")).otherwise(
        F.concat(F.lit(f"over the share {c.max_share} of missing cells: columns "), n_over.cast("string"))
    )
    aggregates = {f"{tag}_{i}": F.count_if(is_missing(df, col)) for i, col in enumerate(present)}
    return _Plan("missing_values_check", c.level, passed, message, details, aggregates)


def _plan_duplicates(df: DataFrame, c: NoDuplicates, tag: str) -> _Plan:
    columns = list(c.columns or df.columns)
    n_dup = F.col("n_rows") - F.col(f"{tag}_distinct")
    share = ratio_or_zero(n_dup, F.col("n_rows"))
    message = F.when(n_dup == 0, F.lit("keys are unique")).otherwise(F.concat(F.lit("repeated keys: rows "), n_dup.cast("string")))
    details = {
        "duplicate_count": n_dup,
        "duplicate_percentage": share,
        "subset": F.lit(",".join(c.columns) if c.columns else None),
    }
    return _Plan("duplicate_check", c.level, n_dup == 0, message, details, distinct={f"{tag}_distinct": columns})


def _plan_range(df: DataFrame, c: InRange, tag: str) -> _Plan:
    name = f"range_check_{c.column}"
    if c.column not in df.columns:
        return _missing_column(name, c.column)
    number = _as_number(df, c.column)
    outside = F.lit(False)
    if c.low is not None:
        outside = outside | (number < c.low)
    if c.high is not None:
        outside = outside | (number > c.high)
    there = ~is_missing(df, c.column)
    aggregates = {
        f"{tag}_checked": F.count_if(there),
        f"{tag}_text": F.count_if(there & number.isNull()),
        f"{tag}_outside": F.count_if(F.coalesce(outside, F.lit(False))),
        f"{tag}_min": F.min(number),
        f"{tag}_max": F.max(number),
    }
    violations = F.col(f"{tag}_text") + F.col(f"{tag}_outside")
    bounds = f"[{c.low}, {c.high}]"
    message = F.when(violations == 0, F.lit(f"nothing outside {bounds}")).otherwise(
        F.concat(F.lit(f"outside {bounds} or no number: cells "), violations.cast("string"))
    )
    details = {
        "column": F.lit(c.column),
        "violations": violations,
        "violation_percentage": ratio_or_zero(violations, F.col(f"{tag}_checked")),
        "non_numeric_values": F.col(f"{tag}_text"),
        "min_value": F.lit(c.low),
        "max_value": F.lit(c.high),
        "actual_min": F.col(f"{tag}_min"),
        "actual_max": F.col(f"{tag}_max"),
    }
    return _Plan(name, c.level, violations == 0, message, details, aggregates)


def _plan_pattern(df: DataFrame, c: MatchesPattern, tag: str) -> _Plan:
    name = f"pattern_check_{c.column}"
    if c.column not in df.columns:
        return _missing_column(name, c.column)
    text = F.col(c.column).cast("string")
    aggregates = {
        f"{tag}_checked": F.count_if(text.isNotNull()),
        f"{tag}_bad": F.count_if(text.isNotNull() & ~matches_from_start(text, c.pattern)),
    }
    violations = F.col(f"{tag}_bad")
    message = F.when(violations == 0, F.lit(f"all cells fit {c.pattern}")).otherwise(
        F.concat(F.lit(f"unlike {c.pattern}: cells "), violations.cast("string"))
    )
    details = {
        "column": F.lit(c.column),
        "pattern": F.lit(c.pattern),
        "violations": violations,
        "violation_percentage": ratio_or_zero(violations, F.col(f"{tag}_checked")),
    }
    return _Plan(name, c.level, violations == 0, message, details, aggregates)


def _plan_rows(df: DataFrame, c: RowCount, tag: str) -> _Plan:
    n = F.col("n_rows")
    low, high = n < c.low, (n > c.high) if c.high is not None else F.lit(False)
    message = (
        F.when(low, F.concat(n.cast("string"), F.lit(f" rows, fewer than {c.low}")))
        .when(high, F.concat(n.cast("string"), F.lit(f" rows, more than {c.high}")))
        .otherwise(F.concat(n.cast("string"), F.lit(" rows")))
    )
    details = {"row_count": n, "min_rows": F.lit(c.low), "max_rows": F.lit(c.high)}
    return _Plan("row_count_check", c.level, ~(low | high), message, details)


def _plan_date(df: DataFrame, c: ParsesAsDate, tag: str) -> _Plan:
    name = f"date_check_{c.column}"
    if c.column not in df.columns:
        return _missing_column(name, c.column)
    text = F.col(c.column)
    date = parse_date(text, c.formats) if isinstance(df.schema[c.column].dataType, T.StringType) else text.cast("timestamp")
    bad = F.col(f"{tag}_bad")
    message = F.when(bad == 0, F.lit("all dates readable")).otherwise(F.concat(F.lit("no date: cells "), bad.cast("string")))
    aggregates = {f"{tag}_bad": F.count_if(text.isNotNull() & date.isNull()), f"{tag}_first": F.min(date), f"{tag}_last": F.max(date)}
    details = {"unreadable": bad, "first": F.col(f"{tag}_first"), "last": F.col(f"{tag}_last")}
    return _Plan(name, c.level, bad == 0, message, details, aggregates)


_PLANNERS = {
    ParsesAsDate: _plan_date,
    RequiredColumns: _plan_columns,
    MissingShare: _plan_missing,
    NoDuplicates: _plan_duplicates,
    InRange: _plan_range,
    MatchesPattern: _plan_pattern,
    RowCount: _plan_rows,
}


def run_checks(df: DataFrame, checks: Sequence) -> DataFrame:
    """(check_name, passed, level, message, details), one row per check.

    One pass over the columns the checks read, and one over the keys that must be
    unique. A check that passed is reported at level ``warning`` whatever level it was given.
    """
    plans, aggregates = _planned(df, checks)
    stats = df.agg(*[a.alias(n) for n, a in aggregates.items()])
    return _results(_with_keys(stats, df, plans), plans)


def _planned(df: DataFrame, checks: Sequence) -> tuple[list[_Plan], dict[str, Column]]:
    plans = [_PLANNERS[type(c)](df, c, f"c{i}") for i, c in enumerate(checks)]
    aggregates = {"n_rows": F.count(F.lit(1))}
    for p in plans:
        aggregates.update(p.aggregates)
    return plans, aggregates


def _with_keys(stats: DataFrame, df: DataFrame, plans: Sequence[_Plan]) -> DataFrame:
    """The one row of sums, with the numbers of distinct keys of `df`."""
    counted = {n: columns for p in plans for n, columns in p.distinct.items()}
    for name, columns in counted.items():
        # NULL keys are one group, so they count as equal to each other.
        keys = df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.lit(1).alias("_one")).agg(F.count("_one").alias(name))
        stats = stats.unionByName(keys, allowMissingColumns=True)
    # Each part is one row with its own columns filled.
    return stats.agg(*[F.max(c).alias(c) for c in stats.columns]) if counted else stats


def _results(stats: DataFrame, plans: Sequence[_Plan]) -> DataFrame:
    rows = []
    for p in plans:
        pairs = [x for k, v in p.details.items() for x in (F.lit(k), v.cast("string"))]
        details = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
        rows.append(
            F.struct(
                F.lit(p.name).alias("check_name"),
                p.passed.alias("passed"),
                F.when(p.passed, WARNING).otherwise(p.level).alias("level"),
                p.message.alias("message"),
                F.map_filter(details, lambda _, v: v.isNotNull()).alias("details"),
            )
        )
    return stats.select(F.inline(F.array(*rows)))


@dataclass(frozen=True)
class Watched:
    """A frame whose next action also adds up what its checks need; see ``watch``."""

    rows: DataFrame
    seen: Observation
    schema: T.StructType
    plans: Sequence[_Plan]

    def results(self, stored: DataFrame) -> DataFrame:
        """As ``run_checks`` gives them; distinct keys are counted among the rows that the action stored."""
        found = self.seen.get
        stats = stored.sparkSession.createDataFrame([tuple(found[f.name] for f in self.schema)], self.schema)
        micros = [f.name for f in self.schema if f.metadata.get("micros")]
        stats = stats.withColumns({c: F.timestamp_micros(c) for c in micros})
        return _results(_with_keys(stats, stored, self.plans), self.plans)


def watch(df: DataFrame, checks: Sequence) -> Watched:
    """The checks of ``run_checks`` as a by-product of an action on the frame, which must run once and in full.

    All but the count of distinct keys: that is no sum, so it takes a pass over the key columns.
    The frame must be of a session of its own, see ``session.apart``.
    """
    plans, aggregates = _planned(df, checks)
    kinds = df.agg(*[a.alias(n) for n, a in aggregates.items()]).schema
    fields, observed = [], []
    for f in kinds:
        when = isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))
        value = aggregates[f.name]
        # What is observed reaches the driver as plain numbers and text.
        observed.append((F.unix_micros(value.cast("timestamp")) if when else value).alias(f.name))
        fields.append(T.StructField(f.name, T.LongType() if when else f.dataType, True, {"micros": True} if when else {}))
    seen = Observation()
    return Watched(df.observe(seen, *observed), seen, T.StructType(fields), plans)


def summarize(results: DataFrame) -> DataFrame:
    failed = ~F.col("passed")
    return results.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(failed).alias("failed"),
        *[F.count_if(failed & (F.col("level") == lv)).alias(f"failed_{lv}") for lv in LEVELS],
        (F.count_if(failed & (F.col("level") == CRITICAL)) > 0).alias("has_critical_failures"),
    )


def require_no_critical(results: DataFrame | Sequence, what: str) -> None:
    """Stop a stage when a critical check failed (``results`` has one row per check)."""
    rows = results.collect() if isinstance(results, DataFrame) else results
    bad = [r for r in rows if not r.passed and r.level == CRITICAL]
    if bad:
        raise ValueError(f"critical checks failed for {what}: " + "; ".join(f"{r.check_name}: {r.message}" for r in bad))


def bronze_checks(df: DataFrame, spec: SourceSpec, date_col: str = "snapshot_date") -> list:
    checks = [
        RowCount(100),
        RequiredColumns(spec.keys, CRITICAL),
        MissingShare(spec.keys, level=CRITICAL),
    ]
    if set(spec.keys) <= set(df.columns):
        checks.append(NoDuplicates(spec.keys))
    if date_col in df.columns:
        checks += [MissingShare([date_col], level=CRITICAL), ParsesAsDate(date_col)]
    return checks


# Columns of each cleaned source that may hold no NULL.
NEVER_NULL = {
    "attributes": ("Customer_ID", "Age"),
    "financials": ("Customer_ID",),
    "clickstream": ("Customer_ID", "snapshot_date"),
    "loans": ("Customer_ID", "loan_id", "mob", "dpd"),
}


def silver_checks(source_name: str) -> list:
    checks: list = [RowCount(10, level=WARNING)]
    if source_name in NEVER_NULL:
        checks.append(MissingShare(NEVER_NULL[source_name], level=CRITICAL))
    return checks
