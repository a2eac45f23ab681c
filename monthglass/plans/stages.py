"""The stages from raw files to monitoring tables, as plain functions.

Each stage reads stored tables and writes stored tables; everything between is one
lazy plan. Paths are folders any Spark file system can serve.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, drift_store
from ..operators.charts import confusion_evolution, dashboard, performance_long, rate_comparison, sample_counts, stability_long
from ..operators.classify import performance, performance_over_time
from ..operators.curves import curve_points
from ..operators.drift import (
    NOT_REPORTED,
    category_shares,
    drift_alerts,
    drift_report,
    drift_summary,
    median_date,
    missing_values_report,
    stability_over_time,
    target_shift,
)
from ..operators.features import (
    KEYS,
    LABEL_COLUMNS,
    NEVER_CAPPED,
    ROW,
    attribute_features,
    feature_columns,
    fill_category,
    financial_features,
    label_store,
    numeric_columns,
    text_columns,
)
from ..operators.learn import ALGORITHMS, Training, score, temporal_split, train_all
from ..operators.lookback import lookback, visible_history
from ..operators.quantiles import apply_caps, apply_fill, fit_caps_and_medians
from ..operators.rejects import kept, reject_counts, rejected, tag
from ..operators.shift_tests import all_tests, decide
from ..operators.temporal import (
    FEATURE_DATE,
    exact_snapshot,
    feature_label_join,
    in_date_range,
    join_attributes,
    require_rows,
    scored_join,
    temporal_label_join,
)
from ..operators.validate import (
    WARNING,
    InRange,
    MatchesPattern,
    bronze_checks,
    require_no_critical,
    run_checks,
    silver_checks,
    watch,
)
from ..session import apart, stage_table, staged_files, tune
from ..sources.registry import SOURCES, source
from ..sources.stores import (
    load_model,
    read_predictions,
    read_store,
    save_model,
    write_csv,
    write_predictions,
    write_store,
)
from ..sources.tables import read_raw, read_table, write_monthly, write_rejects

log = logging.getLogger(__name__)

# Train and test months of the published runs.
TRAIN_DATES = ("2023-01-01", "2023-09-30")
TEST_DATES = ("2023-10-01", "2024-03-01")

CLEANERS = {
    "attributes": clean.clean_attributes,
    "financials": clean.clean_financials,
    "clickstream": clean.clean_clickstream,
    "loans": clean.clean_loans,
}


@dataclass(frozen=True)
class Folders:
    raw: str
    base: str

    def bronze(self, name: str) -> str:
        return f"{self.base}/bronze/{name}"

    def silver(self, name: str) -> str:
        return f"{self.base}/silver/{name}_clean"

    def torn(self, name: str) -> str:
        return f"{self.base}/bronze/{name}_rejected"

    def rejected(self, name: str) -> str:
        return f"{self.base}/silver/{name}_rejected"

    def gold(self, name: str) -> str:
        return f"{self.base}/gold/{name}"

    @property
    def models(self) -> str:
        return f"{self.base}/models"

    def monitoring(self, name: str) -> str:
        return f"{self.base}/monitoring/{name}"


LINE = "_line"


def ingest(
    spark: SparkSession,
    folders: Folders,
    name: str,
    validate: bool = True,
    columns: Sequence[str] | None = None,
    reject_lines: bool = False,
) -> DataFrame:
    """Raw CSV to the month-partitioned Bronze table.

    The text is parsed once, into a staged table, and the same pass adds up what the checks
    need; the keys are counted among, and the table is written from, the staged rows.
    ``columns`` (or the source's own) declares the file's header and saves the job that looks
    it up; a file that differs fails. With ``reject_lines`` lines with too few or too many
    cells go to a table beside the Bronze one instead of being filled up or cut.
    """
    spec = source(name)
    raw = read_raw(apart(spark), f"{folders.raw}/{spec.file}", columns=columns or spec.columns, line=LINE if reject_lines else None)
    whole, torn = raw, Observation()
    if reject_lines:
        counted = raw.observe(torn, F.count(LINE).alias("n"))
        whole = counted.where(F.col(LINE).isNull()).drop(LINE)
    if not validate:
        write_monthly(clean.coerce_dates(whole, ["snapshot_date"]), folders.bronze(name))
    else:
        with staged_files(spark):
            watched = watch(whole, bronze_checks(whole, spec))
            parsed = stage_table(watched.rows, f"raw-{name}")
            require_no_critical(watched.results(parsed), name)
            write_monthly(clean.coerce_dates(parsed, ["snapshot_date"]), folders.bronze(name))
    if reject_lines:
        n = torn.get["n"]
        if n:
            log.warning("%s: %s lines with too few or too many cells removed", name, n)
        cells = F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns if c != LINE]))
        lines = raw.where(F.col(LINE).isNotNull()).select(F.lit("malformed line").alias("rule"), F.col(LINE).alias("value"), cells.alias("row"))
        write_rejects(lines if n else None, spark, folders.torn(name))
    return read_table(spark, folders.bronze(name))


def _each(names: Sequence[str], run: Callable[[str], object]) -> dict[str, str]:
    """Run independent sources side by side; the error text of each that failed."""

    def safely(name: str) -> str | None:
        try:
            run(name)
        except Exception as e:  # noqa: BLE001
            return str(e)
        return None

    with ThreadPoolExecutor(max(1, len(names))) as pool:
        return {n: e for n, e in zip(names, pool.map(safely, names)) if e is not None}


def ingest_all(spark: SparkSession, folders: Folders, names: Sequence[str] = tuple(SOURCES)) -> None:
    """Every source; failures are gathered and raised together at the end."""
    tune(spark)
    failed = _each(names, lambda name: ingest(spark, folders, name))
    if failed:
        raise ValueError(f"failed to ingest {sorted(failed)}: {failed}")


def input_report(df: DataFrame, name: str) -> DataFrame | None:
    """Checks of the values that cleaning drops, or lets pass, in a pass of their own; None where there is nothing to check."""
    if name == "attributes":
        ages = clean.with_ages(df)
        report = run_checks(ages, [InRange("Age", 18, 75, WARNING)])
        if "SSN" in df.columns:
            kept = clean.filter_range(ages, "Age", 18, 75)
            report = report.unionByName(run_checks(kept, [MatchesPattern("SSN", clean.SSN_PATTERN, WARNING)]))
        return report
    if name == "financials" and "Annual_Income" in df.columns:
        return run_checks(clean.with_amounts(df), [InRange("Annual_Income", 0, 10_000_000, WARNING)])
    if name == "clickstream" and clean.clickstream_columns(df):
        first = clean.clickstream_columns(df)[0]
        return run_checks(clean.clean_clickstream(df), [InRange(first, -1000, 10_000, WARNING)])
    return None


def range_warnings(df: DataFrame, name: str) -> list:
    """Checks of values that cleaning lets pass."""
    first = clean.clickstream_columns(df)[:1] if name == "clickstream" else []
    return [InRange(c, -1000, 10_000, WARNING) for c in first]


def refine(spark: SparkSession, folders: Folders, name: str, validate: bool = True) -> DataFrame:
    """Bronze to the cleaned Silver table, and the rows that cleaning removed to a table beside it.

    One pass cleans the rows into a staged table and adds up what the checks need and how
    many rows each rule removed; only where there are some are they read again and
    written, with rule, value and the row as it was. What is removed or out of range is
    logged as a warning. Without validation nothing is counted, and a date that can't be
    read makes the job fail.
    """
    source(name)
    raw = read_table(apart(spark), folders.bronze(name))
    if not validate:
        write_monthly(CLEANERS[name](raw), folders.silver(name))
        return read_table(spark, folders.silver(name))
    tagged, removed = tag(raw, name), Observation()
    counts = reject_counts(raw, name)
    counted = tagged.observe(removed, *[n.alias(f"r{i}") for i, n in enumerate(counts.values())])
    with staged_files(spark):
        clean_rows = kept(tagged, name, counted)
        watched = watch(clean_rows, [*silver_checks(name), *range_warnings(clean_rows, name)])
        cleaned = stage_table(watched.rows, f"clean-{name}")
        results = watched.results(cleaned).collect()
        gone = {rule: removed.get[f"r{i}"] for i, rule in enumerate(counts)}
        for rule, n in gone.items():
            if n:
                log.warning("%s: %s: %s rows removed", name, rule, n)
        for row in results:
            if not row.passed:
                log.warning("%s: %s: %s", name, row.check_name, row.message)
        require_no_critical(results, name)
        write_monthly(cleaned, folders.silver(name))
        write_rejects(rejected(tagged) if any(gone.values()) else None, spark, folders.rejected(name))
    return read_table(spark, folders.silver(name))


def refine_all(spark: SparkSession, folders: Folders, names: Sequence[str] = tuple(SOURCES)) -> None:
    """Every source, side by side; all are tried, and failures are raised together at the end."""
    tune(spark)
    failed = _each(names, lambda name: refine(spark, folders, name))
    if failed:
        raise ValueError(f"failed to clean {sorted(failed)}: {failed}")


def build_stores(
    financials: DataFrame,
    attributes: DataFrame,
    clickstream: DataFrame,
    loans: DataFrame,
    months: int = 6,
    threshold: float = 30,
    low: float = 0.01,
    high: float = 0.95,
) -> tuple[DataFrame, DataFrame]:
    """(feature store, label store) from the four cleaned tables.

    The joined frame is stored once in the staging folder: the exact quantiles read a
    few columns several times and should not repeat the joins, and the number that ties
    the rows of both stores together must not change. So are the outcome rows, the few of
    all loan rows that three joins read.
    """
    due = loans.where(F.col("mob") == months).select("Customer_ID", "snapshot_date", "mob", "dpd", "overdue_amt")
    loans = stage_table(due, "due")
    labelled = financial_features(temporal_label_join(financials, loans, months, threshold))
    people = attribute_features(attributes)
    joined = join_attributes(labelled, people, loans, ["Age", "Occupation", "age_group"], months)
    clicks = clean.clickstream_columns(clickstream)
    if clicks:
        # The look-back needs the keys and dates with an outcome alone, so it doesn't wait for the wide joins.
        keys = financials.select("Customer_ID", "snapshot_date")
        dates = temporal_label_join(keys, loans, months, threshold, carry=()).select("Customer_ID", FEATURE_DATE).distinct()
        dates = stage_table(dates, "dates")
        seen = visible_history(clickstream, dates)
        joined = joined.join(lookback(dates, seen, clicks), ["Customer_ID", FEATURE_DATE], "left")
    # The number is given while the rows are stored, so both stores hold the same one.
    numbered = joined.withColumn(ROW, F.monotonically_increasing_id())
    staged = require_rows(stage_table(numbered, "gold"), f"no feature date has outcomes {months} months later")

    numbers = numeric_columns(staged, (*LABEL_COLUMNS, ROW))
    caps, medians = fit_caps_and_medians(
        staged,
        [c for c in numbers if c not in NEVER_CAPPED],
        [c for c in numbers if c != "Customer_ID"],
        low,
        high,
    )
    features = apply_fill(apply_caps(feature_columns(staged), caps), medians)
    return fill_category(features, text_columns(features, ["Customer_ID"])), label_store(staged)


STORE_KEYS = (*KEYS, ROW)


def write_stores(spark: SparkSession, folders: Folders, buckets: int | None = None, **options) -> None:
    """Silver to the feature and label stores; ``buckets`` deals both out by their keys, see ``write_store``."""
    tune(spark)
    silver = [read_table(spark, folders.silver(n)) for n in ("financials", "attributes", "clickstream", "loans")]
    with staged_files(spark):
        features, labels = build_stores(*silver, **options)
        write_store(features, folders.gold("feature_store"), buckets, STORE_KEYS)
        write_store(labels, folders.gold("label_store"), buckets, STORE_KEYS)


def labelled_rows(spark: SparkSession, folders: Folders) -> DataFrame:
    return feature_label_join(
        read_store(spark, folders.gold("feature_store")), read_store(spark, folders.gold("label_store"))
    )


def train_models(
    spark: SparkSession,
    folders: Folders,
    timestamp: str,
    train: tuple[str, str] | None = TRAIN_DATES,
    test: tuple[str, str] | None = TEST_DATES,
    algorithms: Sequence[str] = ALGORITHMS,
    parameters: Mapping[str, Mapping] | None = None,
    metric: str = "roc_auc",
    categorical: Sequence[str] | None = None,
    partitions: int | None = None,
    strict: bool = True,
) -> Training:
    """Fit all algorithms on the stores and save the best one.

    ``categorical`` names the text columns to encode; without it all of the store's are.
    An algorithm that fails is an error after the others were fitted and the best was
    saved, unless ``strict`` is off; the failures are in the result.
    """
    tune(spark)
    with staged_files(spark):
        rows = stage_table(labelled_rows(spark, folders), "labelled")
        split = temporal_split(rows, FEATURE_DATE, train, test)
        trained = train_all(*split, algorithms, parameters, categorical=categorical, partitions=partitions)
    best = trained.best(metric)
    numbers = {k: float(v) for k, v in best.items() if isinstance(v, (int, float))}
    save_model(spark, trained.models[best["model_name"]], folders.models, best["model_name"], timestamp, numbers, metric)
    if strict and trained.failures:
        raise ValueError(f"failed to train {sorted(trained.failures)}: {trained.failures}")
    return trained


def score_all(
    spark: SparkSession,
    folders: Folders,
    timestamp: str,
    start: str | None = None,
    end: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Score the feature store, optionally within a date range, with the model saved last; stored."""
    tune(spark)
    model, row = load_model(spark, folders.models)
    rows = in_date_range(read_store(spark, folders.gold("feature_store")), FEATURE_DATE, start, end)
    scores = score(model, rows, timestamp, row["model_name"], row["version"])
    write_predictions(scores, folders.gold("predictions"), buckets, STORE_KEYS)
    return read_predictions(spark, folders.gold("predictions"))


def score_snapshot(spark: SparkSession, folders: Folders, timestamp: str, date: str) -> DataFrame:
    """Scores of one snapshot date; not stored. No rows at that date is an error."""
    model, row = load_model(spark, folders.models)
    rows = exact_snapshot(read_store(spark, folders.gold("feature_store")), FEATURE_DATE, date)
    return score(model, rows, timestamp, row["model_name"], row["version"])


def scored_months(spark: SparkSession, folders: Folders, first: str, last: str) -> DataFrame:
    """Features, labels and scores of some months; the bounds reach the scans of all three stores."""
    within = drift_store.in_months(F.col(FEATURE_DATE), first, last)
    stores = [read_store(spark, folders.gold(n)).where(within) for n in ("feature_store", "label_store")]
    return scored_join(feature_label_join(*stores), read_predictions(spark, folders.gold("predictions")).where(within))


def monitor_months(spark: SparkSession, folders: Folders, first: str, last: str | None = None) -> DataFrame:
    """Drift of the months from ``first`` to ``last`` added to the stored drift; the table of all months.

    The first call fixes the reference: the first three months of the stores as they are then.
    """
    tune(spark)
    path = folders.monitoring("drift_store")
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/reference")
    with staged_files(spark):
        if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            store = drift_store.open_store(spark, path)
        else:
            everything = scored_join(labelled_rows(spark, folders), read_predictions(spark, folders.gold("predictions")))
            store = drift_store.start(spark, path, stage_table(everything, "scored"), FEATURE_DATE)
        drift_store.add(store, stage_table(scored_months(spark, folders, first, last or first), "scored"), first, last)
    return drift_store.stability(store)


def monitor(spark: SparkSession, folders: Folders, unit: str = "month") -> dict[str, DataFrame]:
    """Quality and drift per window, the two-halves report with its quality, alerts, and the chart tables.

    The tables are lazy and read frames in the staging folder; keep it until they are used.
    """
    tune(spark)
    joined = scored_join(labelled_rows(spark, folders), read_predictions(spark, folders.gold("predictions")))
    data = stage_table(joined, "scored")
    quality = stage_table(
        performance_over_time(data, FEATURE_DATE, "label", "prediction", "prediction_proba_1", unit), "quality"
    )
    stability = stage_table(stability_over_time(data, FEATURE_DATE, unit=unit), "stability")
    write_csv(quality, folders.monitoring("performance_metrics"))
    write_csv(stability, folders.monitoring("stability_metrics"))
    first_half = data[FEATURE_DATE] <= median_date(data, FEATURE_DATE)
    reported = [c for c in data.columns if c not in NOT_REPORTED]
    report = stage_table(drift_report(data, first_half), "report")
    tests = stage_table(all_tests(data, first_half), "tests")
    halves = data.withColumn("half", F.when(first_half, "reference").otherwise("current"))
    return {
        "drift_summary": drift_summary(report),
        "all_tests": tests,
        "drift_tests": decide(tests),
        "target_tests": decide(all_tests(data, first_half, [], ["label", "prediction"])),
        "category_shares": category_shares(data, first_half, text_columns(data, NOT_REPORTED)),
        "quality_by_half": performance(halves, "label", "prediction", "prediction_proba_1", ["half"], keep_counts=True),
        "curves_by_half": curve_points(halves, "label", "prediction_proba_1", ["half"]),
        "alerts": drift_alerts(quality, stability),
        "performance": quality,
        "stability": stability,
        "drift_report": report,
        "missing_values": missing_values_report(data, first_half, reported),
        "target_shift": target_shift(data, first_half, "label"),
        "performance_long": performance_long(quality),
        "rate_comparison": rate_comparison(quality),
        "confusion_evolution": confusion_evolution(quality),
        "sample_counts": sample_counts(quality),
        "stability_long": stability_long(stability),
        "dashboard": dashboard(quality, stability),
    }
