"""Time the headline queries and the stages; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and, to pick
some entries only, BENCH_ONLY (comma-separated) are read from the environment.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from monthglass.plans import queries_checks, queries_clean, queries_drift, queries_metrics, queries_models, queries_rejects  # noqa: E402, F401
from monthglass.plans import stages as st  # noqa: E402
from monthglass.plans.registry import QUERIES  # noqa: E402
from monthglass.plans.views import view  # noqa: E402
from monthglass.session import tune  # noqa: E402
from monthglass.sources.registry import source  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ONLY = [x for x in os.environ.get("BENCH_ONLY", "").split(",") if x]

HEADLINE = [
    "validate_duplicates", "bronze_validation_suite", "clean_loans", "days_past_due", "financial_features",
    "temporal_label_join", "feature_store_join", "clickstream_last6", "lookback_events", "cap_outliers",
    "impute_median", "roc_auc", "average_precision", "performance_over_time", "psi", "ks_statistic",
    "stability_over_time", "drift_report", "dashboard", "monthly_sink_roundtrip",
]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def stage_runs(spark: SparkSession):
    """The stages on raw files made from the tables; the making is not timed."""
    work = tempfile.mkdtemp(prefix="monthglass-bench-")
    folders = st.Folders(f"{work}/raw", f"{work}/base")
    made = {"clickstream": "click_months", "attributes": "attr_snapshots", "financials": "fin_snapshots", "loans": "loan_snapshots"}
    for name, v in made.items():
        view(spark, SF_DIR, v).write.option("header", True).csv(f"{folders.raw}/{source(name).file}")
    stamp, text = "20240101_000000", "2024-01-01 00:00:00"
    yield "stage_bronze", lambda: st.ingest_all(spark, folders)
    yield "stage_silver", lambda: st.refine_all(spark, folders)
    yield "stage_gold", lambda: st.write_stores(spark, folders)
    # A few thousand training rows: two partitions keep the learners' many small jobs short.
    yield "stage_train", lambda: st.train_models(spark, folders, stamp, None, None, partitions=2)
    yield "stage_score", lambda: st.score_all(spark, folders, text)
    yield "stage_monitor", lambda: [consume(df) for df in st.monitor(spark, folders).values()]


def main() -> None:
    spark = tune(
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("monthglass-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed query so that the start of the JVM is not counted.
    consume(QUERIES["temporal_label_join"](spark, SF_DIR))
    times: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)

    for name in HEADLINE:
        if not ONLY or name in ONLY:
            timed(name, lambda: consume(QUERIES[name](spark, SF_DIR)))
    if not ONLY or any(x.startswith("stage") for x in ONLY):
        for name, run in stage_runs(spark):
            timed(name, run)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
