"""Cleaning, its rejects, and checks that ride on a write."""

import json

import pytest
from pyspark.sql import functions as F

from monthglass.operators import clean
from monthglass.operators import rejects as rj
from monthglass.operators import validate as v
from monthglass.plans import stages as st
from monthglass.plans.queries_rejects import raw_rows
from monthglass.session import apart, stage_table
from monthglass.sources import tables
from monthglass.sources.registry import source

SF = "/root/testdata/sf0.01"
CLEANERS = st.CLEANERS


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("name", sorted(CLEANERS))
def test_kept_and_rejected_are_the_input(spark, name):
    raw = stage_table(raw_rows(spark, SF, name), "raw")
    tagged = rj.tag(raw, name)
    kept, gone = rj.kept(tagged, name), rj.rejected(tagged)
    assert kept.count() + gone.count() == raw.count() and gone.count() > 0
    counts = tagged.agg(*[n.alias(r) for r, n in rj.reject_counts(raw, name).items()]).first().asDict()
    assert {r.rule: r["count"] for r in gone.groupBy("rule").count().collect()} == {r: n for r, n in counts.items() if n}
    # The cleaner itself, given the rows whose dates it can read, keeps the same ones.
    bad = "soon" if name != "loans" else "unknown"
    date = "snapshot_date" if name != "loans" else "loan_start_date"
    readable = raw.where(F.col(date).isNull() | (F.col(date) != bad))
    assert rows(kept) == rows(CLEANERS[name](readable))
    whole = {r.row for r in gone.collect()}
    assert whole <= {json.dumps({k: x for k, x in json.loads(w).items()}, separators=(",", ":"), ensure_ascii=False) for w in whole}


def test_first_rule_and_value(spark):
    data = [
        (None, "200", "bad", "2023-01-01"), ("a", "200", "bad", "2023-01-01"), ("b", None, None, "2023-01-01"), ("c", "20", "bad", "never"),
        ("d", "20", "x", None), ("e", "75", "123-45-6789", "1/2/2023"), ("f", "18", None, "2023-01-01"),
    ]
    df = spark.createDataFrame(data, "Customer_ID string, Age string, SSN string, snapshot_date string")
    gone = {json.loads(r.row).get("Customer_ID"): (r.rule, r.value) for r in rj.rejected(rj.tag(df, "attributes")).collect()}
    assert gone == {
        None: ("Customer_ID is missing", None),
        "a": ("Age outside 18 to 75", "200"),
        "b": ("Age outside 18 to 75", None),
        "c": ("snapshot_date is no date", "never"),
        "d": ("SSN unlike its pattern", "x"),
    }
    assert sorted(r.Customer_ID for r in rj.kept(rj.tag(df, "attributes"), "attributes").collect()) == ["e", "f"]
    assert rj.rejected(rj.tag(df.limit(0), "attributes")).count() == 0
    with pytest.raises(ValueError, match="unknown source"):
        rj.tag(df, "other")


def results(df):
    return [(r.check_name, r.passed, r.level, r.message, r.details) for r in df.collect()]


@pytest.mark.parametrize("empty", [False, True])
def test_watched_checks_equal_a_pass_of_their_own(spark, empty):
    df = raw_rows(apart(spark), SF, "attributes").withColumn("day", F.lit("2023-05-01").cast("timestamp")).withColumn("x", F.col("id") / 3)
    df = stage_table(df.limit(0) if empty else df, "rows")
    checks = [
        v.RowCount(10), v.RequiredColumns(["id", "nothing"]), v.MissingShare(["Customer_ID", "Age"]), v.NoDuplicates(["Customer_ID"]), v.NoDuplicates(),
        v.InRange("Age", 18, 75), v.InRange("x", None, 50.0), v.MatchesPattern("SSN", clean.SSN_PATTERN), v.ParsesAsDate("snapshot_date"),
        v.ParsesAsDate("day"), v.InRange("none", 1, 2),
    ]
    watched = v.watch(df, checks)
    stored = stage_table(watched.rows, "watched")
    assert results(watched.results(stored)) == results(v.run_checks(df, checks))


def test_checks_take_no_pass_but_that_of_the_keys(spark):
    """Jobs over the stored rows: none without distinct keys."""
    df = raw_rows(apart(spark), SF, "attributes")
    watched = v.watch(df, [v.RowCount(10), v.MissingShare(["Customer_ID"]), v.InRange("Age", 18, 75)])
    stored = stage_table(watched.rows, "watched")
    text = watched.results(stored)._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation [" not in text and "FileScan" not in text
    keys = v.watch(df, [v.NoDuplicates(["Customer_ID"])])
    stored = stage_table(keys.rows, "watched")
    assert keys.results(stored)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_rejects_are_replaced_with_the_table(spark, tmp_path):
    folders = st.Folders(str(tmp_path / "raw"), str(tmp_path / "base"))
    bronze = raw_rows(spark, SF, "attributes").withColumn("snapshot_date", clean.parse_date(F.col("snapshot_date")))
    tables.write_monthly(bronze.where("Customer_ID is not null"), folders.bronze("attributes"))
    kept = st.refine(spark, folders, "attributes").count()
    gone = spark.read.parquet(folders.rejected("attributes"))
    assert kept + gone.count() == bronze.where("Customer_ID is not null").count()
    assert set(gone.columns) == {"snapshot_date", "rule", "value", "row", "year_month"}
    # A month delivered again without faults: its rejects are gone.
    good = bronze.where("Customer_ID is not null").withColumns({"Age": F.lit("30"), "SSN": F.lit("123-45-6789")})
    tables.write_monthly(good, folders.bronze("attributes"))
    assert st.refine(spark, folders, "attributes").count() == good.count()
    assert not (tmp_path / "base" / "silver" / "attributes_rejected").exists()


def test_critical_checks_stop_both_stages(spark, tmp_path):
    folders = st.Folders(str(tmp_path / "raw"), str(tmp_path / "base"))
    (tmp_path / "raw").mkdir()
    lines = [f"C{i},2023-01-0{1 + i % 9},1" for i in range(150)]
    path = tmp_path / "raw" / source("clickstream").file
    path.write_text("Customer_ID,snapshot_date,fe_1\n" + "\n".join([*lines, ",2023-01-01,1"]) + "\n")
    with pytest.raises(ValueError, match="missing"):
        st.ingest(spark, folders, "clickstream")
    path.write_text("Customer_ID,snapshot_date,fe_1\n" + "\n".join([*lines, "C1,never,1"]) + "\n")
    with pytest.raises(ValueError, match="no date"):
        st.ingest(spark, folders, "clickstream")
    path.write_text("Customer_ID,snapshot_date,fe_1\n" + "\n".join(lines) + "\n")
    assert st.ingest(spark, folders, "clickstream").count() == 150
    assert st.refine(spark, folders, "clickstream").count() == 150


def test_torn_lines(spark, tmp_path):
    folders = st.Folders(str(tmp_path / "raw"), str(tmp_path / "base"))
    (tmp_path / "raw").mkdir()
    good = [f"C{i},2023-01-0{1 + i % 9},{i}" for i in range(150)]
    path = tmp_path / "raw" / source("clickstream").file
    path.write_text("Customer_ID,snapshot_date,fe_1\n" + "\n".join([*good, "C200,2023-01-01", 'C201,2023-01-01,"a, b",3', 'C202,2023-01-01,"x ""y"""']) + "\n")
    # As pandas does, a short line is filled up; here a long one is cut.
    assert st.ingest(spark, folders, "clickstream").count() == 153
    assert st.ingest(spark, folders, "clickstream", reject_lines=True).count() == 151
    assert {(r.rule, r.value) for r in spark.read.parquet(folders.torn("clickstream")).collect()} == {
        ("malformed line", "C200,2023-01-01"), ("malformed line", 'C201,2023-01-01,"a, b",3'),
    }
    path.write_text("Customer_ID,snapshot_date,fe_1\n" + "\n".join(good) + "\n")
    assert st.ingest(spark, folders, "clickstream", reject_lines=True, validate=False).count() == 150
    assert not (tmp_path / "base" / "bronze" / "clickstream_rejected").exists()
    path.write_text("Customer_ID,when,fe_1\n" + "\n".join(good) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        st.ingest(spark, folders, "clickstream", columns=["Customer_ID", "snapshot_date", "fe_1"], reject_lines=True)
