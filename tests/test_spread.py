"""Joins with a key that holds a third of all rows, adaptive execution and broadcasts off."""

from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from monthglass.operators import temporal as tm
from monthglass.operators.spread import frequent_keys, spread_join


@pytest.fixture
def plain(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    for k, v in kept.items():
        spark.conf.set(k, v)


def sides(spark, n=60_000):
    left = spark.range(n).selectExpr("if(id % 3 = 0, 7, id % 5000) AS k", "id % 4 AS j", "id AS v")
    right = spark.range(5000).selectExpr("id AS k", "id % 4 AS j", "id * 2 AS w").union(spark.createDataFrame([(7, 0, 1), (7, 1, 2), (7, 1, 3), (7, 2, 4), (None, 1, 1)], "k long, j long, w long"))
    return left.union(spark.createDataFrame([(None, 1, 1)], "k long, j long, v long")), right


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_rows_are_those_of_the_join(plain, how):
    left, right = sides(plain, 6000)
    assert rows(spread_join(left, right, ["k"], how)) == rows(left.join(right, ["k"], how))
    assert rows(spread_join(left.withColumnRenamed("v", "_salt"), right, ["k", "j"], how)) == rows(left.withColumnRenamed("v", "_salt").join(right, ["k", "j"], how))


def test_no_task_gets_the_hot_key(plain):
    left, right = sides(plain)
    right = right.groupBy("k").agg(F.max("w").alias("w"))

    def sizes(df):
        return sorted(r["count"] for r in df.select(F.spark_partition_id().alias("t")).groupBy("t").count().collect())

    before, after = sizes(left.join(right, "k")), sizes(spread_join(left, right, ["k"]))
    median = after[len(after) // 2]
    assert before[-1] > 3 * before[len(before) // 2] and after[-1] <= 2 * median and sum(after) == sum(before)


def test_frequent_keys(plain):
    left, _ = sides(plain, 6000)
    found = frequent_keys(left, ["k"], 0.1)
    seven = plain.range(1).select(F.xxhash64(F.lit(7).cast("long"))).first()[0]
    assert seven in found and len(found) <= 10
    assert frequent_keys(left.limit(0), ["k"], 0.1) == []
    with pytest.raises(ValueError, match="right side"):
        spread_join(left, left, ["k"], "outer")


def test_temporal_joins_agree(plain):
    months = [dt(2023, m, 1) for m in range(1, 5)]
    feats = plain.createDataFrame([(f"c{i % 40 if i % 3 else 0}", months[i % 4], i) for i in range(600)], "Customer_ID string, snapshot_date timestamp, x int")
    loans = plain.createDataFrame([(f"c{i % 40}", dt(2023, 7 + i % 4, 1), 6, i % 50, 1.0) for i in range(200)], "Customer_ID string, snapshot_date timestamp, mob int, dpd int, overdue_amt double")
    attrs = plain.createDataFrame([(f"c{i}", m, float(i)) for i in range(40) for m in months], "Customer_ID string, snapshot_date timestamp, Age double")
    a, b = (tm.temporal_label_join(feats, loans, spread=s) for s in (False, True))
    assert a.columns == b.columns and rows(a) == rows(b) and a.count() > 0
    c, d = (tm.join_attributes(a, attrs, loans, ["Age"], spread=s) for s in (False, True))
    assert rows(c.select(sorted(c.columns))) == rows(d.select(sorted(c.columns)))
    labels = a.select("Customer_ID", tm.FEATURE_DATE, tm.LABEL_DATE, "label").distinct()
    e, f = (tm.feature_label_join(a.drop("label"), labels, spread=s) for s in (False, True))
    assert rows(e.select(sorted(e.columns))) == rows(f.select(sorted(e.columns)))
    scores = labels.select("Customer_ID", tm.FEATURE_DATE, F.lit(1).alias("prediction"), F.lit(0.5).alias("prediction_proba_1")).distinct()
    g, h = (tm.scored_join(e, scores, spread=s) for s in (False, True))
    assert rows(g.select(sorted(g.columns))) == rows(h.select(sorted(g.columns)))
    with pytest.raises(ValueError, match="plain"):
        tm.temporal_label_join(feats, loans, spread=True, null_safe=True)
