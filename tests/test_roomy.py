"""Joins whose tasks stay as small however many rows there are."""

from pyspark.sql import functions as F

from monthglass import session
from monthglass.plans import queries_models
from monthglass.session import roomy


def test_partitions_follow_the_rows(spark):
    own = roomy(spark, 100 * session.ROOM + 1)
    assert own.conf.get("spark.sql.shuffle.partitions") == "101"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert roomy(spark, 5).conf.get("spark.sql.shuffle.partitions") == "8"


def test_joins_of_the_stores_have_partitions_by_their_rows(spark, tmp_path, monkeypatch):
    orders = [(i, i % 3, 1.0, "2024-01-15 00:00:00") for i in range(10)]
    lines = [(i % 10, 1 + i // 10, 5.0, 0.1, "N", "2024-03-02 00:00:00") for i in range(40)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double, d string").withColumn(
        "o_orderdate", F.to_timestamp("d")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_extendedprice double, l_discount double, l_returnflag string, d string").withColumn(
        "l_shipdate", F.to_timestamp("d")).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(session, "ROOM", 2)
    found = queries_models.scored_by_key(spark, str(tmp_path))
    assert found.sparkSession.conf.get("spark.sql.shuffle.partitions") == "20"
    # Customer 0 has 16 lines, the others 12 each; each meets all of its customer and month.
    assert sorted(r.n for r in found.collect()) == [12] * 24 + [16] * 16
