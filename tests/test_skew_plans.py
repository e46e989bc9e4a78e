"""Hot keys give the same rows, and plans keep the shape they are meant to have."""

import pytest
from pyspark.sql import functions as F

from tallygrid.operators import counts as ct, layers, ranking as rk
from tallygrid.operators.skew import lookup_join

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_lookup_join_with_a_hot_key(spark, rows, how):
    left = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 50).alias("k"), "id")
    right = spark.range(-1, 40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    want = rows(left.join(right, ["k"], how))
    assert rows(lookup_join(left, right, ["k"], how, task_rows=20)) == want
    assert rows(lookup_join(left, right, ["k"], how)) == want
    assert rows(lookup_join(left.limit(0), right, ["k"], how)) == []


def test_hot_rows_are_spread(spark):
    left = spark.range(400).select(F.lit(1).alias("k"), "id")
    right = spark.createDataFrame([(1, "v")], "k int, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = lookup_join(left, right, ["k"], task_rows=10)
        used = joined.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert used > 3


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_are_taken_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, "a")], "cell_lat long, cell_lng long, text string")
    plan = plan_of(ct.cell_counts(df))
    assert plan.count("Exchange") == 1 and "partial_count" in plan and "Python" not in plan


def test_groups_are_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, "a", 1)], "cell_lat long, cell_lng long, word string, cnt long")
    plan = plan_of(rk.pivot_topk(df, ct.CELL))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert "TakeOrderedAndProject" in plan_of(rk.top_k(df, rk.by_count(), 10))


def test_a_message_is_parsed_once(spark):
    from workload import suite

    plan = suite.queue_word_counts(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_message_counts_read_no_text(spark):
    from workload import inputs

    plan = plan_of(ct.cell_messages(inputs.located_messages(spark, SF)))
    assert "text:" not in plan


def test_time_filters_reach_the_partitions(spark, path):
    out = path()
    spark.createDataFrame([("15020412", None, 1)], "yymmddhh string, timestamp timestamp, v int") \
        .write.partitionBy("yymmddhh").parquet(out)
    stored = spark.read.schema("timestamp timestamp, v int, yymmddhh string").parquet(out)
    since = F.lit("2015-02-04 12:00:00").cast("timestamp")
    for df in (layers.changes_since(stored, since), layers.bucket(stored, "15020412"),
               layers.latest_bucket(stored, since)):
        assert "PartitionFilters: []" not in plan_of(df)
