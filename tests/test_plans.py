"""Physical-plan checks: pruning, pushdown, broadcast and no fact-side shuffle."""

import re

from conftest import plan_text
from pyspark.sql import functions as F

from orderlake import testfeed as tf
from orderlake.operators import at_coordinate, latest_first, qty_by_neighborhood
from orderlake.plans import to_gold, to_silver
from orderlake.schemas import ORDER_SCHEMA
from orderlake.sinks import write_layer

SF = "/root/testdata/sf0.001"


def _shuffles(plan: str) -> int:
    """Number of shuffle exchanges in the plan tree (broadcasts not counted)."""
    tree = plan.split("\n\n\n")[0]
    return len(re.findall(r"(?<!Broadcast)Exchange \(\d+\)", tree))


def _gold(spark):
    return to_gold(to_silver(tf.feed(spark, SF), tf.neighborhoods(spark, SF)),
                   tf.customers(spark, SF), tf.employees(spark, SF))


def test_gold_prunes_dimension_columns_and_does_not_shuffle_orders(spark):
    plan = plan_text(_gold(spark))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan
    assert "ReadSchema: struct<s_suppkey:bigint,s_name:string,s_acctbal:double>" in plan
    assert "BroadcastHashJoin LeftOuter" in plan
    assert "SortMergeJoin" not in plan and _shuffles(plan) == 0


def test_coordinate_filter_reaches_parquet_scan(spark, scratch):
    path = write_layer(tf.feed(spark, SF), scratch, 1)
    plan = plan_text(at_coordinate(spark.read.schema(ORDER_SCHEMA).parquet(path), 0.91, 0.37))
    assert "PushedFilters: [IsNotNull(latitude), IsNotNull(longitude), EqualTo(latitude,0.91), " \
           "EqualTo(longitude,0.37)]" in plan


def test_report_aggregates_partially_before_shuffle(spark):
    plan = plan_text(qty_by_neighborhood(_gold(spark)))
    assert "partial_sum" in plan


def test_sort_has_tiebreak_for_hot_keys(spark):
    df = spark.range(100).select(F.lit("same").alias("order_id"), "id")
    plan = plan_text(latest_first(df))
    assert "xxhash64" in plan
    assert df.count() == latest_first(df).count()


def test_bucketed_dimension_is_not_shuffled(spark, scratch):
    from orderlake.operators import add_customer
    from orderlake.sources import init_catalog, scan_table
    db = "ol_bucket_" + scratch.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch}/db'")
    init_catalog(spark, db, {"customers": tf.customers(spark, SF)}, buckets={"customers": ("customer_id", 8)})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = add_customer(tf.feed(spark, SF), scan_table(spark, f"{db}.customers"))
        plan = plan_text(joined)
        assert "SortMergeJoin" in plan
        assert _shuffles(plan) == 1 and "Bucketed: true" in plan  # only the order side moves
        assert joined.count() == tf.feed(spark, SF).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_customer_join_is_split_by_aqe(spark):
    """A third of the orders on one customer and a third with a null key: with the
    dimension too big to broadcast, AQE splits the skewed partitions of the
    sort-merge join instead of giving them to one task."""
    from orderlake.operators import add_customer
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        orders = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit(1))
             .when(F.col("id") % 3 == 1, F.lit(None).cast("int"))
             .otherwise((F.col("id") % 1000).cast("int")).alias("customer_id"),
            F.col("id").alias("order_id"))
        customers = spark.range(1000).select(F.col("id").cast("int").alias("customer_id"),
                                             F.concat(F.lit("c"), F.col("id")).alias("name"),
                                             F.lit("p").alias("phone"), F.lit("e").alias("email"),
                                             F.lit("a").alias("address"))
        joined = add_customer(orders, customers)
        assert len(joined.collect()) == 30000
        final = plan_text(joined)  # the executed, final adaptive plan
        assert "isFinalPlan=true" in final and "SortMergeJoin(skew=true)" in final
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_reports_read_stored_gold_and_join_nothing(spark):
    from orderlake.registry import QUERIES
    for key in ("agg_qty_by_neighborhood", "agg_qty_by_event_time"):
        plan = plan_text(QUERIES[key](spark, "/root/testdata/sf0.001"))
        assert "Join" not in plan and "Scan parquet" in plan
