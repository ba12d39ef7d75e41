"""

Every query reads the driver's tables (through :mod:`orderlake.testfeed`) in
full. Keys that write put their files below a fresh folder under the shared
``spark.checkpoint.dir`` and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import testfeed as tf
from .functions.timeparts import epoch_to_text, parse_event_time, text_to_epoch, time_parts_by_substring
from .operators import (add_customer, add_employee, add_neighborhood, append_orders,
                        assign_polygon, at_coordinate, count_rows, drop_key, latest, latest_first,
                        lookup_by_coordinate, neighborhood_dim, pick, points_in_polygons, polygon_bounds,
                        qty_by_event_time, qty_by_neighborhood, rename, sample_dim,
                        union_versions, with_constant, within_area)
from .plans import add_time_parts, to_gold, to_silver
from .schemas import GOLD_COLUMNS, GOLD_SCHEMA, ORDER_SCHEMA, SILVER_COLUMNS, SILVER_SCHEMA
from .session import scratch_path
from .sinks import (append_layer, append_table, append_table_once, export_csv, latest_stored, publish_dims, publish_snapshots,
                    read_snapshot, replace_table, replace_table_snapshot, sorted_stored, write_clustered, write_layer)
from .sources import (empty_orders, init_catalog, list_databases, list_tables, orders_stream, read_bronze_json,
                      read_landing, read_parquet, scan_table)
from .storage import move, names
from .streaming import (LANDING_SCHEMA, consume_flushes, consume_layer, flush_ledger, parse_orders, quarantine, read_consumed,
                        read_flushed, run_gold, run_reports, run_silver, start_gated_ingest, start_ingest,
                        start_ingest_with_quarantine, stored_qty_by_event_time, stored_qty_by_neighborhood)
from .streaming.incremental import GOLD_PARTITIONS, SILVER_PARTITIONS, gold_layout

# Grid cell of the spatial joins: about the width of a test polygon.
CELL = 1.0

Query = Callable[[SparkSession, str], DataFrame]


def _gold(spark: SparkSession, d: str) -> DataFrame:
    silver = to_silver(tf.feed(spark, d), tf.neighborhoods(spark, d))
    return to_gold(silver, tf.customers(spark, d), tf.employees(spark, d))


def _stored_gold(spark: SparkSession, d: str) -> DataFrame:
    """Gold as a stored layer; reports read it back and join nothing."""
    path = write_layer(_gold(spark, d), scratch_path(spark, "gold-layer"), 1)
    return spark.read.parquet(path)


def _scratch_db(spark: SparkSession, key: str) -> str:
    """A database of its own, located under the shared scratch folder."""
    path = scratch_path(spark, key)
    name = "ol_" + path.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{path}/db'")
    return name


# --- scans ------------------------------------------------------------------

def q_scan_parquet(spark, d):
    return read_parquet(spark, f"{d}/customer.parquet")


def q_scan_landing_glob(spark, d):
    base = scratch_path(spark, "landing")
    feed = tf.feed(spark, d)
    for run in range(3):
        write_layer(feed.where(F.pmod(F.hash("order_id"), F.lit(3)) == run), base, run)
    return read_landing(spark, f"{base}/run-*", ORDER_SCHEMA)


def q_scan_json(spark, d):
    path = scratch_path(spark, "bronze-json")
    tf.feed(spark, d).write.mode("overwrite").json(path)
    return read_bronze_json(spark, path, ORDER_SCHEMA)


def q_scan_table(spark, d):
    db = _scratch_db(spark, "scan-table")
    replace_table(tf.neighborhoods(spark, d), f"{db}.neighborhoods")
    return scan_table(spark, f"{db}.neighborhoods")


def q_empty_frame(spark, d):
    return append_orders(empty_orders(spark), tf.feed(spark, d))


# --- sinks and catalog ---------------------------------------------------------

def q_sink_parquet_overwrite(spark, d):
    base = scratch_path(spark, "overwrite")
    feed = tf.feed(spark, d)
    write_layer(feed, base, "same")
    path = write_layer(feed, base, "same")
    return spark.read.schema(ORDER_SCHEMA).parquet(path)


def q_sink_parquet_append(spark, d):
    path = scratch_path(spark, "append")
    feed = tf.feed(spark, d)
    append_layer(feed, path)
    append_layer(feed, path)
    return spark.read.schema(ORDER_SCHEMA).parquet(path)


def q_sink_table_append(spark, d):
    db = _scratch_db(spark, "table-append")
    feed = tf.feed(spark, d)
    append_table(feed, f"{db}.bronze")
    append_table(feed.select(*reversed(feed.columns)), f"{db}.bronze")
    return scan_table(spark, f"{db}.bronze")


def q_sink_table_overwrite(spark, d):
    db = _scratch_db(spark, "table-overwrite")
    feed = tf.feed(spark, d)
    replace_table(feed, f"{db}.bronze")
    replace_table(feed, f"{db}.bronze")
    return scan_table(spark, f"{db}.bronze")


def q_sink_csv_roundtrip(spark, d):
    path = scratch_path(spark, "gold-csv")
    gold = _gold(spark, d)
    export_csv(gold, path)
    return spark.read.schema(gold.schema).csv(path, header=True)


def q_publish_dims(spark, d):
    dest = scratch_path(spark, "dims")
    out = publish_dims(spark, [f"{d}/{n}.parquet" for n in ("customer", "supplier", "nation")], dest)
    frames = [spark.read.parquet(out[n]).select(F.lit(n).alias("dim"), F.col(k).cast("bigint").alias("k"), F.col(c).alias("name"))
              for n, k, c in (("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name"), ("nation", "n_nationkey", "n_name"))]
    return append_orders(*frames)


def _dims(spark, d):
    return {"customers": tf.customers(spark, d), "employees": tf.employees(spark, d),
            "neighborhoods": tf.neighborhoods(spark, d), "municipality": tf.boundary(spark)}


def q_catalog_init(spark, d):
    db = _scratch_db(spark, "catalog")
    dims = _dims(spark, d)
    init_catalog(spark, db, dims)
    init_catalog(spark, db, dims)
    named = {"customers": ("customer_id", "name"), "employees": ("employee_id", "name"),
             "neighborhoods": ("OBJECTID", "NOMBRE"), "municipality": ("polygon_id", "name")}
    return append_orders(*[scan_table(spark, f"{db}.{n}").select(F.lit(n).alias("table_name"), F.col(k).cast("bigint").alias("k"),
                                                                F.col(c).alias("name")) for n, (k, c) in named.items()])


def q_catalog_list(spark, d):
    db = _scratch_db(spark, "catalog-list")
    init_catalog(spark, db, _dims(spark, d))
    return list_tables(spark, db)


# --- projections and filters ---------------------------------------------------

def q_project_star_plus(spark, d):
    feed, nb = tf.feed(spark, d), tf.neighborhoods(spark, d)
    joined = feed.join(nb, feed["object_id"] == nb["OBJECTID"], "left")
    return pick(joined, feed, {"NOMBRE": "neighborhood"}, nb)


def q_project_drop_ref(spark, d):
    feed, nb = tf.feed(spark, d), tf.neighborhoods(spark, d)
    return drop_key(feed.join(nb, feed["object_id"] == nb["OBJECTID"]), nb["OBJECTID"])


def q_project_alias(spark, d):
    return neighborhood_dim(tf.neighborhoods(spark, d))


def q_project_rename(spark, d):
    return rename(tf.feed(spark, d), {"order_id": "order_key"})


def q_project_literal(spark, d):
    return with_constant(tf.feed(spark, d), "source", "feed")


def q_filter_eq_and(spark, d):
    raw = write_layer(tf.feed(spark, d), scratch_path(spark, "raw"), 1)  # stored columns, so the filter reaches the scan
    return at_coordinate(spark.read.schema(ORDER_SCHEMA).parquet(raw), 0.91, 0.37)


def q_sql_project_limit(spark, d):
    return sample_dim(tf.neighborhoods(spark, d), ["OBJECTID", "NOMBRE"], ["OBJECTID"], 5)


# --- silver, gold, joins --------------------------------------------------------

def q_silver_time_parts(spark, d):
    return add_time_parts(tf.feed(spark, d))


def q_silver_neighborhood(spark, d):
    return add_neighborhood(tf.feed(spark, d), tf.neighborhoods(spark, d))


def q_silver_spatial(spark, d):
    return to_silver(tf.feed(spark, d), tf.neighborhoods(spark, d),
                     polygons=tf.polygons(spark, (1, 2, 3)), cell=CELL)


def q_silver_orders(spark, d):
    return to_silver(tf.feed(spark, d), tf.neighborhoods(spark, d))


def q_enrich_customer(spark, d):
    return add_customer(tf.feed(spark, d), tf.customers(spark, d))


def q_enrich_employee(spark, d):
    return add_employee(tf.feed(spark, d), tf.employees(spark, d))


def q_gold_detailed_sales(spark, d):
    return _gold(spark, d)


def q_join_coordinate_exact(spark, d):
    feed = tf.feed(spark, d)
    places = feed.groupBy("latitude", "longitude").agg(F.min("object_id").alias("place_id"))
    nb = neighborhood_dim(tf.neighborhoods(spark, d)).withColumnRenamed("object_id", "place_id")
    named = places.join(nb, on="place_id", how="left")
    return lookup_by_coordinate(feed.select("order_id", "latitude", "longitude"), named)


# --- spatial ------------------------------------------------------------------------

def _points(spark, d):
    return tf.feed(spark, d).select("order_id", "longitude", "latitude")


def q_spatial_point_in_polygon(spark, d):
    return points_in_polygons(_points(spark, d), tf.polygons(spark, (1, 2)), CELL)


def q_spatial_assign_left(spark, d):
    return assign_polygon(_points(spark, d), tf.polygons(spark, (1, 2, 3)), CELL)


def q_spatial_semi(spark, d):
    return within_area(tf.feed(spark, d), tf.boundary(spark), tf.polygons(spark, (1, 2, 3)), CELL)


def q_spatial_bounds(spark, d):
    return polygon_bounds(tf.parcels(spark, d))


# --- aggregates, sorts, unions -------------------------------------------------------

def q_agg_count(spark, d):
    return count_rows(tf.feed(spark, d))


def q_agg_qty_by_neighborhood(spark, d):
    return qty_by_neighborhood(_stored_gold(spark, d))


def q_agg_qty_by_event_time(spark, d):
    return qty_by_event_time(_stored_gold(spark, d))


def q_sort_desc(spark, d):
    return latest_first(tf.feed(spark, d))


def q_topk_latest(spark, d):
    return latest(tf.feed(spark, d), 20)


def q_union_all(spark, d):
    feed = tf.feed(spark, d)
    return append_orders(feed, feed)


def q_union_schema_versions(spark, d):
    feed = tf.feed(spark, d)
    return union_versions(feed, feed.drop("object_id"))


# --- draft-only scalar functions -----------------------------------------------------

def q_time_epoch_roundtrip(spark, d):
    feed = tf.feed(spark, d)
    epoch = text_to_epoch("date")
    return feed.select("order_id", epoch.alias("event_epoch"),
                       epoch_to_text(epoch).alias("event_time_text"),
                       epoch_to_text(epoch, "yyyyMMdd").alias("event_day_text"))


def q_time_parts_by_substring(spark, d):
    feed = tf.feed(spark, d)
    return feed.select("order_id", *[c.alias(n) for n, c in
                                     time_parts_by_substring(parse_event_time("date")).items()])


# --- ingest, streaming, incremental -------------------------------------------------

def q_wire_roundtrip(spark, d):
    return parse_orders(tf.wire_lines(spark, d))


def q_ingest_parse(spark, d):
    return parse_orders(append_orders(tf.wire_lines(spark, d), tf.bad_lines(spark)))


def q_ingest_quarantine(spark, d):
    return quarantine(append_orders(tf.wire_lines(spark, d), tf.bad_lines(spark)))


def q_ingest_stream(spark, d):
    base = scratch_path(spark, "ingest")
    tf.wire_lines(spark, d).write.mode("overwrite").text(f"{base}/wire")
    query = start_ingest(orders_stream(spark, "text", f"{base}/wire"), f"{base}/raw",
                         f"{base}/_ckpt/ingest", trigger={"availableNow": True})
    query.awaitTermination()
    return spark.read.schema(ORDER_SCHEMA).parquet(f"{base}/raw")


def q_consume_incremental(spark, d):
    base = scratch_path(spark, "incremental")
    feed, nb = tf.feed(spark, d), tf.neighborhoods(spark, d)
    half = F.pmod(F.hash("order_id"), F.lit(2))
    raw, silver, ckpt = f"{base}/raw", f"{base}/silver", f"{base}/_ckpt/silver"
    write_layer(feed.where(half == 0), raw, 1)
    run_silver(spark, f"{raw}/run-*", nb, silver, ckpt)
    write_layer(feed.where(half == 1), raw, 2)
    run_silver(spark, f"{raw}/run-*", nb, silver, ckpt)
    run_silver(spark, f"{raw}/run-*", nb, silver, ckpt)  # nothing new: a no-op
    return spark.read.parquet(silver).select(*SILVER_COLUMNS)


def q_gold_incremental(spark, d):
    base = scratch_path(spark, "gold-incremental")
    feed, dims = tf.feed(spark, d), (tf.customers(spark, d), tf.employees(spark, d))
    half = F.pmod(F.hash("order_id"), F.lit(2))
    for part in (0, 1):
        write_layer(feed.where(half == part), f"{base}/raw", part)
        run_silver(spark, f"{base}/raw/run-*", tf.neighborhoods(spark, d), f"{base}/silver", f"{base}/_ckpt/silver")
        run_gold(spark, f"{base}/silver", SILVER_SCHEMA, *dims, f"{base}/gold", f"{base}/_ckpt/gold")
    return spark.read.parquet(f"{base}/gold").select(*GOLD_COLUMNS)


def q_ingest_with_quarantine(spark, d):
    base = scratch_path(spark, "ingest-quarantine")
    append_orders(tf.wire_lines(spark, d), tf.bad_lines(spark)).write.text(f"{base}/wire")
    start_ingest_with_quarantine(orders_stream(spark, "text", f"{base}/wire"), f"{base}/landing", f"{base}/_ckpt",
                                 trigger={"availableNow": True}).awaitTermination()
    return spark.read.schema(LANDING_SCHEMA).parquet(f"{base}/landing")


# Rows that the gate of the two keys below holds back, and the days of a wire file.
GATE_ROWS, GATE_DAYS = 600, 3


def _gated(spark: SparkSession, d: str, between: Callable[[str], None] | None = None) -> str:
    """Run the gate over a feed that comes three days at a time, each in one micro-batch; the staging folder.

    ``between`` is called with it after the first half of the feed and at the end.
    """
    base = scratch_path(spark, "gated")
    feed = tf.feed(spark, d).withColumn("part", F.floor(F.substring("date", 1, 2).cast("int") / GATE_DAYS))
    wire = feed.select("part", F.to_json(F.array(F.struct(*ORDER_SCHEMA.names))).alias("value"))
    wire.write.partitionBy("part").text(f"{base}/wire")
    parts = sorted(int(n.split("=")[1]) for n in names(spark, f"{base}/wire", "part=*"))  # at most eleven
    for i, part in enumerate(parts):  # as many files as there are tasks; one scheduled run of the gate each
        move(spark, f"{base}/wire/part={part}", f"{base}/landed/days-{part:02d}")
        start_gated_ingest(orders_stream(spark, "text", f"{base}/landed/*"), f"{base}/staging", f"{base}/_ckpt", threshold=GATE_ROWS,
                           trigger={"availableNow": True}).awaitTermination()
        if between and i in (len(parts) // 2, len(parts) - 1):
            between(f"{base}/staging")
    return f"{base}/staging"


def q_flush_by_count(spark, d):
    return flush_ledger(spark, _gated(spark, d))


def q_ingest_gated(spark, d):
    return read_flushed(spark, _gated(spark, d))


def q_gold_gated(spark, d):
    """Silver and gold made flush by flush, in two runs."""
    base, nb, dims = scratch_path(spark, "gold-gated"), tf.neighborhoods(spark, d), (tf.customers(spark, d), tf.employees(spark, d))

    def run(staging: str) -> None:
        consume_flushes(spark, staging, lambda df: to_silver(df, nb), f"{base}/silver", SILVER_PARTITIONS)
        consume_layer(spark, f"{base}/silver", SILVER_SCHEMA, lambda df: gold_layout(df, *dims), f"{base}/gold", GOLD_PARTITIONS)

    _gated(spark, d, run)
    return read_consumed(spark, f"{base}/gold", GOLD_SCHEMA)


# --- replacement without a gap, retries, incremental reports, clustered layers --------

def q_sink_table_append_retry(spark, d):
    db = _scratch_db(spark, "append-retry")
    feed, half = tf.feed(spark, d), F.pmod(F.hash("order_id"), F.lit(2))
    for batch in (0, 1, 1, 0):  # both batches come twice
        append_table_once(feed.where(half == batch), f"{db}.bronze", batch)
    return scan_table(spark, f"{db}.bronze").drop("batch_id")


def q_sink_table_overwrite_self(spark, d):
    name = f"{_scratch_db(spark, 'overwrite-self')}.bronze"
    replace_table_snapshot(tf.feed(spark, d), name)
    replace_table_snapshot(scan_table(spark, name).where("object_id < 20"), name)  # reads the table that it replaces
    return scan_table(spark, name)


def q_publish_dims_atomic(spark, d):
    dest, dims = scratch_path(spark, "dims-atomic"), ("customer", "supplier", "nation")
    for _ in range(2):
        out = publish_snapshots(spark, [f"{d}/{n}.parquet" for n in dims], dest)
    frames = [read_snapshot(spark, out[n]).select(F.lit(n).alias("dim"), F.col(k).cast("bigint").alias("k"), F.col(c).alias("name"))
              for n, k, c in zip(dims, ("c_custkey", "s_suppkey", "n_nationkey"), ("c_name", "s_name", "n_name"))]
    return append_orders(*frames)


def _report_sums(spark: SparkSession, d: str) -> str:
    """Partial sums of a gold layer that grew in three steps, a report run after each."""
    base, gold = scratch_path(spark, "report-sums"), _gold(spark, d)
    third = F.pmod(F.hash("order_id"), F.lit(3))
    for i in range(3):
        write_layer(gold.where(third == i), f"{base}/gold", i)
        run_reports(spark, f"{base}/gold/run-*", f"{base}/sums", f"{base}/_ckpt")
    return f"{base}/sums"


def q_report_incremental_neighborhood(spark, d):
    return stored_qty_by_neighborhood(spark, _report_sums(spark, d))


def q_report_incremental_time(spark, d):
    return stored_qty_by_event_time(spark, _report_sums(spark, d))


def _clustered(spark: SparkSession, d: str) -> str:
    path, feed = scratch_path(spark, "clustered"), tf.feed(spark, d)
    half = F.pmod(F.hash("order_id"), F.lit(2))
    for i in (0, 1):  # two runs of one layer
        write_clustered(feed.where(half == i), path, files=32)
    return path


def q_topk_latest_stored(spark, d):
    return latest_stored(spark, _clustered(spark, d), ORDER_SCHEMA, 20)


def q_sort_desc_stored(spark, d):
    return sorted_stored(spark, _clustered(spark, d), ORDER_SCHEMA)


def q_catalog_databases(spark, d):
    """One database a region, listed."""
    stem = "ol_" + scratch_path(spark, "databases").rsplit("-", 1)[-1] + "_"
    for r in tf.table(spark, d, "region").select(F.lower(F.regexp_replace("r_name", "[^A-Za-z]", "_")).alias("n")).collect():  # five regions
        spark.sql(f"CREATE DATABASE {stem}{r.n} LOCATION '{scratch_path(spark, r.n)}'")
    return list_databases(spark).where(F.col("namespace").startswith(stem)).select(F.expr(f"substr(namespace, {len(stem) + 1})").alias("region"))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
