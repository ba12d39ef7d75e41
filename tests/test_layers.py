"""Compacted ledger, gates by age, layers made flush by flush, incremental reports, replacement and clustered files."""

import time

import pytest
from pyspark.sql import functions as F

from orderlake import jobs
from orderlake import testfeed as tf
from orderlake.operators import latest, qty_by_event_time, qty_by_neighborhood
from orderlake.plans import to_gold, to_silver
from orderlake.schemas import GOLD_COLUMNS, GOLD_SCHEMA, ORDER_SCHEMA, SILVER_SCHEMA
from orderlake.sinks import (append_table_once, file_bounds, latest_stored, publish_snapshots, read_clustered, read_snapshot,
                             replace_snapshot, replace_table, replace_table_snapshot, sorted_stored, write_clustered, write_layer)
from orderlake.sources import list_databases, orders_stream
from orderlake.storage import names
from orderlake.streaming import (close_flush, consume_flushes, consume_layer, flush_ledger, gate_by_lane, gated_batch_handler,
                                 ledger, parse_orders, read_consumed, read_flushed, run_gold, run_reports, run_silver, start_ingest,
                                 stored_qty_by_event_time, stored_qty_by_neighborhood, with_lanes)
from orderlake.streaming.incremental import GOLD_PARTITIONS, gold_layout

SF = "/root/testdata/sf0.001"


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _write_rows(spark, book, rows):
    """Ledger rows of many batches, each in a folder of its own, as the gate would leave them; compacted as it goes."""
    for b, n, level, flushes, opened in rows:
        spark.createDataFrame([(b, n, level, flushes, opened, 0)], ledger.SCHEMA).coalesce(1).write.parquet(ledger.single(book, b))
        ledger.compact(spark, book, b)


def test_a_thousand_batches_are_read_from_a_few_files(spark, scratch, monkeypatch):
    """The levels of the ledger: 1,000 batches in at most 3 x 2 x RADIX folders, a late reader opens only the last ones."""
    book = f"{scratch}/_ledger"
    rows, level, flushes, opened = [], 0, 0, None
    for b in range(1_000):  # 30 rows a batch, threshold 50: every other batch flushes
        level, opened = level + 30, b if opened is None else opened
        if level > 50:
            rows.append((b, 30, 0, flushes + 1, None))
            level, flushes, opened = 0, flushes + 1, None
        else:
            rows.append((b, 30, level, flushes, opened))
    # The first 980 as segments of two levels, the rest through the gate's own writes.
    schema = ledger.SCHEMA
    for a in range(0, 900, 100):
        part = rows[a:a + 100]
        spark.createDataFrame([(*r, 0) for r in part], schema).coalesce(1).write.parquet(f"{book}/segment-2-{a:012d}-{a + 99:012d}-{part[-1][3]:012d}")
    for a in range(900, 980, 10):
        part = rows[a:a + 10]
        spark.createDataFrame([(*r, 0) for r in part], schema).coalesce(1).write.parquet(f"{book}/segment-1-{a:012d}-{a + 9:012d}-{part[-1][3]:012d}")
    _write_rows(spark, book, rows[980:])
    listed = names(spark, book)
    assert len(listed) <= 3 * 2 * ledger.RADIX and any(n.startswith("segment-3-") for n in listed)
    got = sorted(map(tuple, flush_ledger(spark, scratch).select("batch_id", "flush_id").collect()))
    assert got == [(b, b // 2 + 1) for b in range(1_000)]
    opened = []
    read = spark.read.schema(schema).parquet(f"{book}/segment-3-*").count()
    assert read == 1_000
    late = ledger.rows(spark, book, after=499)
    opened = late.inputFiles()
    assert len(opened) <= 2 * ledger.RADIX + 1
    assert sorted(r.batch_id for r in flush_ledger(spark, scratch, after=499).collect()) == [998, 999]


def test_compaction_survives_retries_and_closed_flushes(spark, scratch):
    """23 batches with a cut, repeated and closed flush: the ledger is what the plain fold says."""
    handle = gated_batch_handler(scratch, threshold=5, clock=lambda: 1000)
    line = lambda b: spark.range(2).selectExpr(f"concat('[{{\"order_id\": \"{b}-', id, '\"}}]') AS value")
    for b in range(23):
        handle(line(b), b)
        if b in (9, 19):
            handle(line(b), b)  # comes again after its compaction
        if b == 12:  # flushes of three batches: 0-2, 3-5, ...; 12 is alone in the buffer
            assert not close_flush(spark, scratch, max_age=60, now=1059) and close_flush(spark, scratch, max_age=60, now=1060)
            handle(line(b), b)  # a retry can't open the flush again
            assert not close_flush(spark, scratch, now=5000)  # nothing is held
    expect = [(b, b // 3 + 1) for b in range(12)] + [(12, 5)] + [(b, 6 + (b - 13) // 3) for b in range(13, 22)] + [(22, None)]
    assert sorted(map(tuple, flush_ledger(spark, scratch).select("batch_id", "flush_id").collect())) == expect
    assert any(n.startswith("segment-1-") for n in names(spark, f"{scratch}/_ledger"))
    assert read_flushed(spark, scratch, after=4, upto=5).count() == 2 and read_flushed(spark, scratch).count() == 44
    assert close_flush(spark, scratch) and read_flushed(spark, scratch, after=8).count() == 2


def test_gate_lets_an_old_buffer_out_with_the_next_batch(spark, scratch):
    now = [100]
    handle = gated_batch_handler(scratch, threshold=50, max_age=30, clock=lambda: now[0])
    for b, t in enumerate((100, 129, 131, 132)):
        now[0] = t
        handle(spark.createDataFrame([('[{"order_id": "a"}]',)], "value string"), b)
    assert [r.flush_id for r in flush_ledger(spark, scratch).orderBy("batch_id").collect()] == [1, 1, 1, None]


def test_keyed_gate_by_count_and_by_age(spark, scratch):
    """Lanes flush at more than 5 rows; what is left goes out by its timer, with no further input."""
    rows = [("a", i) for i in range(8)] + [("b", i) for i in range(3)] + [(None, 0)]
    orders = spark.createDataFrame([(lane, i, 0.5, None, None, i, None, 1, f"{lane}-{i}") for lane, i in rows],
                                   "lane string, object_id int, latitude double, longitude double, date string, customer_id int, "
                                   "employee_id int, quantity_products int, order_id string")
    orders.coalesce(1).write.json(f"{scratch}/in/one")
    stream = spark.readStream.schema(orders.schema).json(f"{scratch}/in/*")
    query = (gate_by_lane(stream, threshold=5, max_age=1.0).writeStream.format("parquet").option("path", f"{scratch}/out")
             .option("checkpointLocation", f"{scratch}/_ckpt").trigger(processingTime="1 second").start())
    out = lambda: spark.read.schema("lane string, order_id string, object_id int, customer_id int, flush_id long, reason string").parquet(f"{scratch}/out")
    try:  # a query with timers never runs out of batches, so there is no waiting for its end
        end = time.time() + 60
        while time.time() < end and not names(spark, f"{scratch}/out", "part-*"):
            time.sleep(0.5)
        orders.where("lane = 'b' AND object_id < 1").withColumn("order_id", F.lit("late")).coalesce(1).write.json(f"{scratch}/in/two")
        end = time.time() + 60
        while time.time() < end and query.isActive and (not names(spark, f"{scratch}/out", "part-*") or out().count() < len(rows) + 1):
            time.sleep(0.5)
    finally:
        query.stop()
    got = out().collect()
    assert sorted(r.order_id for r in got) == sorted([f"{lane}-{i}" for lane, i in rows] + ["late"])
    assert {r.reason for r in got if r.lane == "a"} == {"count"} and {r.reason for r in got if r.lane != "a"} == {"age"}
    assert {(r.customer_id, r.object_id) for r in got if r.lane == "a"} == {(i, i) for i in range(8)}
    assert {r.flush_id for r in got if r.lane == ""} == {1}


def test_lanes_split_a_hot_key(spark):
    feed = tf.feed(spark, SF).withColumn("region", F.lit("hot"))
    lanes = with_lanes(feed, 8, "region").groupBy("lane").count().collect()
    assert len(lanes) == 8 and max(r["count"] for r in lanes) < 0.25 * feed.count()


def _staged(spark, staging, parts, threshold=50):
    handle = gated_batch_handler(staging, threshold)
    feed = tf.feed(spark, SF).orderBy("order_id").limit(60 * parts).collect()

    def batch(i):
        handle(spark.createDataFrame(feed[60 * i:60 * i + 60], ORDER_SCHEMA).selectExpr("to_json(collect_list(struct(*))) AS value"), i)

    return feed, batch


def test_gated_gold_takes_only_new_flushes(spark, scratch):
    nb, dims = tf.neighborhoods(spark, SF), (tf.customers(spark, SF), tf.employees(spark, SF))
    staging, silver, gold = f"{scratch}/staging", f"{scratch}/silver", f"{scratch}/gold"
    feed, batch = _staged(spark, staging, 4)
    taken = []

    def run():
        consume_flushes(spark, staging, lambda df: to_silver(df, nb), silver, ["event_year", "event_month", "event_day"])

        def transform(df):
            taken.append(df.count())
            return gold_layout(df, *dims)

        return consume_layer(spark, silver, SILVER_SCHEMA, transform, gold, GOLD_PARTITIONS)

    done = []
    for i in (0, 1, 2):
        batch(i)
        done.append(run())
    assert done == [1, 2, 3] and taken == [60, 60, 60]  # the second and third run read their own flush only
    files = set(read_consumed(spark, gold, GOLD_SCHEMA).inputFiles())
    assert run() == 3 and set(read_consumed(spark, gold, GOLD_SCHEMA).inputFiles()) == files  # nothing new, nothing rewritten
    batch(3)
    read_consumed(spark, gold, GOLD_SCHEMA).limit(5).write.parquet(f"{gold}/_staging/flush=f0000000004-0000000004-dead")  # a run that died
    assert run() == 4 and files < set(read_consumed(spark, gold, GOLD_SCHEMA).inputFiles())
    expect = to_gold(to_silver(spark.createDataFrame(feed, ORDER_SCHEMA), nb), *dims)
    assert _same(read_consumed(spark, gold, GOLD_SCHEMA), expect)
    assert _same(spark.read.parquet(gold).select(*GOLD_COLUMNS), expect)
    assert "sale_date" in spark.read.parquet(gold).columns
    with pytest.raises(ValueError, match="is made from"):
        consume_layer(spark, f"{scratch}/other", SILVER_SCHEMA, lambda df: df, gold)


def test_second_source_into_one_layer_is_refused(spark, scratch):
    """Two staging folders of 60 orders each: nothing of the second is dropped without a word."""
    nb = tf.neighborhoods(spark, SF)
    nb.write.parquet(f"{scratch}/nb")
    for name in ("one", "two"):
        _staged(spark, f"{scratch}/{name}", 1)[1](0)
    silver = lambda raw, out: jobs.main(["silver", "--raw", f"{scratch}/{raw}", "--neighborhoods", f"{scratch}/nb", "--silver", f"{scratch}/{out}", "--gated"])
    silver("one", "silver")
    with pytest.raises(ValueError, match="is made from"):
        silver("two", "silver")
    silver("two", "silver-two")
    assert [read_consumed(spark, f"{scratch}/{s}", SILVER_SCHEMA).count() for s in ("silver", "silver-two")] == [60, 60]


def test_options_are_honored_or_refused(spark, scratch):
    gated = ["--raw", "r", "--neighborhoods", "n", "--silver", "s", "--gated"]
    for bad in (["silver", *gated, "--state", "x"], ["silver", *gated, "--max-files", "3"],
                ["ingest", "--wire", "w", "--raw", "r", "--threshold", "5", "--catalog", "db"], ["ingest", "--wire", "w", "--raw", "r", "--max-age", "5"],
                ["gold", "--silver", "s", "--customers", "c", "--employees", "e", "--gold", "g", "--gated", "--state", "x"],
                ["reports", "--gold", "g", "--out", "o", "--gated"]):
        with pytest.raises(SystemExit):
            jobs.main(bad)


def test_gated_jobs_end_to_end_with_views_and_sums(spark, scratch):
    db = "gated_" + scratch.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch}/db'")
    feed = tf.feed(spark, SF)
    for name, df in (("nb", tf.neighborhoods(spark, SF)), ("cust", tf.customers(spark, SF)), ("emp", tf.employees(spark, SF))):
        df.write.parquet(f"{scratch}/{name}")
    half = F.pmod(F.hash("value"), F.lit(2))
    for i in (0, 1):
        tf.wire_lines(spark, SF).where(half == i).coalesce(1).write.text(f"{scratch}/wire/{i}")
        jobs.main(["ingest", "--wire", f"{scratch}/wire/*", "--raw", f"{scratch}/staging", "--threshold", "1000000", "--max-age", "0"])
        jobs.main(["silver", "--raw", f"{scratch}/staging", "--neighborhoods", f"{scratch}/nb", "--silver", f"{scratch}/silver", "--gated", "--catalog", db])
        jobs.main(["gold", "--silver", f"{scratch}/silver", "--customers", f"{scratch}/cust", "--employees", f"{scratch}/emp",
                   "--gold", f"{scratch}/gold", "--gated", "--catalog", db])
        jobs.main(["reports", "--gold", f"{scratch}/gold", "--out", f"{scratch}/out", "--sums", f"{scratch}/sums", "--gated"])
    assert [spark.table(f"{db}.{t}").count() for t in ("silver", "gold")] == [feed.count()] * 2  # the last buffer left by its age
    assert spark.table(f"{db}.gold").columns == GOLD_COLUMNS
    report = spark.read.csv(f"{scratch}/out/by_neighborhood", header=True, schema="neighborhood string, quantity_products long")
    assert _same(report, qty_by_neighborhood(spark.table(f"{db}.gold")))


def test_reports_read_only_new_gold(spark, scratch):
    feed, nb, dims = tf.feed(spark, SF), tf.neighborhoods(spark, SF), (tf.customers(spark, SF), tf.employees(spark, SF))
    gold = to_gold(to_silver(feed, nb), *dims)
    extra = gold.limit(3).withColumns({"quantity_products": F.lit(None).cast("int"), "neighborhood": F.lit("only nulls"), "event_date": F.lit(None).cast("timestamp")})
    third = F.pmod(F.hash("order_id"), F.lit(3))
    seen = []
    for i in range(3):
        write_layer(gold.where(third == i).unionByName(extra) if i == 2 else gold.where(third == i), f"{scratch}/gold", i)
        q = run_reports(spark, f"{scratch}/gold/run-*", f"{scratch}/sums", f"{scratch}/_ckpt")
        seen.append(sum(p["numInputRows"] for p in q.recentProgress))
    q = run_reports(spark, f"{scratch}/gold/run-*", f"{scratch}/sums", f"{scratch}/_ckpt")  # nothing new
    assert sum(p["numInputRows"] for p in q.recentProgress) == 0
    assert seen == [gold.where(third == i).count() + (3 if i == 2 else 0) for i in range(3)]
    whole = spark.read.parquet(f"{scratch}/gold/run-*")
    assert [tuple(r) for r in stored_qty_by_neighborhood(spark, f"{scratch}/sums").collect()] == [tuple(r) for r in qty_by_neighborhood(whole).collect()]
    assert [tuple(r) for r in stored_qty_by_event_time(spark, f"{scratch}/sums").collect()] == [tuple(r) for r in qty_by_event_time(whole).collect()]
    assert ("only nulls", 0) in {tuple(r) for r in stored_qty_by_neighborhood(spark, f"{scratch}/sums").collect()}


def _database(spark, scratch, stem):
    db = stem + scratch.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch}/db'")
    return db


def test_retried_append_replaces_its_batch(spark, scratch):
    db, feed = _database(spark, scratch, "retry_"), tf.feed(spark, SF)
    half = F.pmod(F.hash("order_id"), F.lit(2))
    append_table_once(feed.where(half == 0), f"{db}.bronze", 0)
    append_table_once(feed.where(half == 1).limit(40), f"{db}.bronze", "it's 1")  # an attempt that got not all
    append_table_once(feed.select(*reversed(feed.columns)).where(half == 1), f"{db}.bronze", "it's 1")
    append_table_once(feed.where(half == 0), f"{db}.bronze", 0)
    assert _same(spark.table(f"{db}.bronze").drop("batch_id"), feed)
    assert spark.table(f"{db}.bronze").select("batch_id").distinct().count() == 2
    append_table_once(feed.limit(0), f"{db}.bronze", 0)  # a retry without rows leaves none
    assert spark.table(f"{db}.bronze").where("batch_id = '0'").count() == 0
    with pytest.raises(ValueError):
        append_table_once(feed.drop("date"), f"{db}.bronze", 2)


def test_readers_see_the_old_version_until_the_new_one_is_whole(spark, scratch):
    base = f"{scratch}/dim"
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, base)
    replace_snapshot(spark.range(10), base)
    old = read_snapshot(spark, base)
    broken = spark.range(20).select(F.when(F.col("id") == 19, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        replace_snapshot(broken, base)
    assert read_snapshot(spark, base).count() == 10  # a failed write changes nothing
    replace_snapshot(read_snapshot(spark, base).union(spark.range(5)), base)  # reads what it replaces
    assert read_snapshot(spark, base).count() == 15 and old.count() == 10  # a reader that began before goes on
    for n in (1, 2, 3):
        replace_snapshot(spark.range(n), base)
    assert read_snapshot(spark, base).count() == 3 and len(names(spark, base, "v-*")) == 2


def test_a_table_may_be_replaced_from_itself(spark, scratch):
    db, feed = _database(spark, scratch, "swap_"), tf.feed(spark, SF)
    replace_table(feed.limit(10), f"{db}.bronze")  # a managed table gives way
    replace_table_snapshot(feed, f"{db}.bronze", partition_by=["object_id"])
    replace_table_snapshot(spark.table(f"{db}.bronze").where("object_id < 5"), f"{db}.bronze")
    assert _same(spark.table(f"{db}.bronze"), feed.where("object_id < 5")) and spark.table(f"{db}.bronze").columns == feed.columns
    out = publish_snapshots(spark, [f"{SF}/nation.parquet", f"{SF}/region.parquet"], f"{scratch}/dims")
    publish_snapshots(spark, [f"{SF}/nation.parquet"], f"{scratch}/dims")
    assert read_snapshot(spark, out["nation"]).count() == 25 and read_snapshot(spark, out["region"]).count() == 5


def test_latest_rows_come_from_a_few_files(spark, scratch):
    feed = tf.feed(spark, SF)
    n = feed.count()
    write_clustered(feed.where("quantity_products % 2 = 0"), scratch, files=16)
    write_clustered(feed.where("quantity_products % 2 <> 0"), scratch, files=16)
    assert file_bounds(spark, scratch).agg(F.sum("n_rows")).first()[0] == n and file_bounds(spark, scratch).count() >= 24
    top = latest_stored(spark, scratch, ORDER_SCHEMA, 20)
    assert [tuple(r) for r in top.collect()] == [tuple(r) for r in latest(feed, 20).collect()]
    assert len(top.inputFiles()) <= 4
    feed.limit(100).write.parquet(f"{scratch}/run-{'0' * 12}")  # a run without bounds does not count
    assert read_clustered(spark, scratch, ORDER_SCHEMA).count() == n
    assert [r.order_id for r in sorted_stored(spark, scratch, ORDER_SCHEMA).collect()] == sorted((r.order_id for r in feed.collect()), reverse=True)
    everything = latest_stored(spark, scratch, ORDER_SCHEMA, n + 5)
    assert everything.count() == n


def test_latest_rows_with_ties_and_null_keys(spark, scratch):
    rows = spark.range(1_000).select(F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "hot").otherwise(
        F.lpad(F.col("id").cast("string"), 4, "0")).alias("order_id"), F.col("id"))
    write_clustered(rows, scratch, files=8)
    for n in (1, 50, 400, 800, 2_000):
        got, expect = latest_stored(spark, scratch, rows.schema, n).collect(), latest(rows, n).collect()
        assert [r.order_id for r in got] == [r.order_id for r in expect]
    assert latest_stored(spark, scratch, rows.schema, 50).where("order_id = 'hot'").count() == 50


def test_databases_are_listed(spark, scratch):
    db = _database(spark, scratch, "listed_")
    assert db in {r.namespace for r in list_databases(spark).collect()}


def test_run_layers_feed_the_sums(spark, scratch):
    """The plain jobs' gold (a file sink's folder) as the source of the sums."""
    feed, nb, dims = tf.feed(spark, SF), tf.neighborhoods(spark, SF), (tf.customers(spark, SF), tf.employees(spark, SF))
    tf.wire_lines(spark, SF).write.text(f"{scratch}/wire/a")
    start_ingest(orders_stream(spark, "text", f"{scratch}/wire/*"), f"{scratch}/raw", f"{scratch}/_c/i", trigger={"availableNow": True}).awaitTermination()
    run_silver(spark, f"{scratch}/raw", nb, f"{scratch}/silver", f"{scratch}/_c/s")
    run_gold(spark, f"{scratch}/silver", SILVER_SCHEMA, *dims, f"{scratch}/gold", f"{scratch}/_c/g")
    run_reports(spark, f"{scratch}/gold", f"{scratch}/sums", f"{scratch}/_c/r")
    expect = qty_by_neighborhood(to_gold(to_silver(feed, nb), *dims))
    assert _same(stored_qty_by_neighborhood(spark, f"{scratch}/sums"), expect)
    assert parse_orders(tf.wire_lines(spark, SF)).count() == feed.count()
