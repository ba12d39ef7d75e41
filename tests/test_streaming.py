from pyspark.sql import functions as F

from orderlake import testfeed as tf
from orderlake.plans import to_gold, to_silver
from orderlake.schemas import GOLD_COLUMNS, ORDER_SCHEMA, SILVER_COLUMNS
from orderlake.sinks import write_layer
from orderlake.sources import orders_stream
from orderlake.streaming import run_gold, run_silver, start_ingest

SF = "/root/testdata/sf0.001"


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_ingest_restart_and_new_files(spark, scratch):
    wire = tf.wire_lines(spark, SF)
    half = F.pmod(F.hash("value"), F.lit(2))
    wire.where(half == 0).write.text(f"{scratch}/wire/part-a")
    args = (f"{scratch}/raw", f"{scratch}/_ckpt/ingest")

    def run():
        q = start_ingest(orders_stream(spark, "text", f"{scratch}/wire/*"), *args,
                         trigger={"availableNow": True})
        q.awaitTermination()

    run()
    first = spark.read.schema(ORDER_SCHEMA).parquet(args[0]).count()
    run()  # restart without new data: nothing is added
    assert spark.read.schema(ORDER_SCHEMA).parquet(args[0]).count() == first
    wire.where(half == 1).write.text(f"{scratch}/wire/part-b")
    run()
    assert _same(spark.read.schema(ORDER_SCHEMA).parquet(args[0]), tf.feed(spark, SF))


def test_incremental_layers_equal_batch(spark, scratch):
    feed, nb = tf.feed(spark, SF), tf.neighborhoods(spark, SF)
    cust, emp = tf.customers(spark, SF), tf.employees(spark, SF)
    third = F.pmod(F.hash("order_id"), F.lit(3))
    raw, silver, gold = f"{scratch}/raw", f"{scratch}/silver", f"{scratch}/gold"
    for i in range(3):
        write_layer(feed.where(third == i), raw, i)
        run_silver(spark, f"{raw}/run-*", nb, silver, f"{scratch}/_ckpt/silver")
    run_silver(spark, f"{raw}/run-*", nb, silver, f"{scratch}/_ckpt/silver")
    batch_silver = to_silver(feed, nb)
    got_silver = spark.read.parquet(silver).select(*SILVER_COLUMNS)
    assert _same(got_silver, batch_silver)
    run_gold(spark, silver, batch_silver.schema, cust, emp, gold, f"{scratch}/_ckpt/gold")
    run_gold(spark, silver, batch_silver.schema, cust, emp, gold, f"{scratch}/_ckpt/gold")
    assert _same(spark.read.parquet(gold).select(*GOLD_COLUMNS), to_gold(batch_silver, cust, emp))


def test_gated_ingest_flushes_like_the_fold(spark, scratch):
    from orderlake.streaming import flush_ledger, read_flushed, start_gated_ingest
    feed = tf.feed(spark, SF).orderBy("order_id").limit(7 * 20).collect()
    for i in range(20):  # 20 wire files of 7 orders, one micro-batch each
        spark.createDataFrame(feed[7 * i:7 * i + 7], ORDER_SCHEMA).selectExpr(
            "to_json(collect_list(struct(*))) AS value").write.text(f"{scratch}/wire/f{i:03d}")

    def run():
        q = start_gated_ingest(orders_stream(spark, "text", f"{scratch}/wire/*", maxFilesPerTrigger="1"),
                               f"{scratch}/staging", f"{scratch}/_ckpt", threshold=50, trigger={"availableNow": True})
        q.awaitTermination()

    assert read_flushed(spark, f"{scratch}/staging").count() == 0  # nothing there yet
    run()
    run()  # restart with nothing new
    # 56 > 50 after every 8th batch: two flushes of 56 rows, 4 batches (28 rows) still buffered
    assert read_flushed(spark, f"{scratch}/staging").count() == 112
    assert read_flushed(spark, f"{scratch}/staging", after=1).count() == 56
    ledger = flush_ledger(spark, f"{scratch}/staging").orderBy("batch_id").collect()
    assert [r.flush_id for r in ledger] == [1] * 8 + [2] * 8 + [None] * 4
    assert [r.batch_id for r in ledger if r.flushed] == [7, 15]


def test_jobs_cli_end_to_end(spark, scratch):
    from orderlake import jobs
    from orderlake.schemas import SILVER_SCHEMA
    from orderlake.sources import register_layer
    wire, raw, silver, gold = (f"{scratch}/{n}" for n in ("wire", "raw", "silver", "gold"))
    tf.wire_lines(spark, SF).write.text(f"{wire}/a")
    for name, df in (("nb", tf.neighborhoods(spark, SF)), ("cust", tf.customers(spark, SF)),
                     ("emp", tf.employees(spark, SF))):
        df.write.parquet(f"{scratch}/dims/{name}")
    state = ["--state", f"{scratch}/_state"]
    jobs.main(["ingest", "--wire", f"{wire}/*", "--raw", raw] + state)
    jobs.main(["silver", "--raw", raw, "--neighborhoods", f"{scratch}/dims/nb", "--silver", silver] + state)
    jobs.main(["gold", "--silver", silver, "--customers", f"{scratch}/dims/cust",
               "--employees", f"{scratch}/dims/emp", "--gold", gold] + state)
    jobs.main(["gold", "--silver", silver, "--customers", f"{scratch}/dims/cust",
               "--employees", f"{scratch}/dims/emp", "--gold", gold] + state)  # re-run: no-op
    jobs.main(["reports", "--gold", gold, "--out", f"{scratch}/reports"])
    expect = to_gold(to_silver(tf.feed(spark, SF), tf.neighborhoods(spark, SF)),
                     tf.customers(spark, SF), tf.employees(spark, SF))
    assert _same(spark.read.parquet(gold).select(*GOLD_COLUMNS), expect)
    assert spark.read.parquet(silver).select(*SILVER_SCHEMA.names).schema == SILVER_SCHEMA
    view = register_layer(spark, "gold_view_" + scratch.rsplit("-", 1)[-1], gold)
    assert spark.table(view).count() == expect.count()
    by_nb = spark.read.csv(f"{scratch}/reports/by_neighborhood", header=True, inferSchema=False)
    assert by_nb.count() == expect.where("neighborhood IS NOT NULL").select("neighborhood").distinct().count()


def test_memory_sink_update_mode_reads_lazily(spark, scratch):
    """The stream's in-memory table, read by SQL; update equals append here."""
    from orderlake.streaming import parse_orders
    tf.wire_lines(spark, SF).write.text(f"{scratch}/wire/a")
    name = "orders_mem_" + scratch.rsplit("-", 1)[-1]
    q = (parse_orders(orders_stream(spark, "text", f"{scratch}/wire/*", maxFilesPerTrigger="1"))
         .writeStream.format("memory").queryName(name).outputMode("update").start())
    view = spark.sql(f"SELECT * FROM {name}")  # built before all rows have arrived
    q.processAllAvailable()
    tf.wire_lines(spark, SF).write.text(f"{scratch}/wire/b")
    q.processAllAvailable()
    q.stop()
    assert view.count() == 2 * tf.feed(spark, SF).count()


def test_archive_option_keeps_exactly_once(spark, scratch):
    from orderlake.streaming.incremental import consume_landing
    feed = tf.feed(spark, SF)
    half = F.pmod(F.hash("order_id"), F.lit(2))
    raw = f"{scratch}/raw"
    args = (ORDER_SCHEMA, lambda df: df, f"{scratch}/out", f"{scratch}/_ckpt")
    write_layer(feed.where(half == 0), raw, 1)
    consume_landing(spark, f"{raw}/run-*", *args, archive=f"{scratch}/archive")
    write_layer(feed.where(half == 1), raw, 2)
    consume_landing(spark, f"{raw}/run-*", *args, archive=f"{scratch}/archive")
    consume_landing(spark, f"{raw}/run-*", *args, archive=f"{scratch}/archive")
    assert _same(spark.read.schema(ORDER_SCHEMA).parquet(f"{scratch}/out"), feed)


def test_spatial_silver_stream_equals_batch(spark, scratch):
    feed, nb, polys = tf.feed(spark, SF), tf.neighborhoods(spark, SF), tf.polygons(spark)
    write_layer(feed, f"{scratch}/raw", 1)
    run_silver(spark, f"{scratch}/raw/run-*", nb, f"{scratch}/silver", f"{scratch}/_ckpt",
               polygons=polys, cell=1.0)
    got = spark.read.parquet(f"{scratch}/silver").select(*SILVER_COLUMNS)
    expect = to_silver(feed, nb, polygons=polys, cell=1.0)
    assert _same(got, expect)
    assert expect.where("neighborhood IS NOT NULL").count() > 0


def _cut(spark, path):
    """Take a write job's marker away, as if it had died after its files appeared."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, False)


def test_gated_batch_retry_after_a_cut_commit(spark, scratch):
    from orderlake.streaming import consume_flushes, gated_batch_handler, read_consumed, read_flushed
    from orderlake.schemas import SILVER_SCHEMA
    staging, out, nb = f"{scratch}/staging", f"{scratch}/silver", tf.neighborhoods(spark, SF)
    handle = gated_batch_handler(staging, threshold=50)
    feed = tf.feed(spark, SF).orderBy("order_id").limit(7 * 16).collect()
    batches = [spark.createDataFrame(feed[7 * i:7 * i + 7], ORDER_SCHEMA)
               .selectExpr("to_json(collect_list(struct(*))) AS value") for i in range(16)]
    for i, b in enumerate(batches[:8]):
        handle(b, i)
    silver = lambda df: to_silver(df, nb)
    assert consume_flushes(spark, staging, silver, out) == 1
    for path in (f"{staging}/batch-000000000007", f"{staging}/_ledger/batch-000000000007"):
        _cut(spark, path)
    handle(batches[7], 7)  # the batch that closed the flush comes again
    assert read_flushed(spark, staging).count() == 56
    assert consume_flushes(spark, staging, silver, out) == 1  # nothing new
    for i, b in enumerate(batches[8:], 8):
        handle(b, i)
    # A consumer that dies between its part and the manifest leaves nothing to read, and starts over.
    to_silver(read_flushed(spark, staging, 1, 2), nb).write.parquet(f"{out}/_staging/flush=f0000000002-0000000002-cut")
    assert read_consumed(spark, out, SILVER_SCHEMA).count() == 56
    assert consume_flushes(spark, staging, silver, out) == 2
    got = read_consumed(spark, out, SILVER_SCHEMA)
    assert _same(got, to_silver(spark.createDataFrame(feed, ORDER_SCHEMA), nb))


def test_quarantine_lands_once_under_a_cut_commit(spark, scratch):
    """Files of an attempt that never reached the sink's log are invisible to every reader."""
    from orderlake.streaming import LANDING_SCHEMA, landed_orders, landed_rejects, start_ingest_with_quarantine
    landing, silver = f"{scratch}/landing", f"{scratch}/silver"
    tf.wire_lines(spark, SF).write.text(f"{scratch}/wire/a")
    tf.bad_lines(spark).write.text(f"{scratch}/wire/b")

    def ingest():
        start_ingest_with_quarantine(orders_stream(spark, "text", f"{scratch}/wire/*"), landing, f"{scratch}/_ckpt/in",
                                     trigger={"availableNow": True}).awaitTermination()

    def consume():
        run_silver(spark, landing, tf.neighborhoods(spark, SF), silver, f"{scratch}/_ckpt/silver", landing=True)

    ingest()
    read = lambda: spark.read.schema(LANDING_SCHEMA).parquet(landing)
    assert sorted(r.value for r in landed_rejects(read()).collect()) == ["", "not json at all"]
    orders = landed_orders(read())
    n = tf.feed(spark, SF).count() + 4  # feed + surviving inline records
    assert orders.count() == n
    # A cut attempt: its part files stand in the folder, its batch is not in the log.
    orders.limit(50).write.mode("append").format("parquet").save(f"{scratch}/stray")
    fs = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    for f in spark.read.parquet(f"{scratch}/stray").inputFiles():
        src = fs.Path(f)
        fs.FileUtil.copy(src.getFileSystem(conf), src, src.getFileSystem(conf), fs.Path(f"{landing}/status=order/{src.getName()}"), False, conf)
    consume()
    ingest()  # the retry
    consume()
    assert landed_orders(read()).count() == n
    assert spark.read.parquet(silver).count() == n


def test_silver_file_count_follows_the_data(spark, scratch):
    """Many small input files over many days: about a file a day, not files x days."""
    feed = tf.feed(spark, SF).repartition(16)
    feed.write.parquet(f"{scratch}/raw/run-1")
    assert len(spark.read.parquet(f"{scratch}/raw/run-1").inputFiles()) == 16
    run_silver(spark, f"{scratch}/raw/run-*", tf.neighborhoods(spark, SF), f"{scratch}/silver", f"{scratch}/_ckpt")
    out = spark.read.parquet(f"{scratch}/silver")
    days = out.select("event_year", "event_month", "event_day").distinct().count()
    assert days >= 30 and len(out.inputFiles()) <= 2 * days
    assert out.count() == feed.count()


def test_backlog_is_taken_in_steps(spark, scratch):
    from orderlake.streaming import consume_landing
    for i in range(4):
        write_layer(tf.feed(spark, SF).limit(10).coalesce(1), f"{scratch}/raw", i)
    q = consume_landing(spark, f"{scratch}/raw/run-*", ORDER_SCHEMA, lambda df: df, f"{scratch}/out", f"{scratch}/_ckpt", max_files=1)
    assert q.lastProgress["batchId"] >= 3 and spark.read.parquet(f"{scratch}/out").count() == 40


def test_job_state_is_bound_to_its_paths(spark, scratch):
    import pytest

    from orderlake import jobs
    tf.neighborhoods(spark, SF).write.parquet(f"{scratch}/dims/nb")
    feed = tf.feed(spark, SF)
    write_layer(feed, f"{scratch}/raw-a", 1)
    write_layer(feed.limit(100), f"{scratch}/raw-b", 1)

    def silver(raw, out):
        jobs.main(["silver", "--raw", f"{scratch}/{raw}/run-*", "--neighborhoods", f"{scratch}/dims/nb", "--silver", f"{scratch}/{out}",
                   "--state", f"{scratch}/_state"])

    silver("raw-a", "s1")
    silver("raw-a", "s2")  # a second output of the same input
    silver("raw-b", "s3")  # another input and output
    assert [spark.read.parquet(f"{scratch}/s{i}").count() for i in (1, 2, 3)] == [feed.count(), feed.count(), 100]
    with pytest.raises(ValueError):
        silver("raw-b", "s1")  # the state of s1 knows another input
    for bad in (["ingest", "--wire", "w"], ["silver", "--raw", "r"], ["ingest", "--wire", "w", "--raw", "r", "--quarantine", "--threshold", "5"]):
        with pytest.raises(SystemExit):
            jobs.main(bad)


def test_gated_jobs_and_catalog_views(spark, scratch):
    from orderlake import jobs
    from orderlake.sources import list_tables
    db = "views_" + scratch.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch}/db'")
    tf.wire_lines(spark, SF).write.text(f"{scratch}/wire/a")
    tf.bad_lines(spark).write.text(f"{scratch}/wire/b")
    for name, df in (("nb", tf.neighborhoods(spark, SF)), ("cust", tf.customers(spark, SF)), ("emp", tf.employees(spark, SF))):
        df.write.parquet(f"{scratch}/dims/{name}")
    d, n = f"{scratch}/dims", tf.feed(spark, SF).count() + 4
    ingest = ["ingest", "--wire", f"{scratch}/wire/*"]
    jobs.main(ingest + ["--raw", f"{scratch}/staging", "--threshold", "50"])
    jobs.main(["silver", "--raw", f"{scratch}/staging", "--neighborhoods", f"{d}/nb", "--silver", f"{scratch}/gated-silver", "--gated"])
    jobs.main(["gold", "--silver", f"{scratch}/gated-silver", "--customers", f"{d}/cust", "--employees", f"{d}/emp",
               "--gold", f"{scratch}/gated-gold", "--gated"])
    assert spark.read.parquet(f"{scratch}/gated-gold").count() == n
    jobs.main(ingest + ["--raw", f"{scratch}/landing", "--quarantine", "--catalog", db])
    jobs.main(["silver", "--raw", f"{scratch}/landing", "--landing", "--neighborhoods", f"{d}/nb", "--silver", f"{scratch}/silver", "--catalog", db])
    jobs.main(["gold", "--silver", f"{scratch}/silver", "--customers", f"{d}/cust", "--employees", f"{d}/emp",
               "--gold", f"{scratch}/gold", "--catalog", db])
    assert [spark.table(f"{db}.{t}").count() for t in ("bronze", "silver", "gold")] == [n] * 3
    assert spark.table(f"{db}.gold").columns == GOLD_COLUMNS
    jobs.main(["init", "--db", db, "--dims", f"customers={d}/cust"])  # drops the views, loads the dimension
    assert [r.tableName for r in list_tables(spark, db).collect()] == ["customers"]
    jobs.main(["publish", "--out", f"{scratch}/published", "--dims", f"employees={d}/emp"])
    assert spark.read.parquet(f"{scratch}/published/employees.parquet").count() == tf.employees(spark, SF).count()


def test_planned_ingest_entry_point(spark, scratch):
    from orderlake.streaming import flush_ledger, ingest
    tf.wire_lines(spark, SF).write.text(f"{scratch}/wire/a")
    lines = orders_stream(spark, "text", f"{scratch}/wire/*")
    ingest(lines, f"{scratch}/staging", f"{scratch}/_ckpt/gate", min_rows=51, trigger={"availableNow": True}).awaitTermination()
    assert [r.flush_id for r in flush_ledger(spark, f"{scratch}/staging").collect()] == [1]
    ingest(lines, f"{scratch}/raw", f"{scratch}/_ckpt", trigger={"availableNow": True}).awaitTermination()
    assert _same(spark.read.schema(ORDER_SCHEMA).parquet(f"{scratch}/raw"), tf.feed(spark, SF))


def test_layer_view_over_partitioned_silver(spark, scratch):
    from conftest import plan_text

    from orderlake.sources import register_layer
    feed, nb = tf.feed(spark, SF), tf.neighborhoods(spark, SF)
    write_layer(feed, f"{scratch}/raw", 1)
    run_silver(spark, f"{scratch}/raw/run-*", nb, f"{scratch}/silver", f"{scratch}/_ckpt")
    view = register_layer(spark, "silver_view_" + scratch.rsplit("-", 1)[-1], f"{scratch}/silver")
    one_day = spark.table(view).where("event_year = 2024 AND event_month = 1 AND event_day = 2")
    assert "PartitionFilters" in plan_text(one_day)
    assert one_day.count() == to_silver(feed, nb).where(
        "event_year = 2024 AND event_month = 1 AND event_day = 2").count()
