import pytest
from pyspark.errors import AnalysisException

from orderlake import testfeed as tf
from orderlake.schemas import ORDER_SCHEMA
from orderlake.sinks import append_table, export_csv, replace_table, write_layer
from orderlake.sources import init_catalog, list_tables, read_landing, scan_table

SF = "/root/testdata/sf0.001"


def test_landing_without_files_is_empty(spark, scratch):
    import pytest
    from pyspark.errors import AnalysisException
    spark.range(1).write.parquet(f"{scratch}/there/other")
    df = read_landing(spark, f"{scratch}/there/run-*/*.parquet", ORDER_SCHEMA)
    assert df.count() == 0 and df.schema == ORDER_SCHEMA
    with pytest.raises(AnalysisException):  # a mistyped folder is no landing without files
        read_landing(spark, f"{scratch}/their/run-*", ORDER_SCHEMA)


def test_catalog_reset_after_registration(spark, scratch):
    from orderlake.sources import init_catalog, list_databases, register_layer, scan_table
    db = "reset_" + scratch.rsplit("-", 1)[-1]
    dims = {"customers": spark.range(3).withColumnRenamed("id", "customer_id")}
    init_catalog(spark, db, dims, location=f"{scratch}/db")
    spark.range(5).write.parquet(f"{scratch}/gold")
    register_layer(spark, f"{db}.gold", f"{scratch}/gold")
    init_catalog(spark, db, dims)  # drops the view, too
    assert not spark.catalog.tableExists(f"{db}.gold") and scan_table(spark, f"{db}.customers").count() == 3
    spark.range(1).write.saveAsTable(f"{db}.gold")
    register_layer(spark, f"{db}.gold", f"{scratch}/gold")  # a view takes the table's place
    assert scan_table(spark, f"{db}.gold").count() == 5
    assert db in [r[0] for r in list_databases(spark).collect()]


def test_run_dirs_are_not_partition_columns(spark, scratch):
    feed = tf.feed(spark, SF)
    write_layer(feed, scratch, 1)
    write_layer(feed, scratch, 1)  # retry of the same run replaces it
    write_layer(feed, scratch, 2)
    df = spark.read.parquet(f"{scratch}/run-*")
    assert df.columns == feed.columns and df.count() == 2 * feed.count()


def test_csv_null_is_empty_field(spark, scratch):
    df = spark.createDataFrame([("a", None)], "k string, v string")
    export_csv(df, scratch)
    text = "".join(r.value for r in spark.read.text(scratch).collect())
    assert "k,v" in text and "a," in text
    back = spark.read.schema(df.schema).csv(scratch, header=True).first()
    assert back.v is None


def test_tables_and_catalog(spark, scratch):
    db = "ol_test_" + scratch.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch}/db'")
    feed = tf.feed(spark, SF)
    append_table(feed, f"{db}.bronze")
    append_table(feed.select(*reversed(feed.columns)), f"{db}.bronze")  # matched by name
    assert scan_table(spark, f"{db}.bronze").count() == 2 * feed.count()
    with pytest.raises(AnalysisException):
        append_table(feed.drop("order_id"), f"{db}.bronze")
    replace_table(feed, f"{db}.bronze")
    assert scan_table(spark, f"{db}.bronze").count() == feed.count()
    dims = {"customers": tf.customers(spark, SF), "neighborhoods": tf.neighborhoods(spark, SF)}
    init_catalog(spark, db, dims)
    init_catalog(spark, db, dims)
    assert sorted(r.tableName for r in list_tables(spark, db).collect()) == ["customers", "neighborhoods"]
    assert scan_table(spark, f"{db}.customers").count() == dims["customers"].count()


def test_overwrite_of_a_table_read_by_the_plan_fails(spark, scratch):
    db = "ol_self_" + scratch.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch}/db'")
    feed = tf.feed(spark, SF)
    replace_table(feed, f"{db}.silver")
    with pytest.raises(AnalysisException):
        replace_table(scan_table(spark, f"{db}.silver").where("quantity_products > 0"), f"{db}.silver")
    assert scan_table(spark, f"{db}.silver").count() == feed.count()  # left intact


def test_append_layer_and_publish_dims(spark, scratch):
    from orderlake.sinks import append_layer, publish_dims
    feed = tf.feed(spark, SF)
    append_layer(feed, f"{scratch}/raw")
    append_layer(feed, f"{scratch}/raw")
    assert spark.read.parquet(f"{scratch}/raw").count() == 2 * feed.count()
    out = publish_dims(spark, [f"{SF}/nation.parquet", f"{SF}/region.parquet/"], f"{scratch}/dims")
    assert sorted(out) == ["nation", "region"]
    publish_dims(spark, {"nation": f"{SF}/nation.parquet"}, f"{scratch}/dims")  # overwrite, not append
    assert spark.read.parquet(out["nation"]).count() == 25


def test_parquet_and_json_scans(spark, scratch):
    from orderlake.sources import read_bronze_json, read_parquet
    assert read_parquet(spark, f"{SF}/nation.parquet").count() == 25
    spark.range(1).selectExpr("'{\"object_id\": \"7\", \"order_id\": \"a\", \"x\": 1}' AS value") \
        .write.text(f"{scratch}/json")
    row = read_bronze_json(spark, f"{scratch}/json", ORDER_SCHEMA).first()
    assert read_bronze_json(spark, f"{scratch}/json", ORDER_SCHEMA).schema == ORDER_SCHEMA  # no inference
    assert row.order_id == "a" and row.latitude is None
