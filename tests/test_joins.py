from orderlake.operators import add_customer, add_employee, add_neighborhood, bounded, lookup_by_coordinate
from orderlake.plans import to_gold, to_silver


def _orders(spark, rows):
    return spark.createDataFrame(rows, "object_id int, latitude double, longitude double, date string, "
                                       "customer_id int, employee_id int, quantity_products int, order_id string")


def test_neighborhood_left_join_nulls_and_duplicates(spark):
    orders = _orders(spark, [(1, 0.0, 0.0, None, 1, 1, 5, "a"), (None, 0.0, 0.0, None, 1, 1, 5, "b"),
                             (7, 0.0, 0.0, None, 1, 1, 5, "c")])
    nb = spark.createDataFrame([(1, "x", "c1"), (1, "y", "c1"), (None, "n", "cn")],
                               "OBJECTID int, NOMBRE string, IDENTIFICACION string")
    out = sorted(((r.order_id, r.neighborhood) for r in add_neighborhood(orders, nb).collect()),
                 key=lambda t: (t[0], t[1] or ""))
    # duplicate key multiplies, null key never matches, unknown key keeps the order
    assert out == [("a", "x"), ("a", "y"), ("b", None), ("c", None)]
    assert "object_id" not in add_neighborhood(orders, nb).columns


def test_gold_shape_and_unmatched(spark):
    orders = _orders(spark, [(1, 1.0, 2.0, "01/01/2024 00:00:01", 10, 20, 3, "o1"),
                             (2, 1.0, 2.0, "01/01/2024 00:00:02", 11, 21, None, "o2")])
    nb = spark.createDataFrame([(1, "n1", "c1")], "OBJECTID int, NOMBRE string, IDENTIFICACION string")
    cust = spark.createDataFrame([(10, "ann", "p", "e", "a")], "customer_id int, name string, phone string, "
                                                              "email string, address string")
    emp = spark.createDataFrame([(20, "bob", "p", "e", "a", 0.5)], "employee_id int, name string, "
                                                                  "phone string, email string, address string, "
                                                                  "comission double")
    gold = to_gold(to_silver(orders, nb), cust, emp)
    assert gold.columns == ["order_id", "customer_name", "employee_name", "employee_commission",
                            "latitude", "longitude", "commune", "neighborhood", "quantity_products",
                            "event_date"]
    rows = {r.order_id: r for r in gold.collect()}
    assert rows["o1"].customer_name == "ann" and rows["o1"].employee_commission == 0.5
    assert rows["o2"].customer_name is None and rows["o2"].neighborhood is None


def test_enrich_prefixes(spark):
    orders = _orders(spark, [(1, 1.0, 2.0, None, 10, 20, 3, "o1")])
    cust = spark.createDataFrame([(10, "ann", "p", "e", "a")], "customer_id int, name string, phone string, "
                                                              "email string, address string")
    cols = add_customer(orders, cust).columns
    assert {"customer_name", "customer_phone", "customer_email", "customer_address"} <= set(cols)
    emp = spark.createDataFrame([(20, "bob", "p", "e", "a", 0.5)], "employee_id int, name string, "
                                                                  "phone string, email string, address string, "
                                                                  "comission double")
    assert "employee_commission" in add_employee(orders, emp).columns


def test_bounded_check(spark):
    assert bounded(spark.range(10), 10)
    assert not bounded(spark.range(11), 10)


def test_coordinate_lookup(spark):
    orders = _orders(spark, [(1, 1.0, 2.0, None, 1, 1, 1, "a"), (1, 1.0, 3.0, None, 1, 1, 1, "b")])
    places = spark.createDataFrame([(1.0, 2.0, "p")], "latitude double, longitude double, place string")
    out = {r.order_id: r.place for r in lookup_by_coordinate(orders, places).collect()}
    assert out == {"a": "p", "b": None}


def test_bounded_by_bytes(spark):
    from pyspark.sql import functions as F

    from orderlake.operators.joins import row_bytes
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("s"))
    assert bounded(df, 1000, 10_000_000)
    assert not bounded(df, 1000, 50_000)  # ~100 kB of text
    assert df.select(row_bytes(df).alias("b")).first().b >= 1000


def test_unbounded_dimension_is_not_hinted(spark):
    from conftest import plan_text
    from pyspark.sql import functions as F

    from orderlake.operators.joins import broadcast_if_bounded
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(50).select(F.col("id").cast("int").alias("k"))
        plan = plan_text(spark.range(10).select(F.col("id").cast("int").alias("k"))
                         .join(broadcast_if_bounded(big, 10), "k", "left"))
        assert "BroadcastHashJoin" not in plan
        plan = plan_text(spark.range(10).select(F.col("id").cast("int").alias("k"))
                         .join(broadcast_if_bounded(big, 100), "k", "left"))
        assert "BroadcastHashJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
