from pyspark.sql import functions as F

from orderlake.operators import (at_coordinate, drop_key, pick, rename, sample_dim,
                                 with_constant)


def test_pick_and_drop_by_reference(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "object_id int, order_id string")
    right = spark.createDataFrame([(1, "n1", "c1")], "object_id int, NOMBRE string, IDENTIFICACION string")
    joined = left.join(right, left["object_id"] == right["object_id"], "left")
    out = drop_key(pick(joined, left, {"NOMBRE": "neighborhood"}, right), left["object_id"])
    assert out.columns == ["order_id", "neighborhood"]
    assert sorted(tuple(r) for r in out.collect()) == [("a", "n1"), ("b", None)]


def test_flatten_rename_literal_filter_sample(spark):
    df = spark.range(3).select(F.struct(F.col("id").alias("a"), (F.col("id") * 2).alias("b")).alias("d"))
    flat = df.select("d.*")
    assert flat.columns == ["a", "b"]
    assert rename(flat, {"a": "x", "missing": "y"}).columns == ["x", "b"]
    assert with_constant(flat, "src", "feed").select("src").distinct().first().src == "feed"
    pts = spark.createDataFrame([(0.91, 0.37), (0.91, 0.38)], "latitude double, longitude double")
    assert at_coordinate(pts, 0.91, 0.37).count() == 1
    assert [r.a for r in sample_dim(flat, ["a"], ["a DESC"], 2).collect()] == [2, 1]


def test_unions_positional_and_by_name(spark):
    from orderlake.operators import append_orders, union_versions
    a = spark.createDataFrame([(1, "x")], "object_id int, order_id string")
    b = spark.createDataFrame([(2, "y")], "other int, name string")  # positional: names ignored
    assert [tuple(r) for r in append_orders(a, b, a).collect()] == [(1, "x"), (2, "y"), (1, "x")]
    old = spark.createDataFrame([("z",)], "order_id string")           # 7-field ancestor shape
    out = {r.order_id: r.object_id for r in union_versions(a, old).collect()}
    assert out == {"x": 1, "z": None}


def test_neighborhood_dim_aliases(spark):
    from orderlake.operators import neighborhood_dim
    nb = spark.createDataFrame([(1, "n", "c", "x")], "OBJECTID int, NOMBRE string, IDENTIFICACION string, CODIGO string")
    out = neighborhood_dim(nb)
    assert out.columns == ["object_id", "neighborhood", "commune"] and tuple(out.first()) == (1, "n", "c")
