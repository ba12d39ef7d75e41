import pytest

from orderlake import testfeed as tf
from orderlake.operators import (assign_polygon, cell_index, points_in_polygons, polygon_bounds,
                                 within, within_area)

POINTS = [
    ("in_concave", 1.0, 3.0), ("notch", 3.0, 3.0), ("in_arm", 3.5, 1.0),
    ("edge", 4.0, 1.0), ("vertex", 2.0, 2.0), ("inner_corner_edge", 3.0, 2.0),
    ("in_ring", 5.5, 5.5), ("in_hole", 7.0, 7.0), ("hole_edge", 6.0, 7.0),
    ("overlap", 2.0, 1.0), ("outside", 9.5, 1.0), ("far", -3.0, -3.0),
]
# Closed form: polygon ids that strictly contain each point.
EXPECT = {
    "in_concave": [1], "notch": [], "in_arm": [1], "edge": [], "vertex": [], "inner_corner_edge": [],
    "in_ring": [2], "in_hole": [], "hole_edge": [], "overlap": [1, 3], "outside": [], "far": [],
}


def _points(spark):
    return spark.createDataFrame(POINTS, "order_id string, longitude double, latitude double")


@pytest.mark.parametrize("cell", [0.5, 1.0, 3.0, 50.0, (1.0, 0.25), (4.0, 0.1)])
def test_points_in_polygons_closed_form(spark, cell):
    out = points_in_polygons(_points(spark), tf.polygons(spark), cell).collect()
    got = {}
    for r in out:
        got.setdefault(r.order_id, []).append(r.polygon_id)
    assert {k: sorted(got.get(k, [])) for k in EXPECT} == EXPECT


def test_assign_first_match_and_left(spark):
    out = {r.order_id: r.polygon_id for r in assign_polygon(_points(spark), tf.polygons(spark), 1.0).collect()}
    assert len(out) == len(POINTS)
    assert out["overlap"] == 3 and out["in_ring"] == 2 and out["outside"] is None  # by poly_seq, the layer's order
    out2 = {r.order_id: r.polygon_id for r in
            assign_polygon(_points(spark), tf.polygons(spark), 1.0, priority="polygon_id").collect()}
    assert out2["overlap"] == 1
    out3 = {r.order_id: r.polygon_id for r in assign_polygon(_points(spark), tf.polygons(spark).drop("poly_seq"), 1.0).collect()}
    assert out3["overlap"] == 1


def test_within_area(spark):
    got = {r.order_id for r in within_area(_points(spark), tf.boundary(spark), tf.polygons(spark),
                                           1.0).collect()}
    assert got == {"in_concave", "in_arm", "in_ring", "overlap"}
    assert {r.order_id for r in within(_points(spark), tf.boundary(spark), 2.5).collect()} == {
        p[0] for p in POINTS if p[0] not in ("far", "edge_of_boundary")}


def test_bounds_and_cell_clipping(spark):
    b = {r.polygon_id: tuple(r)[1:] for r in polygon_bounds(tf.polygons(spark)).collect()}
    assert b[1] == (0.0, 0.0, 4.0, 4.0) and b[2] == (5.0, 5.0, 9.0, 9.0)
    idx = cell_index(tf.boundary(spark), 1.0).collect()
    assert len(idx) == 11 * 10  # no cell beyond the edges
    # every cell keeps only the boundary edges that can matter for it, and inner cells none
    assert max(len(r.candidates[0].edges) for r in idx) <= 4
    assert all(r.candidates[0].whole and not r.candidates[0].edges for r in idx if 1 <= r.cx <= 8 and 1 <= r.cy <= 7)


def test_one_huge_polygon_among_small_ones(spark):
    import math

    from pyspark.sql import functions as F
    circle = [(50 + 50 * math.cos(2 * math.pi * i / 1000), 50 + 50 * math.sin(2 * math.pi * i / 1000)) for i in range(1000)]
    rows = [(i, f"s{i}", [[(i * 2.0, 0.0), (i * 2.0 + 1, 0.0), (i * 2.0 + 1, 1.0), (i * 2.0, 1.0)]]) for i in range(1, 51)]
    polys = tf._polygon_frame(spark, rows + [(99, "circle", [circle])])
    idx = cell_index(polys, 1.0).select("level", F.explode("candidates").alias("c")).select("level", "c.id", F.size("c.edges").alias("e"))
    total = idx.agg(F.count(F.lit(1)).alias("rows"), F.sum("e").alias("edges")).first()
    assert total.rows < 1_500 and total.edges < 20_000  # 10,201 cells and a million tests by level 0 alone
    pts = spark.createDataFrame([("in", 50.0, 50.0), ("both", 4.5, 50.0), ("small", 20.5, 0.5), ("out", 0.5, 0.5)],
                                "order_id string, longitude double, latitude double")
    got = {(r.order_id, r.polygon_id) for r in points_in_polygons(pts, polys, 1.0).collect()}
    assert got == {("in", 99), ("both", 99), ("small", 10)}


def test_empty_rings_are_ignored(spark):
    polys = spark.sql("""SELECT * FROM VALUES
        (1, array(array(named_struct('x', 0D, 'y', 0D), named_struct('x', 4D, 'y', 0D), named_struct('x', 4D, 'y', 4D),
                        named_struct('x', 0D, 'y', 4D)), cast(array() AS array<struct<x:double,y:double>>))),
        (2, array(cast(array() AS array<struct<x:double,y:double>>))),
        (3, cast(array() AS array<array<struct<x:double,y:double>>>)), (4, NULL) AS t(polygon_id, rings)""")
    got = {(r.order_id, r.polygon_id) for r in points_in_polygons(_points(spark), polys, 1.0).collect()}
    assert {p for _, p in got} == {1} and ("in_concave", 1) in got
    nothing = assign_polygon(_points(spark), polys.where("polygon_id > 1"), 1.0).collect()
    assert len(nothing) == len(POINTS) and all(r.polygon_id is None for r in nothing)


def test_spatial_join_never_cross(spark):
    from conftest import plan_text
    plan = plan_text(points_in_polygons(_points(spark), tf.polygons(spark), 1.0))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("cell", [0.3, 1.0, 7.0, (2.0, 0.2)])
def test_random_rectangles_against_closed_form(spark, cell):
    import random
    rnd = random.Random(11)
    rects = []
    for pid in range(1, 16):
        x1, y1 = rnd.randint(0, 16) / 2, rnd.randint(0, 16) / 2
        rects.append((pid, x1, y1, x1 + rnd.randint(1, 8) / 2, y1 + rnd.randint(1, 8) / 2))
    polys = tf._polygon_frame(spark, [(pid, f"r{pid}", [[(a, b), (c, b), (c, d), (a, d)]])
                                      for pid, a, b, c, d in rects])
    pts = [(f"p{i}_{j}", i / 4, j / 4) for i in range(-2, 54, 3) for j in range(-2, 54, 3)]
    points = spark.createDataFrame(pts, "order_id string, longitude double, latitude double")
    got = sorted((r.order_id, r.polygon_id) for r in points_in_polygons(points, polys, cell).collect())
    expect = sorted((o, pid) for o, x, y in pts for pid, a, b, c, d in rects if a < x < c and b < y < d)
    assert got == expect
    first = {r.order_id: r.polygon_id for r in assign_polygon(points, polys, cell, priority="polygon_id").collect()}
    assert first == {o: min((pid for pid, a, b, c, d in rects if a < x < c and b < y < d), default=None)
                     for o, x, y in pts}


def test_suggest_cell(spark):
    from orderlake.operators import suggest_cell
    w, h = suggest_cell(tf.polygons(spark), edges_per_cell=2)
    assert w == 4.0 and 0 < h <= 4.0
    got = {r.order_id for r in within(_points(spark), tf.polygons(spark), (w, h)).collect()}
    assert got == {k for k, v in EXPECT.items() if v}


def test_unbounded_index_falls_back_to_shuffle_join(spark):
    from conftest import plan_text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fallback = points_in_polygons(_points(spark), tf.polygons(spark), 1.0, max_broadcast_rows=0)
        plan = plan_text(fallback)
        assert "BroadcastHashJoin" not in plan and ("SortMergeJoin" in plan or "ShuffledHashJoin" in plan)
        got = sorted((r.order_id, r.polygon_id) for r in fallback.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    expect = sorted((k, pid) for k, ids in EXPECT.items() for pid in ids)
    assert got == expect


def test_point_columns_named_like_internals_survive(spark):
    pts = _points(spark).selectExpr("*", "'keep' AS cx", "'keep' AS candidates")
    out = points_in_polygons(pts, tf.polygons(spark), 1.0)
    assert {"cx", "candidates"} <= set(out.columns)
    assert {r.cx for r in out.collect()} == {"keep"}


def _even_odd(rings, x, y):
    """Plain even-odd containment; None on an edge."""
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2) and (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1):
                return None
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def _star(rnd, n, cx, cy, least, most):
    import math
    return [(cx + r * math.cos(2 * math.pi * i / n), cy + r * math.sin(2 * math.pi * i / n))
            for i in range(n) for r in [rnd.uniform(least, most)]]


def _shapes(seed):
    """Stars (one with a star-shaped hole), a comb of long teeth, a spiral-like ring on grid lines, a ring that crosses itself."""
    import random
    rnd = random.Random(seed)
    comb = [p for i in range(40) for p in ((i * 0.25, 0.0), (i * 0.25 + 0.125, 7.3 + rnd.random()))] + [(10.0, -1.0), (0.0, -1.0)]
    steps = [(0, 0), (6, 0), (6, 6), (1, 6), (1, 2), (4, 2), (4, 4), (3, 4), (3, 3), (2, 3), (2, 5), (5, 5), (5, 1), (0, 1)]
    wild = [(rnd.uniform(0, 9), rnd.uniform(0, 9)) for _ in range(25)]
    return [(1, "star", [_star(rnd, 300, 3, 3, 0.5, 3), _star(rnd, 50, 3, 3, 0.1, 0.4)]), (2, "comb", [comb]),
            (3, "steps", [[(float(x), float(y)) for x, y in steps]]), (4, "wild", [wild]),
            (5, "slanted", [[(-2.0, 1.0), (5.0, 8.5), (9.1, -3.7)]]), (6, "tall", [[(4.5, -9.0), (4.5000001, 9.0), (4.6, 0.0)]])]


@pytest.mark.parametrize(("seed", "cell"), [(1, 0.1), (2, 0.37), (3, 1.0), (4, (2.5, 0.2)), (5, (0.2, 2.5)), (6, 40.0)])
def test_cells_keep_the_reference_parity(spark, seed, cell):
    """Any shape, any cell: the same as the plain rule, grid points and points near vertices included."""
    import random
    shapes, rnd = _shapes(seed), random.Random(seed + 100)
    spots = [(i / 4, j / 4) for i in range(-12, 42, 2) for j in range(-12, 42, 3)] + [(rnd.uniform(-3, 10), rnd.uniform(-4, 9)) for _ in range(1500)]
    spots += [(x, y) for _, _, rings in shapes for ring in rings for x, y in ring] + [(x + 1e-7, y) for _, _, rings in shapes for x, y in rings[0]]
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(spots)], "order_id long, longitude double, latitude double")
    got = {(r.order_id, r.polygon_id) for r in points_in_polygons(points, tf._polygon_frame(spark, shapes), cell).collect()}
    assert got == {(i, pid) for i, (x, y) in enumerate(spots) for pid, _, rings in shapes if _even_odd(rings, x, y)}


@pytest.mark.parametrize("shape", ["star", "comb"])
def test_index_entries_are_linear_in_vertices(spark, shape):
    import random

    from pyspark.sql import functions as F
    per_vertex = []
    for n in (1_000, 10_000):
        ring = _star(random.Random(n), n, 50, 50, 49, 50) if shape == "star" else [
            (i * 100 / n, 100.0 * (i % 2)) for i in range(n)] + [(100.0, -1.0), (0.0, -1.0)]
        polys = spark.createDataFrame([(1, [ring])], "polygon_id int, rings array<array<struct<x:double,y:double>>>")
        cells = cell_index(polys, 1.0).select(F.explode("candidates").alias("c")).agg(
            F.count(F.lit(1)).alias("cells"), F.sum(F.size("c.edges")).alias("edges")).first()
        per_vertex.append((cells.cells + cells.edges) / n)
    assert max(per_vertex) < 12 and per_vertex[1] < 1.5 * per_vertex[0] + 1


def _hot_points(spark, n, one_spot):
    from pyspark.sql import functions as F
    hot = F.when(F.col("id") % 3 == 0, F.lit(0.5) if one_spot else 0.1 + 0.8 * F.rand(1)).otherwise(-2 + 12 * F.rand(2))
    other = F.when(F.col("id") % 3 == 0, F.lit(0.5) if one_spot else 0.1 + 0.8 * F.rand(3)).otherwise(-3 + 12 * F.rand(4))
    return spark.range(n).select(F.col("id").alias("order_id"), hot.alias("longitude"), other.alias("latitude"))


@pytest.mark.parametrize("one_spot", [False, True])
def test_hot_cell_is_split_without_broadcast(spark, scratch, one_spot):
    """A third of all points in one cell: no key and no task of the join gets more than the bound allows."""
    from pyspark.sql import functions as F

    from orderlake.operators import spatial
    n, bound, shapes = 30_000, 400, _shapes(9)
    _hot_points(spark, n, one_spot).write.parquet(scratch)
    points, polys = spark.read.parquet(scratch), tf._polygon_frame(spark, shapes)
    expect = {tuple(r) for r in points_in_polygons(points, polys, 1.0).select("order_id", "polygon_id").collect()}
    brute = {(r.order_id, pid) for r in points.limit(2_000).collect() for pid, _, rings in shapes if _even_odd(rings, r.longitude, r.latitude)}
    some = {r.order_id for r in points.limit(2_000).collect()}
    assert {e for e in expect if e[0] in some} == brute
    placed = points.withColumns({"_ol_ux": F.col("longitude"), "_ol_uy": F.col("latitude"), "_ol_cx": F.floor("longitude"), "_ol_cy": F.floor("latitude")})
    hot = spatial.hot_cells(placed, bound).collect()
    assert any(len(r.leaves) + sum(r.leaves.values()) > n / 3 / bound for r in hot)
    seen = []
    was = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    for k, v in zip(was, ("-1", "false", "64")):
        spark.conf.set(k, v)
    try:
        joined = spatial.points_in_polygons(points, polys, 1.0, max_broadcast_rows=0, max_cell_points=bound)
        dealt = spatial._with_candidates(points, cell_index(polys, 1.0), 1.0, "longitude", "latitude", 0, bound)
        seen = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert {tuple(r) for r in joined.select("order_id", "polygon_id").collect()} == expect
        assert joined.columns == [*points.columns, "polygon_id"]
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert sum(seen) == n and max(seen) < n / 6  # one key alone had a third before


def test_null_coordinates_and_hot_cells(spark):
    pts = spark.createDataFrame([(i, None if i % 2 else 1.0, 3.0) for i in range(50)], "order_id long, longitude double, latitude double")
    out = assign_polygon(pts, tf.polygons(spark), 1.0, max_broadcast_rows=0, max_cell_points=4).collect()
    assert len(out) == 50 and all(r.polygon_id == (None if r.order_id % 2 else 1) for r in out)
