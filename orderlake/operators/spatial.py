"""Point-in-polygon joins (J6–J8) and polygon bounds (A4).

A containment predicate on its own plans as a nested-loop (cross) join. Here it
becomes an equi-join instead:

1. each polygon gets a grid level: cells of ``cell`` (a side, or a ``(width, height)`` pair), four times as
   wide and high a level, so that its bounding box has at most about ``CELLS`` cells (or as many as it
   has vertices) and its edges enter at most twice as many. One huge polygon among small ones costs no more than they do;
2. every edge is followed through the grid and listed in the cells that it touches, and in no others. A cell also
   keeps a *reference parity*: whether an odd number of the polygon's other edges crosses the vertical
   line through the cell's middle above it. It comes from one running sum down each column of the polygon, which also
   finds the cells that no edge touches and that lie inside (kept without edges). Entries are linear in the vertices;
3. cells make one *cell index* row ``(level, cx, cy, candidates)`` with the list of (priority, polygon id, whole,
   odd, ref, edges) in order. The index is written once to the shared folder; its size is measured there;
4. each point looks up its cell once a level: a broadcast hash join if the stored index is small, a shuffle join on the
   cell beyond that. The index has one row per cell, so the join never multiplies points. Before a shuffle join the points of a
   cell are counted: a cell above the bound is split into quadrants, as deep as its points need, and each quadrant gets
   the edges that touch it and a reference parity of its own; points that no split can part are dealt over copies;
5. containment is the even-odd rule on a path that stays in the cell until the line through its middle, with native
   higher-order functions over the candidates' edges (:mod:`orderlake.functions.geometry`).

Points on an edge or vertex are not contained. Polygons without a vertex contain nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import inside_from, moved_reference, path_parity, ring_edges
from ..session import scratch_path
from .joins import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, bounded, broadcast_if_bounded

# Cells of a polygon's bounding box at its grid level, and how much wider a cell is a level up.
CELLS, STEP = 256, 4
# Slack, in cells, on the height at which an edge leaves a column: rounding never drops an edge.
_EPS = 1e-9
# Points of a cell above which a shuffle join splits it (at least this share of all points), and how often at most.
HOT_POINTS, HOT_SHARE, HOT_DEPTH = 1 << 20, 1 / 4096, 6
# Name of the joined candidate list on the point side (kept clear of user columns).
_CANDIDATES = "_ol_candidates"


def polygon_bounds(polys: DataFrame, id_col: str = "polygon_id", rings: str = "rings") -> DataFrame:
    """A4: min/max of each polygon's vertices, row by row (no shuffle)."""
    verts = F.flatten(F.col(rings))
    return polys.select(
        F.col(id_col),
        F.array_min(F.transform(verts, lambda v: v["x"].cast("double"))).alias("min_x"),
        F.array_min(F.transform(verts, lambda v: v["y"].cast("double"))).alias("min_y"),
        F.array_max(F.transform(verts, lambda v: v["x"].cast("double"))).alias("max_x"),
        F.array_max(F.transform(verts, lambda v: v["y"].cast("double"))).alias("max_y"))


def _cell_size(cell) -> tuple[float, float]:
    wx, wy = (cell, cell) if isinstance(cell, (int, float)) else cell
    if wx <= 0 or wy <= 0:
        raise ValueError("cell sizes must be positive")
    return float(wx), float(wy)


def suggest_cell(polys: DataFrame, rings: str = "rings",
                 edges_per_cell: int = 16) -> tuple[float, float]:
    """A ``(width, height)`` cell for a polygon layer, from one small aggregate.

    Width is the median polygon width, so a point meets only a few candidates;
    height cuts the median polygon into strips of about ``edges_per_cell``
    edges each, so every candidate carries few edges into the join.
    """
    verts = F.flatten(F.col(rings))
    xs = F.transform(verts, lambda v: v["x"].cast("double"))
    ys = F.transform(verts, lambda v: v["y"].cast("double"))
    stats = polys.select((F.array_max(xs) - F.array_min(xs)).alias("w"),
                         (F.array_max(ys) - F.array_min(ys)).alias("h"),
                         F.size(verts).alias("v"))
    w, h, v = stats.agg(F.percentile_approx("w", 0.5), F.percentile_approx("h", 0.5),
                        F.percentile_approx("v", 0.5)).first()
    if not w or not h:
        return (1.0, 1.0)
    strips = max(1, int(v or 0) // max(1, edges_per_cell))
    return (float(w), float(h) / strips)


def _priority(polys: DataFrame, id_col: str, priority: str | None) -> str:
    return priority or ("poly_seq" if "poly_seq" in polys.columns else id_col)


def cell_index(polys: DataFrame, cell, id_col: str = "polygon_id",
               rings: str = "rings", priority: str | None = None) -> DataFrame:
    """Grid-cell index of a polygon layer: ``level, cx, cy, candidates``.

    ``cell`` is a side length or a ``(width, height)`` pair, the cell of level 0. Thin cells (height
    well below width) keep few edges per cell for polygons with many vertices.
    ``priority`` orders the candidates of a cell (first match wins in :func:`assign_polygon`); it
    defaults to ``poly_seq``, the polygons' own sequence, where there is such a column, else to the id.
    """
    wx, wy = _cell_size(cell)
    verts = F.flatten(F.filter(F.col(rings), lambda ring: F.size(ring) > 0))
    xs = F.transform(verts, lambda v: v["x"].cast("double"))
    ys = F.transform(verts, lambda v: v["y"].cast("double"))
    way = F.aggregate("edges", F.lit(0.0), lambda acc, e: acc + F.abs(e["x2"] - e["x1"]) / wx + F.abs(e["y2"] - e["y1"]) / wy)
    shaped = polys.select(
        F.monotonically_increasing_id().alias("uid"), F.col(_priority(polys, id_col, priority)).alias("prio"),
        F.col(id_col).alias("id"), ring_edges(rings).alias("edges"), (F.array_max(xs) - F.array_min(xs)).alias("width"),
        (F.array_max(ys) - F.array_min(ys)).alias("height"), F.size(verts).alias("n")).where("n > 0")
    room = F.greatest(F.lit(CELLS), F.col("n"))
    area, reach = (F.col("width") / wx + 1) * (F.col("height") / wy + 1), way / 2
    up = F.greatest(F.lit(0.0), F.log(area / room) / 2, F.log(F.greatest(reach, F.lit(1.0)) / room)) / math.log(STEP)
    shaped = shaped.withColumn("level", F.ceil(up).cast("int")).withColumns({
        "w": F.lit(wx) * F.pow(F.lit(float(STEP)), "level"), "h": F.lit(wy) * F.pow(F.lit(float(STEP)), "level")})
    keep = ["uid", "prio", "id", "level", "w", "h"]
    return (_column_cells(_touched_cells(shaped.select(*keep, F.explode("edges").alias("e"))), keep)
            .groupBy("level", "cx", "cy")
            .agg(F.array_sort(F.collect_list(F.struct("prio", "id", "whole", "odd", "ref", "edges"))).alias("candidates")))


def _touched_cells(edges: DataFrame) -> DataFrame:
    """A row for every cell that an edge touches: cx, cy, and the row ``at`` in which the edge crosses the column's
    middle line (null if it does not)."""
    e, w, h = F.col("e"), F.col("w"), F.col("h")
    low_x, high_x = F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])
    low_y, high_y = F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])
    placed = edges.withColumn("cx", F.explode(F.sequence(F.floor(low_x / w), F.floor(high_x / w))))
    cx = F.col("cx")
    height = lambda x: e["y1"] + (x - e["x1"]) / (e["x2"] - e["x1"]) * (e["y2"] - e["y1"])
    held = lambda y: F.least(high_y, F.greatest(low_y, y))
    middle = (cx + 0.5) * w
    at = F.when((e["x1"] > middle) != (e["x2"] > middle), held(height(middle)))
    # An edge that stays in the column, or is all but vertical, takes all its rows there; others those between the borders.
    steep = (F.floor(low_x / w) == F.floor(high_x / w)) | (high_x - low_x < 1e-9 * w)
    a = F.when(~steep, height(F.greatest(low_x, cx * w)))
    b = F.when(~steep, height(F.least(high_x, (cx + 1) * w)))
    slack = F.when(~steep, _EPS * h + 1e-15 * (F.abs(cx * w) + w + F.abs(low_x) + F.abs(high_x)) * (high_y - low_y) / (high_x - low_x))
    low = F.when(steep, low_y).otherwise(F.least(held(F.least(a, b) - slack), at))
    high = F.when(steep, high_y).otherwise(F.greatest(held(F.greatest(a, b) + slack), at))
    return (placed.withColumns({"at": F.floor(at / h), "low": F.floor(low / h), "high": F.floor(high / h)})
            .withColumn("cy", F.explode(F.sequence("low", "high"))).drop("low", "high"))


def _column_cells(touched: DataFrame, keep: list[str]) -> DataFrame:
    """The cells of each polygon with their edges and reference parity, and the untouched cells inside it.

    One exchange by polygon and column serves the grouping by cell and the running sum down the column.
    """
    cells = (touched.repartition("uid", "cx").groupBy(*keep, "cx", "cy")
             .agg(F.collect_list("e").alias("edges"), F.count_if(F.col("at") == F.col("cy")).alias("n_here"),
                  F.count_if(F.col("at") > F.col("cy")).alias("n_over")))
    down = Window.partitionBy("uid", "cx").orderBy(F.desc("cy"))
    cells = cells.withColumns({
        "above": F.coalesce(F.sum("n_here").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "below": F.lead("cy").over(down)})
    odd = (F.col("above") - F.col("n_over")) % 2 == 1  # its own edges are tested point by point
    own = F.struct("cy", odd.alias("odd"), "edges")
    gap = F.when((F.col("cy") - F.col("below") > 1) & ((F.col("above") + F.col("n_here")) % 2 == 1),
                 F.sequence(F.col("below") + 1, F.col("cy") - 1)).otherwise(F.array().cast("array<bigint>"))
    free = F.transform(gap, lambda y: F.struct(y.alias("cy"), F.lit(True).alias("odd"), F.slice("edges", 1, 0).alias("edges")))
    every = cells.select(*keep, "cx", F.inline(F.concat(F.array(own), free)))
    return every.withColumns({"whole": F.size("edges") == 0, "ref": (F.col("cx") + 0.5) * F.col("w")})


def _code(depth, qx, qy) -> Column:
    """A quadrant as one number: how often the cell was halved, and its place."""
    n = lambda c: (c if isinstance(c, Column) else F.lit(c)).cast("bigint")
    return n(depth) * (1 << 40) + n(qx) * (1 << 20) + n(qy)


def _quadrant(value: Column, cell: Column, depth) -> Column:
    """Which of 2**depth parts of the cell holds a coordinate, given in cells."""
    n = F.pow(F.lit(2.0), depth if isinstance(depth, Column) else F.lit(depth))
    return F.least(n - 1, F.greatest(F.lit(0.0), F.floor((value - cell) * n).cast("double"))).cast("bigint")


def hot_cells(points: DataFrame, bound: int) -> DataFrame:
    """``_ol_cx, _ol_cy, leaves`` of the cells with more than ``bound`` points: a map from quadrant to its shares.

    ``points`` has its cell in ``_ol_cx, _ol_cy`` and its place in cells in ``_ol_ux, _ol_uy``. Points are counted by cell, and those of
    full cells by the smallest quadrants; sums of these give every larger quadrant's count. A leaf is the largest
    quadrant with at most ``bound`` points; one that can't be halved any more has a share for every ``bound`` points.
    """
    cell = ["_ol_cx", "_ol_cy"]
    full = points.where(F.col("_ol_cx").isNotNull() & F.col("_ol_cy").isNotNull()).groupBy(*cell).count().where(F.col("count") > bound)
    inner = points.join(broadcast_if_bounded(full.select(*cell)), cell, "left_semi")
    finest = inner.groupBy(*cell, _quadrant(F.col("_ol_ux"), F.col("_ol_cx"), HOT_DEPTH).alias("fx"),
                           _quadrant(F.col("_ol_uy"), F.col("_ol_cy"), HOT_DEPTH).alias("fy")).count()
    up = F.expr(f"explode(sequence(0, {HOT_DEPTH}))").alias("depth")
    part = lambda c: F.expr(f"shiftright({c}, {HOT_DEPTH} - depth)").alias(f"q{c[1]}")
    nodes = (finest.select(*cell, "fx", "fy", "count", up).select(*cell, "depth", part("fx"), part("fy"), "count")
             .groupBy(*cell, "depth", "qx", "qy").agg(F.sum("count").alias("n")))
    split = (F.col("n") > bound) & (F.col("depth") < HOT_DEPTH)
    parents = nodes.where(split).select(*cell, (F.col("depth") + 1).alias("depth"), F.col("qx").alias("px"), F.col("qy").alias("py"))
    leaves = (nodes.where(~split).withColumns({"px": F.shiftright("qx", 1), "py": F.shiftright("qy", 1)})
              .join(parents, [*cell, "depth", "px", "py"], "left_semi"))
    one = F.struct(_code(F.col("depth"), F.col("qx"), F.col("qy")).alias("code"), F.ceil(F.col("n") / bound).cast("int").alias("shares"))
    return leaves.groupBy(*cell).agg(F.map_from_entries(F.collect_list(one)).alias("leaves"))


def _quartered(index: DataFrame, w: float, h: float) -> DataFrame:
    """Index rows of hot cells, a row a leaf and share: the edges that touch the leaf, the parity at its middle."""
    rows = index.select("cx", "cy", "candidates", F.explode("leaves").alias("code", "shares"))
    rows = rows.withColumns({"d": F.shiftright("code", 40), "qx": F.shiftright("code", 20).bitwiseAND(F.lit((1 << 20) - 1)),
                             "qy": F.col("code").bitwiseAND(F.lit((1 << 20) - 1))})
    side = F.pow(F.lit(0.5), "d")
    left, low = (F.col("cx") + F.col("qx") * side) * w, (F.col("cy") + F.col("qy") * side) * h
    rows = rows.withColumns({"left": left, "low": low, "x": left + side * (w / 2), "y": low + side * (h / 2),
                             "right": left + side * w, "high": low + side * h})

    def sub(p: Column) -> Column:
        near = F.filter(p["edges"], lambda e: (F.greatest(e["x1"], e["x2"]) >= F.col("left") - _EPS * w)
                        & (F.least(e["x1"], e["x2"]) <= F.col("right") + _EPS * w)
                        & (F.greatest(e["y1"], e["y2"]) >= F.col("low") - _EPS * h) & (F.least(e["y1"], e["y2"]) <= F.col("high") + _EPS * h))
        state = path_parity(p["edges"], p["odd"], p["ref"], F.col("x"), F.col("y"))
        fields = {"prio": p["prio"], "id": p["id"], "whole": F.size(near) == 0, "odd": moved_reference(near, state, F.col("x"), F.col("y")),
                  "ref": F.col("x"), "edges": near}
        return F.named_struct(*[c for n, f in fields.items() for c in (F.lit(n), f)])

    cut = F.filter(F.transform("candidates", sub), lambda p: p["odd"] | ~p["whole"])
    return rows.select("cx", "cy", "code", F.explode(F.expr("sequence(0, shares - 1)")).alias("share"), cut.alias("candidates"))


def _split_join(points: DataFrame, own: DataFrame, w: float, h: float, out: str, bound: int | None) -> DataFrame:
    """The shuffle join of points with their cells, hot cells split (see :func:`hot_cells`)."""
    if bound is None:
        bound = max(HOT_POINTS, int(points.count() * HOT_SHARE))
    hot = hot_cells(points, bound)
    path = scratch_path(points.sparkSession, "hot-cells")
    hot.write.parquet(path)
    hot = points.sparkSession.read.schema(hot.schema).parquet(path)
    if hot.isEmpty():
        return points.join(own.select(F.col("cx").alias("_ol_cx"), F.col("cy").alias("_ol_cy"), F.col("candidates").alias(out)),
                           ["_ol_cx", "_ol_cy"], "left")
    small = broadcast_if_bounded(hot)  # a few leaves for every ``bound`` points
    named = own.join(small.withColumnsRenamed({"_ol_cx": "cx", "_ol_cy": "cy"}), ["cx", "cy"], "left")
    plain = named.where("leaves is null").select("cx", "cy", F.lit(0).cast("bigint").alias("code"), F.lit(0).alias("share"), "candidates")
    cells = plain.unionByName(_quartered(named.where("leaves is not null"), w, h)).select(
        F.col("cx").alias("_ol_cx"), F.col("cy").alias("_ol_cy"), F.col("code").alias("_ol_code"), F.col("share").alias("_ol_share"),
        F.col("candidates").alias(out))
    codes = F.array(*[_code(d, _quadrant(F.col("_ol_ux"), F.col("_ol_cx"), d), _quadrant(F.col("_ol_uy"), F.col("_ol_cy"), d))
                      for d in range(1, HOT_DEPTH + 1)])
    dealt = (points.join(small.withColumnRenamed("leaves", "_ol_leaves"), ["_ol_cx", "_ol_cy"], "left")
             .withColumn("_ol_code", F.when(F.col("_ol_leaves").isNotNull(), F.get(F.filter(
                 codes, lambda c: F.map_contains_key("_ol_leaves", c)), 0)).otherwise(F.lit(0).cast("bigint")))
             .withColumn("_ol_share", F.when(F.col("_ol_leaves").isNotNull(), F.pmod(
                 F.monotonically_increasing_id(), F.element_at("_ol_leaves", F.col("_ol_code")))).otherwise(0).cast("int")).drop("_ol_leaves"))
    return dealt.join(cells, ["_ol_cx", "_ol_cy", "_ol_code", "_ol_share"], "left").drop("_ol_code", "_ol_share")


def _with_candidates(points: DataFrame, index: DataFrame, cell, x: str, y: str,
                     max_broadcast_rows: int, max_cell_points: int | None = None) -> DataFrame:
    spark = points.sparkSession
    wx, wy = _cell_size(cell)
    path = scratch_path(spark, "cell-index")
    index.write.parquet(path)
    stored = spark.read.schema(index.schema).parquet(path)
    levels = sorted(r.level for r in stored.select("level").distinct().collect())  # a few: each is four times the last
    # Size of one index row: key, and per candidate its ids plus 32 bytes per edge.
    size = F.aggregate("candidates", F.lit(32).cast("bigint"),
                       lambda acc, p: acc + 40 + 32 * F.size(p["edges"]))
    none = F.from_json(F.lit(None).cast("string"), stored.schema["candidates"].dataType)
    out, found = points, []
    for level in levels:
        w, h, name = wx * STEP ** level, wy * STEP ** level, f"_ol_{level}"
        own = stored.where(F.col("level") == level)
        ux, uy = F.col(x) / F.lit(w), F.col(y) / F.lit(h)
        placed = out.withColumns({"_ol_cx": F.floor(ux), "_ol_cy": F.floor(uy)})
        if bounded(own, max_broadcast_rows, BROADCAST_MAX_BYTES, size):
            cells = own.select(F.col("cx").alias("_ol_cx"), F.col("cy").alias("_ol_cy"), F.col("candidates").alias(name))
            out = placed.join(F.broadcast(cells), on=["_ol_cx", "_ol_cy"], how="left").drop("_ol_cx", "_ol_cy")
        else:
            out = _split_join(placed.withColumns({"_ol_ux": ux, "_ol_uy": uy}), own, w, h, name, max_cell_points).drop(
                "_ol_cx", "_ol_cy", "_ol_ux", "_ol_uy")
        found.append(name)
    if not found:
        return out.withColumn(_CANDIDATES, none)
    if len(found) == 1:
        return out.withColumnRenamed(found[0], _CANDIDATES)
    every = F.array_sort(F.flatten(F.filter(F.array(*found), lambda c: c.isNotNull())))
    return out.withColumn(_CANDIDATES, every).drop(*found)


def _hits(x: str, y: str) -> Column:
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    return F.filter(_CANDIDATES, lambda p: F.when(p["whole"], p["odd"]).otherwise(inside_from(p["edges"], p["odd"], p["ref"], px, py)))


def points_in_polygons(points: DataFrame, polys: DataFrame, cell,
                       id_col: str = "polygon_id", x: str = "longitude", y: str = "latitude",
                       out_col: str = "polygon_id", rings: str = "rings",
                       max_broadcast_rows: int = BROADCAST_MAX_ROWS, max_cell_points: int | None = None) -> DataFrame:
    """One row per (point, polygon that strictly contains it)."""
    idx = cell_index(polys, cell, id_col, rings)
    joined = _with_candidates(points, idx, cell, x, y, max_broadcast_rows, max_cell_points)
    return (joined.withColumn("_ol_hit", F.explode(_hits(x, y)))
            .withColumn(out_col, F.col("_ol_hit")["id"])
            .drop("_ol_hit", _CANDIDATES))


def assign_polygon(points: DataFrame, polys: DataFrame, cell,
                   id_col: str = "polygon_id", x: str = "longitude", y: str = "latitude",
                   out_col: str = "polygon_id", priority: str | None = None, rings: str = "rings",
                   max_broadcast_rows: int = BROADCAST_MAX_ROWS, max_cell_points: int | None = None) -> DataFrame:
    """J7 + P14: every point keeps one row; ``out_col`` is the first containing
    polygon by priority (``poly_seq``, else the lowest id), null when none contains it."""
    idx = cell_index(polys, cell, id_col, rings, priority)
    joined = _with_candidates(points, idx, cell, x, y, max_broadcast_rows, max_cell_points)
    return (joined.withColumn(out_col, F.get(_hits(x, y), 0)["id"])
            .drop(_CANDIDATES))


def within(points: DataFrame, polys: DataFrame, cell, id_col: str = "polygon_id",
           x: str = "longitude", y: str = "latitude", rings: str = "rings",
           max_broadcast_rows: int = BROADCAST_MAX_ROWS, max_cell_points: int | None = None) -> DataFrame:
    """Semi-join: points strictly inside at least one polygon of the layer."""
    idx = cell_index(polys, cell, id_col, rings)
    joined = _with_candidates(points, idx, cell, x, y, max_broadcast_rows, max_cell_points)
    return joined.where(F.size(_hits(x, y)) > 0).drop(_CANDIDATES)


def within_area(points: DataFrame, boundary: DataFrame, polys: DataFrame, cell, **kw) -> DataFrame:
    """Points inside the municipality boundary *and* inside some neighborhood.

    The boundary is one large polygon; the index gives it a level of its own.
    """
    return within(within(points, boundary, cell, **kw), polys, cell, **kw)
