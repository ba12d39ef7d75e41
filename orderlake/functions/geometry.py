"""Planar polygon predicates as native Spark expressions.

A polygon is ``rings ARRAY<ARRAY<STRUCT<x DOUBLE, y DOUBLE>>>`` (outer ring and
holes together; a ring may or may not repeat its first vertex). For the tests it
is flattened once into ``edges ARRAY<STRUCT<x1, y1, x2, y2>>``. Containment is the
even-odd rule on a ray to the right, and a point on an edge is *not* contained
(strict ``contains``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ring_edges(rings: Column | str = "rings") -> Column:
    """All closed-ring edges of a polygon as one array of (x1, y1, x2, y2); empty rings have none."""
    r = F.col(rings) if isinstance(rings, str) else rings

    def edges_of(ring: Column) -> Column:
        n = F.size(ring)
        return F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.struct(
                ring[i]["x"].cast("double").alias("x1"),
                ring[i]["y"].cast("double").alias("y1"),
                ring[(i + 1) % n]["x"].cast("double").alias("x2"),
                ring[(i + 1) % n]["y"].cast("double").alias("y2")))

    return F.flatten(F.transform(F.filter(r, lambda ring: F.size(ring) > 0), edges_of))


def _crosses(e: Column, px: Column, py: Column) -> Column:
    """1 if the edge crosses the horizontal ray from (px, py) to the right, else 0.

    The division only runs when the edge straddles ``py`` (so ``y2 <> y1``); that
    keeps it safe under ANSI mode.
    """
    straddles = (e["y1"] > py) != (e["y2"] > py)
    x_at = (e["x2"] - e["x1"]) * (py - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
    return F.when(straddles, F.when(px < x_at, 1).otherwise(0)).otherwise(0)


def _on_edge(e: Column, px: Column, py: Column) -> Column:
    collinear = (e["x2"] - e["x1"]) * (py - e["y1"]) == (e["y2"] - e["y1"]) * (px - e["x1"])
    in_box = (px.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
              & py.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))
    return collinear & in_box


# Added to the crossing count when the point lies on an edge; far above any real count.
_ON_EDGE = 1 << 32


def inside(edges: Column | str, px: Column, py: Column) -> Column:
    """Strict containment: odd number of ray crossings and not on the boundary.

    One pass over the edges: an edge whose y-range misses the point is rejected
    by two comparisons; otherwise it adds ``_ON_EDGE`` if the point lies on it,
    else 1 if it crosses the ray to the right.
    """
    ed = F.col(edges) if isinstance(edges, str) else edges

    def step(acc: Column, e: Column) -> Column:
        misses = (py < F.least(e["y1"], e["y2"])) | (py > F.greatest(e["y1"], e["y2"]))
        return acc + F.when(misses, F.lit(0).cast("bigint")).when(
            _on_edge(e, px, py), F.lit(_ON_EDGE).cast("bigint")).otherwise(
            _crosses(e, px, py).cast("bigint"))

    total = F.aggregate(ed, F.lit(0).cast("bigint"), step)
    return (total < _ON_EDGE) & ((total % 2) == 1)


def _x_at(e: Column, py: Column) -> Column:
    return (e["x2"] - e["x1"]) * (py - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]


def _rises(e: Column) -> Column:
    return (e["x2"] > e["x1"]) == (e["y2"] > e["y1"])


def _odd_on_path(e: Column, ref: Column, px: Column, py: Column) -> Column:
    """True if an edge is crossed an odd number of times on the way from (px, py) along its height to the line
    ``x = ref`` and from there straight up.

    The bend of the path is never tested: an edge that straddles both the height and the line passes the bend on
    a side that its slope and its side of (px, py) decide, so rounding at the bend can't count an edge twice or not at all.
    """
    across = (e["y1"] > py) != (e["y2"] > py)
    over = (e["x1"] > ref) != (e["x2"] > ref)
    right = F.when(across, px < _x_at(e, py)).otherwise(False)
    return (F.when(across & over, right != _rises(e))
            .when(across, right != (F.least(e["x1"], e["x2"]) > ref))
            .otherwise(over & (F.least(e["y1"], e["y2"]) > py)))


def path_parity(edges: Column, odd: Column, ref: Column, px: Column, py: Column) -> Column:
    """Even-odd state of (px, py) from the edges near it: ``odd`` is the parity of the other edges above, at ``ref``."""
    return F.aggregate(edges, odd, lambda acc, e: acc != _odd_on_path(e, ref, px, py))


def inside_from(edges: Column, odd: Column, ref: Column, px: Column, py: Column) -> Column:
    """Strict containment from a cell's own edges and its reference parity; a point on an edge is not contained."""
    def step(acc: Column, e: Column) -> Column:
        return acc + F.when(_on_edge(e, px, py), F.lit(_ON_EDGE).cast("bigint")).otherwise(
            _odd_on_path(e, ref, px, py).cast("bigint"))

    total = F.aggregate(edges, odd.cast("bigint"), step)
    return (total < _ON_EDGE) & ((total % 2) == 1)


def moved_reference(edges: Column, state: Column, x: Column, y: Column) -> Column:
    """The reference parity of ``edges`` at the line through (x, y), a point whose even-odd state is known."""
    def above(e: Column) -> Column:
        across = (e["y1"] > y) != (e["y2"] > y)
        right = F.when(across, x < _x_at(e, y)).otherwise(False)
        return ((e["x1"] > x) != (e["x2"] > x)) & F.when(across, right != _rises(e)).otherwise(F.least(e["y1"], e["y2"]) > y)

    return F.aggregate(edges, state, lambda acc, e: acc != above(e))
