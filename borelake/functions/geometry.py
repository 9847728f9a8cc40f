"""Polygon arithmetic as column expressions over lon/lat doubles.

A *shape* is ``array<array<array<struct<x,y>>>>``: polygons, each a list of rings (the outer one
first), each a list of vertices, closed or not. *Edges* keep that nesting, ``struct<x1,y1,x2,y2>``
in place of vertices: a point is in a shape when one of its polygons holds it, and a polygon holds
it when its outer ring does and none of its holes has it inside. So polygons that overlap, holes
that do, and holes astray outside their ring all count as a reader of the shape expects. Boundaries
belong to the shape. The boundary test compares a cross product with zero, so it is exact when the
coordinates and their products are exactly representable.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

SHAPE_TYPE = "array<array<array<struct<x:double,y:double>>>>"
EDGE_TYPE = "array<array<array<struct<x1:double,y1:double,x2:double,y2:double>>>>"

Edge = tuple[float, float, float, float]


def box_shape(min_lon: Column, min_lat: Column, max_lon: Column, max_lat: Column) -> Column:
    """The shape of a rectangle given by its bounds."""
    corners = ((min_lon, min_lat), (max_lon, min_lat), (max_lon, max_lat), (min_lon, max_lat))
    ring = F.array(*(F.struct(x.alias("x"), y.alias("y")) for x, y in corners))
    return F.array(F.array(ring))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a lambda variable."""
    return F.transform(F.array(value), body)[0]


def vertices_of(shape: Column) -> Column:
    """All vertices of a shape in one array."""
    return F.flatten(F.flatten(shape))


def ring_edges(ring: Column) -> Column:
    """Edges of one ring, from each vertex to the next and from the last to the first."""
    return F.zip_with(
        ring,
        F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1)),
        lambda a, b: F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
        ),
    )


def edges_of(shape: Column) -> Column:
    """Edges of every ring in one array; a closing vertex only adds a zero-length edge, which is harmless."""
    return F.flatten(F.transform(F.flatten(shape), ring_edges))


def part_edges(shape: Column) -> Column:
    """Edges by polygon and ring."""
    return F.transform(shape, lambda rings: F.transform(rings, ring_edges))


def narrowed(parts: Column, wanted) -> Column:
    """The edges that may matter to some place, by polygon and ring; rings without any go.

    ``wanted`` must keep every edge that a ray towards growing x can meet, so a ring that loses all of
    its edges does not hold the place, and a polygon goes with its outer ring.
    """
    kept = F.transform(parts, lambda rings: F.transform(rings, lambda ring: F.filter(ring, wanted)))
    met = F.filter(kept, lambda rings: F.size(rings[0]) > 0)
    return F.transform(met, lambda rings: F.filter(rings, lambda ring: F.size(ring) > 0))


def bounds_of(shape: Column) -> list[Column]:
    """``min_lon, min_lat, max_lon, max_lat`` of a shape."""
    xs = F.transform(vertices_of(shape), lambda v: v["x"])
    ys = F.transform(vertices_of(shape), lambda v: v["y"])
    return [F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)]


def envelope(shape: Column) -> Column:
    """The bounds as one struct ``x0, y0, x1, y1``."""
    names = ("x0", "y0", "x1", "y1")
    return F.struct(*(c.alias(n) for c, n in zip(bounds_of(shape), names, strict=True)))


def is_box(shape: Column) -> Column:
    """True when a shape is one ring that covers exactly its own envelope."""
    def covers(box):
        on_envelope = F.forall(
            edges_of(shape),
            lambda e: ((e["x1"] == e["x2"]) & ((e["x1"] == box["x0"]) | (e["x1"] == box["x1"])))
            | ((e["y1"] == e["y2"]) & ((e["y1"] == box["y0"]) | (e["y1"] == box["y1"]))),
        )

        def has_corner(x, y):
            return F.exists(vertices_of(shape), lambda v: (v["x"] == box[x]) & (v["y"] == box[y]))

        corners = [has_corner(x, y) for x in ("x0", "x1") for y in ("y0", "y1")]
        return reduce(and_, corners, on_envelope)

    return (F.size(shape) == 1) & (F.size(F.flatten(shape)) == 1) & let(envelope(shape), covers)


def in_box(lon: Column, lat: Column, bounds: Sequence) -> Column:
    """Point in rectangle, edges included. On literals this reaches the Parquet scan."""
    x0, y0, x1, y1 = bounds
    return lon.between(x0, x1) & lat.between(y0, y1)


def boxes_overlap(a: Sequence, b: Sequence) -> Column:
    """Two rectangles share at least a point."""
    return (a[0] <= b[2]) & (b[0] <= a[2]) & (a[1] <= b[3]) & (b[1] <= a[3])


def _cross(x1, y1, x2, y2, px, py):
    return (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)


def _within(v, a, b):
    return (F.least(a, b) <= v) & (v <= F.greatest(a, b))


def _on_edge(e, px, py) -> Column:
    touches = _cross(e["x1"], e["y1"], e["x2"], e["y2"], px, py) == 0
    return touches & _within(px, e["x1"], e["x2"]) & _within(py, e["y1"], e["y2"])


def _crossed(e, px, py) -> Column:
    """Does the ray from the point towards growing x pass through the edge?"""
    upward = e["y2"] > e["y1"]
    spans = (e["y1"] > py) != (e["y2"] > py)
    return spans & ((_cross(e["x1"], e["y1"], e["x2"], e["y2"], px, py) > 0) == upward)


def point_in_parts(px: Column, py: Column, parts: Column) -> Column:
    """Whether a point is in one of the polygons given by their edges, boundary included; a NaN is nowhere."""
    def odd(ring):
        return F.size(F.filter(ring, lambda e: _crossed(e, px, py))) % 2 == 1

    def on(ring):
        return F.exists(ring, lambda e: _on_edge(e, px, py))

    def holds(rings):
        holes = F.slice(rings, 2, F.size(rings))
        return (odd(rings[0]) | on(rings[0])) & F.forall(holes, lambda ring: ~odd(ring) | on(ring))

    somewhere = ~F.isnan(px) & ~F.isnan(py)
    return somewhere & F.exists(F.filter(parts, lambda rings: F.size(rings) > 0), holds)


def point_in_literal_parts(px: Column, py: Column, parts: Sequence[Sequence[Sequence[Edge]]]) -> Column:
    """The same rule unrolled for a few constant edges, so it stays inside generated code."""
    def ring_holds(edges: Sequence[Edge]) -> tuple[Column, Column]:
        on_boundary, crossings = F.lit(False), F.lit(0)
        for x1, y1, x2, y2 in edges:
            cross = F.lit(x2 - x1) * (py - y1) - F.lit(y2 - y1) * (px - x1)
            on_boundary = on_boundary | (
                (cross == 0) & px.between(min(x1, x2), max(x1, x2)) & py.between(min(y1, y2), max(y1, y2))
            )
            if y1 != y2:
                side = cross > 0 if y2 > y1 else cross < 0
                spans = (py >= min(y1, y2)) & (py < max(y1, y2))
                crossings = crossings + (spans & side).cast("int")
        return on_boundary, crossings % 2 == 1

    held = F.lit(False)
    for shell, *holes in parts:
        on, odd = ring_holds(shell)
        holds = on | odd
        for hole in holes:
            on, odd = ring_holds(hole)
            holds = holds & (on | ~odd)
        held = held | holds
    return held


def edges_meet(a, b) -> Column:
    """Two closed segments share a point."""
    d1 = _cross(a["x1"], a["y1"], a["x2"], a["y2"], b["x1"], b["y1"])
    d2 = _cross(a["x1"], a["y1"], a["x2"], a["y2"], b["x2"], b["y2"])
    d3 = _cross(b["x1"], b["y1"], b["x2"], b["y2"], a["x1"], a["y1"])
    d4 = _cross(b["x1"], b["y1"], b["x2"], b["y2"], a["x2"], a["y2"])
    proper = (F.signum(d1) * F.signum(d2) < 0) & (F.signum(d3) * F.signum(d4) < 0)
    touching = (
        _on_edge(a, b["x1"], b["y1"])
        | _on_edge(a, b["x2"], b["y2"])
        | _on_edge(b, a["x1"], a["y1"])
        | _on_edge(b, a["x2"], a["y2"])
    )
    return proper | touching


def shapes_intersect(shape: Column, other: Column) -> Column:
    """Two shapes share a point: an edge meets an edge, or a ring begins inside the other.

    Before edges are paired they are cut down to those that reach into the other envelope.
    """
    def reaching(edges, box):
        return F.filter(
            edges,
            lambda e: (F.least(e["x1"], e["x2"]) <= box["x1"])
            & (F.greatest(e["x1"], e["x2"]) >= box["x0"])
            & (F.least(e["y1"], e["y2"]) <= box["y1"])
            & (F.greatest(e["y1"], e["y2"]) >= box["y0"]),
        )

    def ring_inside(rings, parts):
        return F.exists(rings, lambda ring: point_in_parts(ring[0]["x"], ring[0]["y"], parts))

    def compare(both):
        mine, theirs = both["mine"], both["theirs"]
        meet = let(
            F.struct(
                reaching(mine, both["their_box"]).alias("m"),
                reaching(theirs, both["my_box"]).alias("t"),
            ),
            lambda cut: F.exists(cut["m"], lambda a: F.exists(cut["t"], lambda b: edges_meet(a, b))),
        )
        overlap = boxes_overlap(*([both[k][c] for c in ("x0", "y0", "x1", "y1")]
                                  for k in ("my_box", "their_box")))
        return overlap & (
            meet | ring_inside(F.flatten(shape), both["their_parts"]) | ring_inside(F.flatten(other), both["my_parts"])
        )

    return let(
        F.struct(
            edges_of(shape).alias("mine"), edges_of(other).alias("theirs"),
            part_edges(shape).alias("my_parts"), part_edges(other).alias("their_parts"),
            envelope(shape).alias("my_box"), envelope(other).alias("their_box"),
        ),
        compare,
    )


# Rings in canonical form -----------------------------------------------------------------

# Fixed value: coordinates are compared at six decimal places, about 0.1 m.
KEY_SCALE = 1_000_000


def snapped(ring: Column) -> Column:
    """Whole micro-degrees without repeated neighbours or a closing vertex."""
    on_grid = F.transform(
        ring,
        lambda v: F.struct(
            F.floor(v["x"] * KEY_SCALE + F.lit(0.5)).cast("bigint").alias("x"),
            F.floor(v["y"] * KEY_SCALE + F.lit(0.5)).cast("bigint").alias("y"),
        ),
    )
    # the vertex before the first one is the last, so this drops a closing vertex as well
    return let(
        on_grid,
        lambda g: F.filter(
            g, lambda v, i: (F.size(g) == 1) | (v != F.element_at(g, F.when(i == 0, -1).otherwise(i)))
        ),
    )


def doubled_area(grid: Column) -> Column:
    """Twice the signed area, in decimals so that no product overflows or rounds."""
    wide = "decimal(19,0)"
    terms = F.transform(
        ring_edges(grid),
        lambda e: (e["x1"].cast(wide) * e["y2"].cast(wide) - e["x2"].cast(wide) * e["y1"].cast(wide))
        .cast("decimal(38,0)"),
    )
    return F.aggregate(
        terms, F.lit(0).cast("decimal(38,0)"), lambda total, t: (total + t).cast("decimal(38,0)")
    )


def _rotated(grid: Column) -> Column:
    """Start the ring at its least vertex."""
    first = F.array_position(grid, F.array_min(grid)).cast("int")
    return F.concat(F.slice(grid, first, F.size(grid)), F.slice(grid, 1, first - 1))


def canonical_ring(ring: Column) -> Column:
    """Text of a ring that is the same for any start vertex, direction and sub-grid noise."""
    turned = let(
        snapped(ring), lambda g: F.when(doubled_area(g) < 0, F.reverse(g)).otherwise(g)
    )
    return F.array_join(
        F.transform(let(turned, _rotated), lambda v: F.concat_ws(" ", v["x"], v["y"])), ","
    )


def canonical_shape(shape: Column) -> Column:
    """Text of a shape: outer ring, then its holes in order; polygons in order."""
    polygons = F.transform(
        shape,
        lambda rings: F.array_join(
            F.concat(
                F.array(canonical_ring(rings[0])),
                F.array_sort(F.transform(F.slice(rings, 2, F.size(rings)), canonical_ring)),
            ),
            ";",
        ),
    )
    return F.array_join(F.array_sort(polygons), "|")
