"""Points in many polygons, as an equi-join on grid cells.

Polygons are cut along a lon/lat grid of a level that fits their size: the coarse grid for large
ones, which then carry few edges per cell, and ever finer ones for small ones, so that a hundred
thousand of them in one coarse cell do not all meet its points. Each (polygon, cell) row is either
*inside*, when no edge passes the cell, or carries just the edges a point of that cell has to be
tested against, by part and ring; cells wholly outside are dropped. A point probes its cell of every
level in use. It has one cell per level and a polygon has one level, so it meets each polygon at most
once and no pair needs removing afterwards.

The cut polygons are broadcast only when their cells, edges and carried text prove them small;
otherwise both sides shuffle on the cell, and a crowded cell's points are spread over tasks.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BROADCAST_LIMIT
from ..functions.coerce import quoted
from ..functions.geometry import (
    EDGE_TYPE, bounds_of, boxes_overlap, edges_meet, edges_of, envelope, in_box, is_box, let, narrowed, part_edges,
    point_in_parts, shapes_intersect,
)
from ..region import Region
from .hot_keys import FLAT_TYPES, key_join, most_tasks, over_tasks, spread_join

CELL_DEGREES = 0.5
# Grids finer than that one, each of cells so many times smaller; the finest has cells of about 50 m.
FINER, TIMES = 5, 4
# Slack around a cell, in degrees: far above rounding error, far below any coordinate's accuracy.
_SLACK = 1e-9


def cell_of(value: Column, cell: float | Column) -> Column:
    """Grid index of a coordinate; null for an infinite one, which lies in no cell."""
    return F.floor(value / (cell if isinstance(cell, Column) else F.lit(float(cell)))).try_cast("int")


def _level(shape: Column, cell: float) -> Column:
    """The finest grid whose cells are no smaller than the polygon; 0 for the coarsest one."""
    x0, y0, x1, y1 = bounds_of(shape)
    extent = F.greatest(x1 - x0, y1 - y0)
    return reduce(add, ((extent <= cell / TIMES**k).cast("int") for k in range(1, FINER + 1)), F.lit(0))


def _cell_size(level: Column, cell: float) -> Column:
    """Degrees of a level's cells."""
    return F.element_at(F.array(*[F.lit(cell / TIMES**k) for k in range(FINER + 1)]), level + 1)


def _reach(edge, low: str, high: str, smallest: Column, largest: Column) -> Column:
    return (F.greatest(edge[low], edge[high]) >= smallest) & (
        F.least(edge[low], edge[high]) <= largest
    )


def _touches(edge, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """The edge may pass the box: its envelope does, and the corners are not all on one side."""
    sides = [
        (edge["x2"] - edge["x1"]) * (y - edge["y1"]) - (edge["y2"] - edge["y1"]) * (x - edge["x1"])
        for x in (x0, x1)
        for y in (y0, y1)
    ]
    near = _reach(edge, "x1", "x2", x0, x1) & _reach(edge, "y1", "y2", y0, y1)
    return near & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)


def cut_to_cells(
    polygons: DataFrame, shape: str = "shape", cell: float = CELL_DEGREES
) -> DataFrame:
    """One row per polygon and cell of its grid that it reaches: ``_level, _cell_x, _cell_y, _all_inside, _cell_edges``.

    A polygon that is a box keeps only its envelope ``_box``, which then decides by itself. Edges are narrowed to a row of cells first and to single cells after that, so the work per
    polygon grows with rows times edges rather than with cells times edges.
    """
    others = [c for c in polygons.columns if c != shape]
    size = F.col("_size")
    low = F.col("_cell_y") * size - _SLACK
    high = (F.col("_cell_y") + 1) * size + _SLACK
    measured = polygons.where(F.size(F.flatten(F.col(shape))) > 0).select(
        *others, shape, part_edges(F.col(shape)).alias("_edges"), envelope(F.col(shape)).alias("_box"),
        is_box(F.col(shape)).alias("_is_box"), _level(F.col(shape), cell).alias("_level"),
    ).withColumn("_size", _cell_size(F.col("_level"), cell))
    x0, y0, x1, y1 = (F.col(f"_box.{c}") for c in ("x0", "y0", "x1", "y1"))
    kept = ("_box", "_is_box", "_level", "_size")
    rows = measured.select(
        *others, "_edges", *kept, cell_of(x0, size).alias("_x0"), cell_of(x1, size).alias("_x1"),
        F.explode(F.sequence(cell_of(y0, size), cell_of(y1, size))).alias("_cell_y"),
    ).withColumn("_edges", narrowed(F.col("_edges"), lambda e: _reach(e, "y1", "y2", low, high)))
    cells = rows.select(*others, "_cell_y", "_edges", *kept, F.explode(F.sequence("_x0", "_x1")).alias("_cell_x"))
    left = F.col("_cell_x") * size - _SLACK
    right = (F.col("_cell_x") + 1) * size + _SLACK
    cut = F.exists(F.flatten(F.flatten("_edges")), lambda e: _touches(e, left, low, right, high))
    bounded = cells.select(
        *others, "_cell_x", "_cell_y", *kept, cut.alias("_cut"),
        narrowed(F.col("_edges"), lambda e: F.greatest(e["x1"], e["x2"]) >= left).alias("_edges"),
    )
    centre_in = point_in_parts((F.col("_cell_x") + 0.5) * size, (F.col("_cell_y") + 0.5) * size, F.col("_edges"))
    return bounded.where(F.col("_cut") | centre_in).select(
        *others, "_level", "_cell_x", "_cell_y", "_box",
        (~F.col("_cut") | F.col("_is_box")).alias("_all_inside"),
        F.when(F.col("_cut") & ~F.col("_is_box"), F.col("_edges")).alias("_cell_edges"),
    )


def _proven_bytes(polygons: DataFrame, shape: str, cell: float) -> tuple[float, list[int]]:
    """Upper bound on the size of the cut polygons, and the levels in use; one small aggregate.

    An edge is stored in every cell of the rows it reaches (one spare row on each side for slack) with
    its ring's and part's share of array headers, the carried columns with their text in every cell.
    Infinite when a nested one makes that no bound.
    """
    carried = [f for f in polygons.schema if f.name != shape]
    flat = all(isinstance(f.dataType, FLAT_TYPES) for f in carried)
    text = [
        F.coalesce(F.octet_length(quoted(f.name)), F.lit(0)) for f in carried if isinstance(f.dataType, T.StringType)
    ]
    row_bytes = reduce(add, text, F.lit(128.0 + 32 * len(carried)))
    level = _level(F.col(shape), cell)
    x0, y0, x1, y1 = bounds_of(F.col(shape))
    size = F.col("_size")
    wide = (cell_of(x1, size) - cell_of(x0, size) + 1).cast("double")
    tall = (cell_of(y1, size) - cell_of(y0, size) + 1).cast("double")
    rows_reached = F.aggregate(
        edges_of(F.col(shape)),
        F.lit(0.0),
        lambda total, e: total + F.abs(F.floor(e["y2"] / size) - F.floor(e["y1"] / size)) + 3.0,
    )
    sized = polygons.withColumn("_level", level).withColumn("_size", _cell_size(F.col("_level"), cell))
    row = sized.agg(
        F.sum(wide * tall * row_bytes).alias("cells"), F.sum(wide * rows_reached).alias("edges"),
        F.sort_array(F.collect_set("_level")).alias("levels"),
    ).first()
    proven = (row["cells"] or 0) + (row["edges"] or 0) * 96 if flat else float("inf")
    return proven, row["levels"]


def points_in_polygons(
    points: DataFrame,
    polygons: DataFrame,
    *,
    lon: str = "longitude",
    lat: str = "latitude",
    shape: str = "shape",
    cell: float = CELL_DEGREES,
    how: str = "inner",
    limit: int = BROADCAST_LIMIT,
    hot_rows: int | None = None,
) -> DataFrame:
    """Each point with each polygon that holds it, boundary included.

    Polygon columns other than the shape come along; names must not collide with the points'.
    ``how='left_semi'`` keeps the points that lie in any polygon, unchanged.
    """
    carried = [c for c in polygons.columns if c != shape]
    if how == "left_semi":
        polygons, carried = polygons.select(shape), []
    polygons = over_tasks(polygons)  # cutting is much work for few bytes
    cut = cut_to_cells(polygons, shape, cell)
    proven, levels = _proven_bytes(polygons, shape, cell)
    placed = points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull())
    in_envelope = in_box(F.col(lon), F.col(lat), [F.col(f"_box.{c}") for c in ("x0", "y0", "x1", "y1")])
    held = in_envelope & (
        F.col("_all_inside") | point_in_parts(F.col(lon), F.col(lat), F.col("_cell_edges"))
    )
    keys = ["_level", "_cell_x", "_cell_y"]

    def probe(places: DataFrame, asked: list[int]) -> DataFrame:
        """The points, once for every level asked for, with their cells there."""
        level = F.lit(asked[0]) if len(asked) == 1 else F.explode(F.array(*map(F.lit, asked)))
        at = places.select("*", level.alias("_level"))
        size = _cell_size(F.col("_level"), cell)
        return at.select("*", cell_of(F.col(lon), size).alias("_cell_x"), cell_of(F.col(lat), size).alias("_cell_y"))

    def meet(asked: list[int], places: DataFrame, kind: str) -> DataFrame:
        points = probe(places, asked)
        if proven <= limit:
            return key_join(points, F.broadcast(cut), keys, kind, held)
        # Bigger than the limit, so it must not be broadcast on a guess either. Of one level the cells alone are
        # the key: Spark drops a constant from a join's keys, and would deal both sides anew.
        one = len(asked) == 1
        mine = cut.where(F.col("_level") == asked[0]).drop("_level") if one else cut
        met = keys[1:] if one else keys
        return spread_join(
            points.drop("_level") if one else points, mine, met, kind, hot_rows, held, limit=0, hint="merge", tasks=most_tasks(cut))

    levels = levels or [0]
    if how != "left_semi" or len(levels) == 1:
        return meet(levels, placed, how).select(*points.columns, *carried)
    # A point may lie in polygons of several levels: it is taken by the first that has it.
    found, rest = [], placed
    for level in levels:
        found.append(meet([level], rest, "left_semi").select(*points.columns))
        rest = meet([level], rest, "left_anti").select(*points.columns)
    return reduce(DataFrame.unionByName, found)


def polygons_in_region(
    polygons: DataFrame, region: Column | Region, bounds=None, shape: str = "shape",
    stored_bounds: tuple[str, str, str, str] | None = None,
) -> DataFrame:
    """Polygons that share a point with one region.

    The envelope test comes first; on stored bound columns it reaches the Parquet scan. A ``Region`` is
    sent as an index of its edges by rows of latitude, so that planning does not grow with its vertices
    and a polygon is compared with the edges of its own rows alone; a shape column is compared whole.
    """
    mine = [F.col(c) for c in stored_bounds] if stored_bounds else bounds_of(F.col(shape))
    bounds = region.bounds if isinstance(region, Region) else bounds
    near = polygons.where(boxes_overlap(mine, [F.lit(float(b)) for b in bounds]))
    if isinstance(region, Region):
        return near.where(_meets_index(F.col(shape), region))
    return near.where(let(region, lambda r: shapes_intersect(F.col(shape), r)))


def _region_index(region: Region) -> tuple[str, float, float, int]:
    """The region's edges by row, part and ring as text, where the rows begin, their height and number."""
    _, south, _, north = region.bounds
    rows = max(1, round(len(region.edges) ** 0.5))
    height = (north - south) / rows

    def within(edge, row: int) -> bool:
        low, high = south + row * height - _SLACK, south + (row + 1) * height + _SLACK
        return max(edge[1], edge[3]) >= low and min(edge[1], edge[3]) <= high

    def named(edge):
        return dict(zip(("x1", "y1", "x2", "y2"), edge, strict=True))

    index = [
        [[[named(e) for e in ring if within(e, row)] for ring in rings] for rings in region.part_edges] for row in range(rows)
    ]
    # a part whose shell has no edge in a row holds no point of it, nor does a hole without one
    index = [[[ring for i, ring in enumerate(rings) if ring or not i] for rings in row if rings[0]] for row in index]
    return json.dumps(index), south, height, rows


def _meets_index(shape: Column, region: Region) -> Column:
    text, south, height, rows = _region_index(region)
    index = F.from_json(F.lit(text), f"array<{EDGE_TYPE}>")
    firsts = F.from_json(F.lit(json.dumps([dict(zip("xy", ring[0], strict=True)) for p in region.polygons for ring in p])), "array<struct<x:double,y:double>>")

    def row_of(y: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.lit(rows - 1), F.floor((y - F.lit(south)) / F.lit(height)).cast("int")))

    def compare(mine):
        box = mine["box"]
        low, high = row_of(box["y0"]), row_of(box["y1"])
        theirs = F.filter(
            F.flatten(F.flatten(F.flatten(F.slice(index, low + 1, high - low + 1)))),
            lambda e: _reach(e, "x1", "x2", box["x0"], box["x1"]) & _reach(e, "y1", "y2", box["y0"], box["y1"]),
        )
        meet = let(theirs, lambda near: F.exists(mine["edges"], lambda a: F.exists(near, lambda b: edges_meet(a, b))))

        def in_region(ring):
            x, y = ring[0]["x"], ring[0]["y"]
            inside = point_in_parts(x, y, F.get(index, row_of(y)))
            return (y >= south) & (y <= south + rows * height + _SLACK) & inside

        begins_inside = F.exists(F.flatten(shape), in_region)
        holds = F.exists(firsts, lambda p: point_in_parts(p["x"], p["y"], mine["parts"]))
        return meet | begins_inside | holds

    return let(
        F.struct(edges_of(shape).alias("edges"), part_edges(shape).alias("parts"), envelope(shape).alias("box")), compare
    )
