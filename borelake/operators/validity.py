"""Whether the regions of a table are valid: rings that are simple, holes within their shell, parts apart.

All of it is exact: vertices are whole micro-degrees, and where two rings touch without crossing they
do so at a vertex of one of them, so that every point compared is a whole number in half micro-degrees.

Edges are bucketed by rows of latitude, or columns of longitude where those split the region better,
and meet the edges of their own row in an equi-join; a region of any size is spread over tasks by its
rows. Edges are cut where they touch another ring; the middle of each piece, counted against the edges
of its row, lies inside another ring, outside it or on it. A ring whose pieces disagree crosses.

The rules: every ring has three vertices or more, an area, and meets itself nowhere; a hole lies within
its shell; holes of one part, and parts, have no area in common, though a part may lie in, or fill, another's hole.
Rings may share points and sides. Coordinates beyond 360 degrees, infinite or missing ones are no region.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import park
from ..functions.geometry import doubled_area, ring_edges, snapped, vertices_of
from .hot_keys import over_tasks, spread_join

# Fixed value: no longitude or latitude is beyond it, and no product of two distances then overflows.
LARGEST = 360.0


def _rings(numbered: DataFrame, shape: str) -> DataFrame:
    """``_region, _part, _ring, _grid``: every ring in whole micro-degrees."""
    parts = numbered.select("_region", F.posexplode(shape).alias("_part", "_rings"))
    rings = parts.select("_region", "_part", F.posexplode("_rings").alias("_ring", "_vertices"))
    return rings.select("_region", "_part", "_ring", snapped(F.col("_vertices")).alias("_grid"))


def _edges(rings: DataFrame) -> DataFrame:
    """Every edge with its ring ``_who``, its place ``_i`` among ``_n``, and its row buckets' measures.

    ``x`` and ``y`` change places in regions that longitude splits better.
    """
    plain = rings.select(
        "_region", "_part", "_ring", F.shiftleft(F.col("_part").cast("bigint"), 31).bitwiseOR(F.col("_ring")).alias("_who"),
        F.size("_grid").alias("_n"), F.posexplode(ring_edges(F.col("_grid"))).alias("_i", "_e"),
    ).select("*", "_e.*").drop("_e")

    def rows_by(low: str, high: str) -> list[Column]:
        spans = F.sum(F.abs(F.col(high) - F.col(low)))
        least = F.min(F.least(low, high))
        tall = F.max(F.greatest(low, high)) - least
        n = F.count(F.lit(1))
        # As many rows as edges over four, but no more than give each edge three rows on average.
        rows = F.greatest(F.lit(1), F.least(n / 4 + 1, 3 * n * tall / F.greatest(spans, F.lit(1))).cast("bigint"))
        return [rows, least, tall]

    names = ("rows", "least", "tall")
    extents = plain.groupBy("_region").agg(
        F.count_distinct("_who").alias("_n_rings"),
        *[c.alias(f"_{a}_{n}") for a in "xy" for c, n in zip(rows_by(f"{a}1", f"{a}2"), names, strict=True)],
    )
    across = F.col("_x_rows") > F.col("_y_rows")
    extents = extents.select(
        "_region", "_n_rings", across.alias("_across"),
        *[F.when(across, F.col(f"_x_{n}")).otherwise(F.col(f"_y_{n}")).alias(f"_{n}") for n in names],
    ).withColumn("_height", F.greatest(F.lit(1), F.ceil(F.col("_tall") / F.col("_rows")).cast("bigint")))
    placed = spread_join(plain, park(extents.drop("_rows", "_tall"), "region-extents"), ["_region"])
    turned = {f"{a}{k}": F.when(F.col("_across"), F.col(f"{b}{k}")).otherwise(F.col(f"{a}{k}")) for a, b in ("xy", "yx") for k in (1, 2)}
    placed = placed.withColumns(turned)
    return placed.withColumns({
        "_first": _row(F.least("y1", "y2")), "_last": _row(F.greatest("y1", "y2")),
        "xl": F.least("x1", "x2"), "xh": F.greatest("x1", "x2"), "yl": F.least("y1", "y2"), "yh": F.greatest("y1", "y2"),
    })


def _row(y: Column, scale: int = 1) -> Column:
    return F.floor((y - F.col("_least") * scale) / (F.col("_height") * scale)).cast("bigint")


def _side(e: str, x: str, y: str) -> Column:
    """On which side of edge ``e`` a point lies, 0 on its line; exact."""
    c = {k: F.col(f"{e}{k}") for k in ("x1", "y1", "x2", "y2")}
    return (c["x2"] - c["x1"]) * (F.col(y) - c["y1"]) - (c["y2"] - c["y1"]) * (F.col(x) - c["x1"])


def _pairs(entries: DataFrame) -> DataFrame:
    """Pairs of edges of one region that may meet, once each, columns prefixed ``a_`` and ``b_``."""
    kept = ("_who", "_i", "_n", "_first", "x1", "y1", "x2", "y2", "xl", "xh", "yl", "yh")
    a, b = (entries.select("_region", "_row", *[F.col(c).alias(f"{p}{c}") for c in kept]) for p in ("a_", "b_"))
    before = (F.col("a__who") < F.col("b__who")) | (F.col("a__who") == F.col("b__who")) & (F.col("a__i") < F.col("b__i"))
    near = before & (F.col("a_xl") <= F.col("b_xh")) & (F.col("b_xl") <= F.col("a_xh")) & (F.col("a_yl") <= F.col("b_yh")) & (
        F.col("b_yl") <= F.col("a_yh"))
    # Written: with the exact tests in the same generated method, the JVM would not compile it.
    both = park(a.join(b, ["_region", "_row"]).where(near & (F.col("_row") == F.greatest("a__first", "b__first"))), "near-edges")
    sides = {
        "_b1": _side("a_", "b_x1", "b_y1"), "_b2": _side("a_", "b_x2", "b_y2"),
        "_a1": _side("b_", "a_x1", "a_y1"), "_a2": _side("b_", "a_x2", "a_y2"),
    }

    def on(side: str, e: str, x: str, y: str) -> Column:
        inside = F.col(x).between(F.col(f"{e}xl"), F.col(f"{e}xh")) & F.col(y).between(F.col(f"{e}yl"), F.col(f"{e}yh"))
        return (F.col(side) == 0) & inside

    crossing = (F.signum("_b1") * F.signum("_b2") < 0) & (F.signum("_a1") * F.signum("_a2") < 0)
    return both.withColumns(sides).select(
        "*", crossing.alias("_cross"), on("_b1", "a_", "b_x1", "b_y1").alias("_b1_on"), on("_b2", "a_", "b_x2", "b_y2").alias("_b2_on"),
        on("_a1", "b_", "a_x1", "a_y1").alias("_a1_on"), on("_a2", "b_", "a_x2", "a_y2").alias("_a2_on"),
    ).where("_cross OR _b1_on OR _b2_on OR _a1_on OR _a2_on")


def _bad_pairs(met: DataFrame) -> DataFrame:
    """Regions with two rings that cross, or a ring that meets itself but at neighbours' shared vertex."""
    one = F.col("a__who") == F.col("b__who")
    follows = F.col("b__i") == F.col("a__i") + 1
    closes = (F.col("a__i") == 0) & (F.col("b__i") == F.col("a__n") - 1)
    folded = F.when(follows, F.col("_b2_on") | F.col("_a1_on")).when(closes, F.col("_b1_on") | F.col("_a2_on")).otherwise(True)
    return met.where(F.when(one, folded).otherwise(F.col("_cross"))).select("_region")


def _probes(edges: DataFrame, met: DataFrame) -> DataFrame:
    """The middle of every piece of an edge between its touches, in half micro-degrees."""
    def touch(owner: str, on: str, x: str, y: str) -> Column:
        return F.when(F.col(on), F.struct(F.col(f"{owner}_who").alias("_who"), F.col(f"{owner}_i").alias("_i"), F.col(x).alias("x"), F.col(y).alias("y")))

    touches = met.where("a__who <> b__who").select("_region", F.explode(F.array(
        touch("a_", "_b1_on", "b_x1", "b_y1"), touch("a_", "_b2_on", "b_x2", "b_y2"),
        touch("b_", "_a1_on", "a_x1", "a_y1"), touch("b_", "_a2_on", "a_x2", "a_y2"),
    )).alias("_t")).where("_t IS NOT NULL").select("_region", "_t.*")
    key = ["_region", "_who", "_i"]
    split = touches.groupBy(*key).agg(F.collect_set(F.struct("x", "y")).alias("_touches"))
    ends = F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))
    points = F.array_sort(F.array_distinct(F.concat(ends, F.coalesce("_touches", F.array().cast("array<struct<x:bigint,y:bigint>>")))))
    cut = edges.join(split, key, "left").select(*key, "_part", "_ring", "_least", "_height", points.alias("_points"))
    middle = F.zip_with(
        F.slice("_points", 1, F.size("_points") - 1), F.slice("_points", 2, F.size("_points") - 1),
        lambda p, q: F.struct((p["x"] + q["x"]).alias("px"), (p["y"] + q["y"]).alias("py")),
    )
    pieces = cut.select(*key, "_part", "_ring", "_least", "_height", F.posexplode(middle).alias("_piece", "_p")).select("*", "_p.*")
    return pieces.withColumn("_row", _row(F.col("py"), 2)).drop("_p", "_least", "_height")


def _relations(probes: DataFrame, entries: DataFrame) -> DataFrame:
    """``_region, _who, _other`` of rings where the first lies in or on the other: pieces ``_in, _on`` of ``_all``."""
    others = entries.select(
        "_region", "_row", F.col("_who").alias("_other"), F.col("_part").alias("_o_part"), F.col("_ring").alias("_o_ring"),
        *[(F.col(c) * 2).alias(f"o_{c}") for c in ("x1", "y1", "x2", "y2")],
    )
    # A hole is held against its own part's rings, a shell against the rings of other parts.
    asked = F.when(F.col("_ring") > 0, (F.col("_part") == F.col("_o_part")) & (F.col("_ring") != F.col("_o_ring"))).otherwise(
        F.col("_part") != F.col("_o_part")
    )
    side = _side("o_", "px", "py")
    spans = (F.col("o_y1") > F.col("py")) != (F.col("o_y2") > F.col("py"))
    crossed = spans & ((side > 0) == (F.col("o_y2") > F.col("o_y1")))
    on = (side == 0) & F.col("px").between(F.least("o_x1", "o_x2"), F.greatest("o_x1", "o_x2")) & F.col("py").between(
        F.least("o_y1", "o_y2"), F.greatest("o_y1", "o_y2"))
    met = probes.join(others, ["_region", "_row"]).where(asked).withColumns({"_crossed": crossed, "_touched": on})
    each = met.where("_crossed OR _touched").groupBy("_region", "_who", "_other", "_i", "_piece").agg(
        (F.sum(F.col("_crossed").cast("int")) % 2 == 1).alias("_odd"), F.max("_touched").alias("_touched")
    )
    held = each.groupBy("_region", "_who", "_other").agg(
        F.count_if(F.col("_odd") & ~F.col("_touched")).alias("_in"), F.count_if("_touched").alias("_on")
    )
    return held.join(probes.groupBy("_region", "_who").agg(F.count(F.lit(1)).alias("_all")), ["_region", "_who"])


def _misplaced(rings: DataFrame, relations: DataFrame) -> DataFrame:
    """Regions whose rings cross, coincide, overlap or lie where they should not."""
    part, ring = (lambda c: F.shiftright(c, 31)), (lambda c: F.col(c).bitwiseAND(F.lit((1 << 31) - 1)))
    placed = relations.withColumns({"_ring": ring("_who"), "_o_ring": ring("_other"), "_o_part": part("_other")})
    fills = "(_on = _all AND _ring = 0 AND _o_ring > 0)"  # a part that is just another's hole
    crossed = placed.where(f"(_in > 0 AND _in + _on < _all) OR (_on = _all AND NOT {fills})").select("_region")
    within = park(placed.where(f"(_in > 0 AND _in + _on = _all) OR {fills}").drop("_in", "_on", "_all"), "rings-within")
    holes_in_holes = within.where("_ring > 0 AND _o_ring > 0").select("_region")
    who = ["_region", "_who"]
    stray = rings.where("_ring > 0").select(*who).join(within.where("_ring > 0 AND _o_ring = 0"), who, "left_anti").select("_region")
    shells = within.where("_ring = 0")
    island = ["_region", "_who", "_o_part"]
    overlapping = shells.where("_o_ring = 0").join(shells.where("_o_ring > 0"), island, "left_anti").select("_region")
    return crossed.unionByName(holes_in_holes).unionByName(stray).unionByName(overlapping)


def with_validity(regions: DataFrame, shape: str = "shape") -> DataFrame:
    """Adds ``region_valid`` to a table of polygon regions; all other columns stay.

    The regions are written once, numbered. A region without rings, or a null one, is not valid.
    """
    numbered = park(over_tasks(regions).withColumn("_region", F.monotonically_increasing_id()), "regions")
    sound = F.forall(
        vertices_of(F.col(shape)), lambda v: v["x"].between(-LARGEST, LARGEST) & v["y"].between(-LARGEST, LARGEST)
    ) & (F.size(shape) > 0) & F.forall(shape, lambda rings: F.size(rings) > 0)
    usable = numbered.where(F.coalesce(sound, F.lit(False))).select("_region", shape)
    rings = park(_rings(usable, shape), "region-rings")
    thin = rings.where((F.size("_grid") < 3) | (doubled_area(F.col("_grid")) == 0)).select("_region")
    whole = rings.join(thin.distinct(), "_region", "left_anti")
    edges = park(_edges(whole), "region-edges")
    entries = edges.withColumn("_row", F.explode(F.sequence("_first", "_last")))
    met = park(_pairs(entries), "meeting-edges")
    several = edges.where("_n_rings > 1")
    probes = park(_probes(several, met), "ring-pieces")
    relations = park(_relations(probes, entries.where("_n_rings > 1")), "ring-relations")
    named = whole.select("_region", "_ring", F.shiftleft(F.col("_part").cast("bigint"), 31).bitwiseOR(F.col("_ring")).alias("_who"))
    bad = thin.unionByName(_bad_pairs(met)).unionByName(_misplaced(named, relations)).distinct()
    good = usable.select("_region").join(bad, "_region", "left_anti").withColumn("region_valid", F.lit(True))
    return spread_join(numbered, park(good, "valid-regions"), ["_region"], "left").select(
        *regions.columns, F.coalesce("region_valid", F.lit(False)).alias("region_valid")
    )
