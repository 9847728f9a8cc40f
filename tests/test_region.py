import math
import random
import time

import pytest
from pyspark.sql import functions as F

from borelake.functions.geometry import SHAPE_TYPE, box_shape, is_box, part_edges, point_in_parts
from borelake.functions.keys import region_key
from borelake.operators.filters import in_region, region_shape
from borelake.operators.hot_keys import over_tasks, spread_join
from borelake.operators.spatial_join import cut_to_cells, points_in_polygons, polygons_in_region
from borelake.operators.validity import with_validity
from borelake.region import Region

from .conftest import rows

TRIANGLE = [(148.95, -35.55), (149.25, -35.55), (149.10, -35.15)]


def star(rng, x, y, n, r):
    """A simple polygon around a centre."""
    turns = [(2 * math.pi * (i + rng.uniform(0, 0.4)) / n, r * rng.uniform(0.4, 1)) for i in range(n)]
    return [(x + far * math.cos(a), y + far * math.sin(a)) for a, far in turns]


def inside(px, py, edges):
    """Brute force even-odd rule, boundary included; nothing holds a point that is not finite."""
    if not (math.isfinite(px) and math.isfinite(py)):
        return False
    odd = False
    for x1, y1, x2, y2 in edges:
        cross = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
        if cross == 0 and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
            return True
        if (y1 > py) != (y2 > py) and (cross > 0) == (y2 > y1):
            odd = not odd
    return odd


def test_bad_regions_are_refused():
    for make in (
        lambda: Region.from_bbox(2, 0, 1, 1), lambda: Region.from_bbox(0, 0, 1, 0),
        lambda: Region.from_polygon([(0, 0), (1, 1)]), lambda: Region.from_polygons([]),
        lambda: Region.from_polygon([(0, 0), (2, 2), (2, 0), (0, 3)]),
        lambda: Region.resolve(None, None), lambda: Region.resolve((0, 0, 1, 1), (0, 0, 1, 1)),
        lambda: Region.from_geojson({"type": "Point", "coordinates": [1, 2]}),
    ):
        with pytest.raises(ValueError):
            make()


def test_box_is_recognised():
    assert Region.from_bbox(0, 0, 2, 1).is_box
    assert Region.from_polygon([(0, 0), (1, 0), (2, 0), (2, 1), (0, 1), (0, 0)]).is_box
    assert not Region.from_polygon(TRIANGLE).is_box
    assert not Region.from_polygon([(0, 0), (3, 0), (3, 3), (0, 3)], [[(1, 1), (2, 1), (2, 2), (1, 2)]]).is_box


def test_keys_ignore_how_a_footprint_is_written(spark):
    box = Region.from_bbox(1, 2, 3, 4)
    same = [
        Region.from_polygon([(3, 4), (1, 4), (1, 2), (3, 2)]), Region.from_polygon([(1, 2), (1, 4), (3, 4), (3, 2), (1, 2)]),
        Region.from_polygon([(1 + 1e-9, 2), (3, 2 - 1e-9), (3, 4), (1, 4)]),
        Region.from_polygon([(1, 2), (1, 2), (3, 2), (3, 4), (1, 4)]),
    ]
    assert {r.key() for r in same} == {box.key()} != {Region.from_bbox(1, 2, 3, 5).key()}
    holed = Region.from_polygons([[[(0, 0), (9, 0), (9, 9), (0, 9)], [(5, 5), (6, 5), (6, 6)], [(1, 1), (2, 1), (2, 2)]],
                                  [[(20, 0), (21, 0), (21, 1)]]])
    for region in [box, *same, Region.from_polygon(TRIANGLE), holed]:
        got = spark.range(1).select(region_key(region_shape(region)).alias("k"), is_box(region_shape(region)).alias("b")).first()
        assert (got["k"], got["b"]) == (region.key(), region.is_box)


def test_validity_column(spark):
    shapes = {
        "ok": [[TRIANGLE]], "bow": [[[(0, 0), (2, 2), (2, 0), (0, 3)]]], "flat": [[[(0, 0), (1, 1), (2, 2)]]],
        "none": [], "closed": [[[(0, 0), (1, 0), (1, 1), (0, 0)]]],
    }
    data = [(k, [[[{"x": float(x), "y": float(y)} for x, y in r] for r in p] for p in v]) for k, v in shapes.items()]
    df = spark.createDataFrame(data, f"k string, shape {SHAPE_TYPE}")
    got = {r["k"]: r["region_valid"] for r in with_validity(df).collect()}
    assert got == {"ok": True, "bow": False, "flat": False, "none": False, "closed": True}


def test_edges_corners_and_null_points(spark):
    points = spark.createDataFrame(
        [("edge", 143.0, -35.0), ("corner", 144.0, -34.0), ("out", 144.0001, -34.0), ("null", None, -35.0), ("nan", float("nan"), -35.0)],
        "k string, longitude double, latitude double")
    assert rows(in_region(points, Region.from_bbox(143, -36, 144, -34)).select("k")) == [("corner",), ("edge",)]


def points_and_polygons(spark, seed=3, n=1500):
    rng = random.Random(seed)
    polygons, edges = [], {}
    for i in range(12):
        x, y = rng.uniform(140, 150), rng.uniform(-39, -30)
        region = Region.from_polygons([[star(rng, x, y, rng.randint(3, 90), rng.uniform(0.2, 3))]])
        polygons.append((i, region.shape()))
        edges[i] = region.edges
    holed = Region.from_polygon([(141, -38), (149, -38), (149, -31), (141, -31)], [[(143, -36), (146, -36), (146, -33), (143, -33)]])
    box = Region.from_bbox(144.5, -35.5, 146, -34)
    for i, region in ((100, holed), (101, box)):
        polygons.append((i, region.shape()))
        edges[i] = region.edges
    # a third of the points in one spot, some on grid lines, vertices and edges
    points = [(i, 145.25, -34.75) for i in range(n // 3)]
    points += [(10_000 + i, rng.uniform(139, 151), rng.uniform(-40, -29)) for i in range(n)]
    points += [(20_000 + i, rng.randrange(280, 300) / 2, rng.randrange(-78, -60) / 2) for i in range(n // 2)]
    points += [(30_004, float("inf"), -34.0), (30_005, float("nan"), -34.0)]
    points += [(30_000, *edges[0][0][:2]), (30_001, 143.0, -34.0), (30_002, 141.0, -38.0), (30_003, None, None)]
    expected = sorted((p, i) for p, x, y in points if x is not None for i, e in edges.items() if inside(x, y, e))
    return (spark.createDataFrame(points, "p int, longitude double, latitude double"),
            spark.createDataFrame(polygons, f"poly int, shape {SHAPE_TYPE}"), expected)


@pytest.mark.parametrize("options", [{}, {"limit": 0}, {"limit": 0, "hot_rows": 100}, {"cell": 3.0}, {"cell": 0.1}])
def test_grid_join_equals_brute_force(spark, options):
    points, polygons, expected = points_and_polygons(spark)
    got = points_in_polygons(points, polygons, **options).select("p", "poly")
    assert sorted(map(tuple, got.collect())) == expected


def test_carried_text_counts_against_the_broadcast(spark):
    points, polygons, expected = points_and_polygons(spark)
    wide = polygons.withColumn("note", F.repeat(F.lit("x"), 20_000)).withColumn("tags", F.array(F.lit(1)))
    for carried, options in (("note", {"limit": 3_000_000}), ("note", {"limit": 3_000_000, "hot_rows": 100}), ("tags", {})):
        got = points_in_polygons(points, wide.select("poly", "shape", carried), **options)
        assert sorted(tuple(r)[:2] for r in got.select("p", "poly").collect()) == expected
        final = got._jdf.queryExecution().optimizedPlan().toString()
        assert "strategy=merge" in final
    narrow = points_in_polygons(points, wide.select("poly", "shape"), limit=3_000_000)
    assert "strategy=broadcast" in narrow._jdf.queryExecution().optimizedPlan().toString()


def test_one_polygon_inline_and_large(spark):
    points, _, _ = points_and_polygons(spark)
    rng = random.Random(5)
    for n in (5, 400):
        region = Region.from_polygon(star(rng, 145, -35, n, 4))
        want = sorted(r["p"] for r in points.collect() if r["longitude"] is not None and inside(r["longitude"], r["latitude"], region.edges))
        assert sorted(r["p"] for r in in_region(points, region).collect()) == want
        direct = points.where(point_in_parts(F.col("longitude"), F.col("latitude"), part_edges(region_shape(region)))) if n == 5 else None
        assert direct is None or sorted(r["p"] for r in direct.collect()) == want


def test_polygon_meets_region(spark):
    ring = lambda *p: [{"x": float(x), "y": float(y)} for x, y in p]
    square = lambda x, y, s: ring((x, y), (x + s, y), (x + s, y + s), (x, y + s))
    shapes = {
        "inside": [[square(1, 1, 1)]], "around": [[square(-5, -5, 20)]], "cross": [[ring((-1, 2), (6, 2), (6, 3), (-1, 3))]],
        "touch": [[square(4, 4, 2)]], "apart": [[square(10, 10, 1)]],
        "hole_around": [[square(-5, -5, 20), square(-1, -1, 6)]], "second_part": [[square(30, 30, 1)], [square(2, 2, 1)]],
    }
    df = spark.createDataFrame(list(shapes.items()), f"k string, shape {SHAPE_TYPE}")
    region = Region.from_bbox(0, 0, 4, 4)
    got = {r["k"] for r in polygons_in_region(df, region_shape(region), region.bounds).collect()}
    assert got == {"inside", "around", "cross", "touch", "second_part"}
    assert {r["k"] for r in polygons_in_region(df, region).collect()} == got


def test_stray_holes_and_overlapping_parts_are_rejected():
    square = [(0, 0), (10, 0), (10, 10), (0, 10)]
    far, inner = [(20, 20), (21, 20), (21, 21)], [(2, 2), (4, 2), (4, 4), (2, 4)]
    for holes in ([far], [square], [inner, [(3, 3), (5, 3), (5, 5)]], [[(5, 5), (15, 5), (15, 6)]]):
        with pytest.raises(ValueError):
            Region.from_polygon(square, holes)
    for other in (inner, square, [(5, 5), (15, 5), (15, 15)]):
        with pytest.raises(ValueError):
            Region.from_polygons([[square], [other]])
    Region.from_polygon(square, [inner])
    Region.from_polygons([[square], [far]])
    Region.from_polygons([[square], [[(10, 0), (20, 0), (20, 10), (10, 10)]]])  # a shared side is no overlap
    Region.from_polygons([[square, inner], [[(2.5, 2.5), (3.5, 2.5), (3.5, 3.5)]]])  # an island in a hole


def square(x, y, s):
    return [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]


def shapes_frame(spark, shapes, name="k string"):
    data = [(k, None if v is None else [[[{"x": float(x), "y": float(y)} for x, y in r] for r in p] for p in v]) for k, v in shapes.items()]
    return spark.createDataFrame(data, f"{name}, shape {SHAPE_TYPE}")


def is_valid(polygons):
    try:
        Region.from_polygons(polygons)
    except ValueError:
        return False
    return True


BIG, INNER = square(0, 0, 10), square(2, 2, 4)
CASES = {
    "hole": ([[BIG, INNER]], True), "stray hole": ([[BIG, square(20, 20, 1)]], False), "hole is shell": ([[BIG, BIG]], False),
    "hole crosses shell": ([[BIG, square(8, 8, 4)]], False), "hole shares a side": ([[BIG, square(0, 2, 4)]], True),
    "holes overlap": ([[BIG, INNER, square(3, 3, 4)]], False), "holes touch at a corner": ([[BIG, square(1, 1, 2), square(3, 3, 2)]], True),
    "hole in hole": ([[BIG, INNER, square(3, 3, 1)]], False), "equal holes": ([[BIG, INNER, INNER]], False),
    "parts apart": ([[BIG], [square(20, 0, 5)]], True), "parts overlap": ([[BIG], [square(5, 5, 10)]], False),
    "part in part": ([[BIG], [INNER]], False), "parts equal": ([[BIG], [BIG]], False), "parts share a side": ([[BIG], [square(10, 0, 10)]], True),
    "parts share part of a side": ([[BIG], [square(10, 3, 4)]], True), "island in a hole": ([[BIG, INNER], [square(3, 3, 1)]], True),
    "island fills the hole": ([[BIG, INNER], [INNER]], True), "island leaves the hole": ([[BIG, INNER], [square(5, 5, 2)]], False),
    "spike": ([[[(0, 0), (4, 0), (8, 0), (6, 0), (6, 5), (0, 5)]]], False), "touches itself": ([[[(0, 0), (8, 0), (4, 4), (8, 8), (0, 8), (4, 4)]]], False),
    "through a corner": ([[BIG, [(0, 0), (12, 12), (0, 12)]]], False), "cross without corners inside": ([[BIG], [[(-1, 4), (11, 4), (11, 6), (-1, 6)]]], False),
    "repeated vertices": ([[[(0, 0), (0, 0), (5, 0), (5, 5), (5, 5), (0, 0)]]], True), "beyond the globe": ([[square(1000, 0, 1)]], False),
    "in two cuts of a side": ([[[(0, 0), (9, 0), (6, 3), (9, 6), (0, 6)], [(1, 1), (6, 3), (1, 5)]]], True),
}


def test_validity_of_holes_and_parts_on_tables_and_driver(spark):
    df = shapes_frame(spark, {**{k: v for k, (v, _) in CASES.items()}, "null": None, "no rings": [[]]}).repartition(4)
    assert df.columns + ["region_valid"] == with_validity(df).columns
    got = {r["k"]: r["region_valid"] for r in with_validity(df).collect()}
    assert got == {**{k: v for k, (_, v) in CASES.items()}, "null": False, "no rings": False}
    for k, (shape, valid) in CASES.items():
        assert is_valid(shape) == valid, k
    assert with_validity(df.where("false")).collect() == []


def test_random_regions_are_judged_alike(spark):
    rng = random.Random(8)
    shapes = {}
    for i in range(120):
        some = lambda: (square(rng.randrange(8), rng.randrange(8), rng.randrange(1, 6)) if rng.random() < 0.6
                        else [(rng.randrange(9), rng.randrange(9)) for _ in range(rng.randrange(3, 6))])
        shapes[i] = [[some() for _ in range(rng.choice([1, 1, 2, 3]))] for _ in range(rng.choice([1, 1, 2, 3]))]
    got = {r["k"]: r["region_valid"] for r in with_validity(shapes_frame(spark, shapes, "k int")).collect()}
    assert got == {i: is_valid(v) for i, v in shapes.items()} and 5 < sum(got.values()) < 100


def test_validity_of_long_rings(spark):
    rng = random.Random(2)
    coast = star(rng, 145, -30, 10_000, 5)
    comb = [p for i in range(5000) for p in ((i * 0.001, 0.0), (i * 0.001 + 0.0005, 9.0))] + [(5.1, -1.0), (-0.1, -1.0)]
    crossed = [*coast[:5000], (165.0, -29.99), *coast[5001:]]  # out through the other side
    shapes = {"coast": [[coast]], "comb": [[comb]], "crossed": [[crossed]], "islands": [[square(i % 100, i // 100, 0.5)] for i in range(2500)]}
    want = {"coast": True, "comb": True, "crossed": False, "islands": True}
    for k, shape in shapes.items():
        began = time.perf_counter()
        assert is_valid(shape) == want[k] and time.perf_counter() - began < 8, k
    began = time.perf_counter()
    assert {r["k"]: r["region_valid"] for r in with_validity(shapes_frame(spark, shapes)).collect()} == want
    assert time.perf_counter() - began < 40


def test_points_in_parts_equal_brute_force(spark):
    """Polygons that overlap, holes that do, holes astray, and islands in holes."""
    rng = random.Random(6)
    shapes, points = {}, [(i, rng.randrange(0, 60) / 4, rng.randrange(0, 60) / 4) for i in range(600)]
    for i in range(40):
        shapes[i] = [[square(rng.randrange(9), rng.randrange(9), rng.randrange(1, 7)) for _ in range(rng.choice([1, 2, 3]))] for _ in range(rng.choice([1, 2, 3]))]
    shapes[40] = [[square(0, 0, 15), square(2, 2, 10)], [square(4, 4, 3)]]

    def strictly(x, y, ring):
        (a, b), (c, d) = ring[0], ring[2]
        return a < x < c and b < y < d

    def holds(x, y, polygons):
        return any(inside(x, y, list(zip(*zip(*s), strict=True)) and [(*p, *q) for p, q in zip(s, s[1:] + s[:1], strict=True)])
                   and not any(strictly(x, y, h) for h in holes) for s, *holes in polygons)

    want = sorted((p, i) for p, x, y in points for i, s in shapes.items() if holds(x, y, s))
    df = spark.createDataFrame(points, "p int, longitude double, latitude double")
    polygons = shapes_frame(spark, shapes, "poly int")
    for options in ({}, {"limit": 0}, {"cell": 4.0}, {"cell": 0.7}):
        assert sorted(map(tuple, points_in_polygons(df, polygons, **options).select("p", "poly").collect())) == want
    semi = points_in_polygons(df, polygons, how="left_semi")
    assert sorted(r.p for r in semi.collect()) == sorted({p for p, _ in want})
    region = Region(tuple(tuple(tuple(map(tuple, r)) for r in p) for p in shapes[40]))
    assert sorted(r.p for r in in_region(df, region).collect()) == sorted(p for p, i in want if i == 40)


def test_small_polygons_in_one_coarse_cell(spark):
    """A hundred thousand small squares share a half-degree cell; a point meets those of its fine cell."""
    side = 0.5 / 400
    polygons = spark.range(100_000).selectExpr("id AS poly", f"145 + {side} * (id % 316) AS x", f"-35 + {side} * floor(id / 316) AS y")
    corner = lambda dx, dy: F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
    far = side * 0.9
    shape = F.array(F.array(F.array(corner(0, 0), corner(far, 0), corner(far * 0.9, far), corner(0, far))))
    large = shapes_frame(spark, {-1: [[square(144, -36, 3)]]}, "poly bigint")
    polygons = polygons.select("poly", shape.alias("shape")).unionByName(large)
    points = spark.range(2000).selectExpr("id AS p", f"145 + {side} * (id % 300 + 0.5) AS longitude", f"-35 + {side} * (id % 310 + 0.5) AS latitude")
    cells = cut_to_cells(polygons).where("poly >= 0").groupBy("_level", "_cell_x", "_cell_y").count()
    most = cells.agg(F.max("count"), F.count("*")).first()
    assert most[0] <= 16 and most[1] > 20_000
    found = points_in_polygons(points, polygons)
    assert found.where("poly = -1").count() == 2000 and found.where("poly >= 0").count() == 2000
    assert points_in_polygons(points, polygons, how="left_semi").count() == 2000


def test_polygons_meet_a_large_region(spark):
    """The index of a region's edges gives the rows of a comparison with all of them, and plans at once."""
    rng = random.Random(12)
    shapes = {i: [[star(rng, rng.uniform(138, 152), rng.uniform(-41, -28), rng.randint(3, 12), rng.uniform(0.05, 2))]] for i in range(150)}
    shapes |= {200 + i: [[square(rng.randrange(136, 152), rng.randrange(-42, -28), rng.randint(1, 3))]] for i in range(40)}
    shapes[300] = [[square(100, -80, 90)]]
    df = shapes_frame(spark, shapes, "k int").cache()
    holed = Region.from_polygons([[star(rng, 145, -35, 400, 5), square(144.8, -35.2, 0.4)], [square(155, -35, 1)]])
    for region in (holed, Region.from_bbox(143, -37, 147, -33), Region.from_polygon(TRIANGLE)):
        whole = {r.k for r in polygons_in_region(df, region_shape(region), region.bounds).collect()}
        assert {r.k for r in polygons_in_region(df, region).collect()} == whole and 300 in whole
    large = Region.from_polygon(star(rng, 145, -35, 5000, 5))
    began = time.perf_counter()
    found = polygons_in_region(df, large)
    found._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - began < 3
    assert 10 < found.count() < 191


def test_work_of_many_polygons_is_dealt_over_tasks(spark):
    """Many polygons of one task are cut by several; a few stay where they are."""
    shapes = spark.range(0, 4500, 1, 1).select("id")
    assert over_tasks(shapes).rdd.getNumPartitions() == 3 and rows(over_tasks(shapes)) == rows(shapes)
    assert over_tasks(shapes.limit(50)).rdd.getNumPartitions() == 1
    many = spread_join(shapes.withColumn("k", F.col("id") % 9), shapes.withColumnRenamed("id", "k"), ["k"], limit=0, hint="merge", tasks=7)
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2 and "ENSURE_REQUIREMENTS" not in plan
    assert many.count() == 4500
