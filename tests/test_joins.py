import random

import pytest
from pyspark.sql import functions as F

from borelake.operators import compilation, federation, filters, hot_keys, joins, mapping, ordinal, summary
from borelake.operators.hot_keys import flat_bytes, spread_join

from .conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """Logs of which a third share one key, a third have none, and the rest are spread."""
    rng = random.Random(1)
    logs = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{rng.randint(0, 60)}"
        logs.append((i, key, float(i)))
    headers = [(1, "hot", "h1"), (2, "hot", "h2"), (3, None, "n")] + [(10 + i, f"k{i}", f"x{i}") for i in range(0, 80, 2)]
    return (spark.createDataFrame(logs, "row_no long, code string, depth double"),
            spark.createDataFrame(headers, "h long, code string, name string"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_is_the_plain_join(spark, skewed, how):
    logs, headers = skewed
    right = headers if how in ("inner", "left") else headers.select("code").distinct()
    expected = rows(logs.join(right, "code", how))
    for options in ({}, {"limit": 0}, {"limit": 0, "hot_rows": 100}, {"limit": 0, "hot_rows": 10}):
        got = spread_join(logs, right, ["code"], how, **options)
        assert got.columns == logs.join(right, "code", how).columns
        assert rows(got) == expected, options


def test_hot_key_really_is_spread(spark, skewed):
    logs, headers = skewed
    joined = spread_join(logs, headers, ["code"], limit=0, hot_rows=100)
    assert "_salt" in joined._jdf.queryExecution().executedPlan().toString()
    per_task = joined.where("code = 'hot'").groupBy(F.spark_partition_id()).count()
    assert joined.count() == logs.join(headers, "code").count()
    # the hot rows of one key lie in several partitions of the join, whatever adaptive execution merges
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert per_task.count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_many_hot_keys_are_not_broadcast(spark, skewed, how, monkeypatch):
    logs, headers = skewed
    right = headers.select("code").distinct() if how == "left_anti" else headers
    monkeypatch.setattr(hot_keys, "flat_bytes", lambda df: float("inf"))
    monkeypatch.setattr(hot_keys, "KEY_SPREAD", 3)
    got = spread_join(logs, right, ["code"], how, hot_rows=10, hint="merge")
    assert rows(got) == rows(logs.join(right, "code", how))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "_deal" in plan


def test_flat_bytes_bounds_plain_tables_only(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "s string, n int")
    assert flat_bytes(df) == 2 * 16 * 3 + 3
    assert flat_bytes(df.withColumn("a", F.array("n"))) == float("inf")


def test_last_bore_row_gives_the_position_even_a_null_one(spark):
    bores = spark.createDataFrame(
        [(1, "A", 1.0, 1.0), (2, "A", None, 2.0), (3, "B", 5.0, 6.0), (4, None, 9.0, 9.0)],
        "row_no long, HydroCode string, Longitude double, Latitude double")
    logs = spark.createDataFrame([(1, "A"), (2, "B"), (3, "Z"), (4, None)], "row_no long, HydroCode string")
    got = joins.with_bore_position(logs, bores)
    assert rows(got) == [(1, "A", None, 2.0), (2, "B", 5.0, 6.0), (3, "Z", None, None), (4, None, None, None)]


def small(spark):
    bores = spark.createDataFrame(
        [(1, "A", "one", 140.0, -35.0, 50.0, None), (2, "A", "two", 140.1, -35.0, None, 30.0), (3, " B ", None, 141.0, -35.0, None, None)],
        "row_no long, HydroCode string, StateBoreID string, Longitude double, Latitude double, BoreDepth double, RefElev double")
    logs = spark.createDataFrame(
        [(1, "A", 0.0, 5.0, 100.0), (2, "A", 5.0, 9.0, None), (3, "B", 0.0, 7.0, 10.0), (4, " B ", 0.0, 99.0, 10.0), (5, None, 0.0, 1.0, 1.0)],
        "row_no long, HydroCode string, FromDepth double, ToDepth double, RefElev double")
    return mapping.state_headers(bores, "NGIS:NSW"), mapping.state_logs(logs, "stratigraphy")


def test_padded_log_code_drops_out_and_duplicate_headers_fan_out(spark):
    headers, logs = small(spark)
    out = joins.export_logs(headers, logs, "stratigraphy")
    got = sorted((r["borehole_name"], r["longitude"], r["bottom_depth_m"]) for r in out.collect())
    assert got == [("A", 140.0, 5.0), ("A", 140.0, 9.0), ("A", 140.1, 5.0), ("A", 140.1, 9.0), ("B", 141.0, 7.0)]
    assert {r["source"] for r in out.collect()} == {"NGIS:NSW"}


def test_total_depth_and_compilation(spark):
    headers, logs = small(spark)
    depths = {r["row_no"]: r["total_depth_m"] for r in summary.with_total_depth(headers, logs).collect()}
    assert depths == {1: 50.0, 2: 9.0, 3: 7.0}
    units = compilation.units_compilation(headers, logs).orderBy("OBJECTID").collect()
    assert units[0].__fields__ == list(compilation.UNIT_COLUMNS)
    assert [r["OBJECTID"] for r in units] == [1, 2, 3, 4, 5]
    assert [(r["UWI"], r["TOP_AHD_M"], r["TD_MD_M"]) for r in units] == [
        ("A", 100.0, 50.0), ("A", None, 50.0), ("A", 100.0, 9.0), ("A", None, 9.0), ("B", 10.0, 7.0)]


def test_counts_keep_bores_apart_and_percentile_interpolates(spark):
    headers, logs = small(spark)
    counts = {r["row_no"]: r["n_intervals"] for r in summary.interval_counts(headers, logs, keep_empty=True).collect()}
    assert counts == {1: 2, 2: 2, 3: 1}
    df = spark.createDataFrame([(1,), (2,), (3,), (10,)], "n_intervals long")
    assert abs(summary.interval_percentile(df).first()["p"] - 9.58) < 1e-9


def test_unknown_kind(spark):
    headers, logs = small(spark)
    with pytest.raises(ValueError):
        joins.export_logs(headers, logs, "water")
    with pytest.raises(ValueError):
        mapping.state_logs(logs, "water")


def test_logs_without_key_column_pass_through(spark):
    headers, _ = small(spark)
    assert joins.logs_of(spark.range(3), headers).count() == 3


def test_ordinals_are_dense_and_restart(spark):
    rng = random.Random(2)
    data = [("big" if rng.random() < 0.6 else f"g{rng.randint(0, 9)}", i * 7 % 5003) for i in range(5000)]
    df = spark.createDataFrame(data, "g string, v int")
    everything = [r["ordinal"] for r in ordinal.with_ordinal(df, ["v", "g"]).orderBy("v", "g").collect()]
    assert everything == list(range(1, 5001))
    seen = {}
    for r in ordinal.with_ordinal(df, ["v"], ["g"]).orderBy("g", "v").collect():
        seen[r["g"]] = seen.get(r["g"], 0) + 1
        assert r["ordinal"] == seen[r["g"]]


def test_ordinals_with_many_groups(spark):
    df = spark.createDataFrame([(f"g{i % 11}" if i % 11 else None, i) for i in range(500)], "g string, v int")
    got = ordinal.with_ordinal(df, ["v"], ["g"])
    assert all(r["ordinal"] == r["v"] // 11 + 1 for r in got.collect()) and got.count() == 500


@pytest.mark.parametrize("in_code", [31, 0])
def test_ordinals_are_numbered_by_counts_of_ranges(spark, monkeypatch, in_code):
    """One group of half the rows, null groups, and text keys; only keys are written, no row is sorted globally."""
    monkeypatch.setattr(ordinal, "IN_CODE", in_code)
    rows = [(None if i % 50 == 0 else "big" if i % 2 else f"g{i % 30}", f"k{(i * 7919) % 4000:05d}", i, "wide " * 10) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, k string, v bigint, note string").repartition(5)
    got = ordinal.with_ordinal(df, ["k", "v"], ["g"])
    seen = {}
    for g, k, v, _ in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        seen[v] = seen[g, "n"] = seen.get((g, "n"), 0) + 1
    assert {r["v"]: r["ordinal"] for r in got.collect()} == {v: seen[v] for *_, v, _ in rows}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "_group" in plan


def test_row_of_a_rank_is_found_without_a_sort(spark, monkeypatch):
    monkeypatch.setattr(ordinal, "SORTED_ROWS", 50)
    df = spark.range(3000).selectExpr("(id * 7919) % 3000 AS v", "id % 3 AS g", "'x' AS note").repartition(4)
    for i in (0, 1, 1499, 2999, -1, -3000):
        assert [r.v for r in filters.at_position(df, i, ["v"]).collect()] == [i % 3000]
    for i in (3000, -3001):
        assert filters.at_position(df, i, ["v"]).collect() == []
    plan = filters.at_position(df, 17, ["g", "v"])._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan
    same = spark.createDataFrame([(1,)] * 200, "v int")
    assert ordinal.key_at(same, 150, ["v"]) == {"v": 1}


def test_row_of_a_range_is_found_by_its_cuts_alone(spark, monkeypatch):
    """A range that is cut again is read by two comparisons, not by all steps of the search for a range."""
    monkeypatch.setattr(ordinal, "SORTED_ROWS", 200)
    plans, plain = [], ordinal.Cuts

    def seen(keys, *more):
        plans.append(keys._jdf.queryExecution().optimizedPlan().toString())
        return plain(keys, *more)

    monkeypatch.setattr(ordinal, "Cuts", seen)
    value = F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 6007)  # nulls first, few equal
    df = spark.range(0, 18000, 1, 4).select(value.alias("g"), F.col("id").alias("v"))
    expected = sorted(((r.g, r.v) for r in df.collect()), key=lambda r: (r[0] is not None, r))
    monkeypatch.setattr(ordinal, "_ranges", lambda df: 40)
    for at in (0, 1300, 2600, 9001, -1):
        assert ordinal.key_at(df, at, ["g", "v"]) == dict(zip("gv", expected[at]))
    assert len(plans) > 5  # some ranges were cut again
    assert all("_cut_" not in p and len(p) < 5000 for p in plans)


def test_long_logs_continue_in_parts(spark):
    logs = spark.createDataFrame(
        [(i, "hot" if i % 2 else f"k{i % 10}", float(i)) for i in range(1000)], "row_no long, bore_key string, d double")
    lists = ordinal.interval_lists(logs, limit=120).collect()
    hot = sorted((r for r in lists if r["bore_key"] == "hot"), key=lambda r: r["part"])
    assert [r["n"] for r in hot] == [120, 120, 120, 120, 20]
    assert [i["row_no"] for r in hot for i in r["intervals"]] == list(range(1, 1000, 2))
    assert sum(r["n"] for r in lists) == 1000 and max(r["n"] for r in lists) <= 120


def test_sources(spark):
    assert filters.source_tags(None) == ["GA", "NGIS:NSW", "NGIS:VIC", "NGIS:QLD"]
    assert filters.source_tags("ngis:nsw") == filters.source_tags(["NSW"]) == ["NGIS:NSW"]
    assert filters.source_tags([" ga ", "NGIS"], ["VIC"]) == ["GA", "NGIS:VIC"]


def test_positions_count_from_either_end(spark):
    df = spark.createDataFrame([(10, "a"), (30, "c"), (20, "b")], "row_no long, name string")
    got = {i: [r["name"] for r in filters.at_position(df, i).collect()] for i in (0, 2, 3, -1, -3, -4)}
    assert got == {0: ["a"], 2: ["c"], 3: [], -1: ["c"], -3: ["a"], -4: []}


def test_single_header_identifier(spark):
    headers = mapping.national_headers(spark.createDataFrame([(7, "x"), (8, "y")], "eno long, name string"))
    for identifier in (7, " 7 ", "http://pid.example/BH7"):
        assert filters.single_header(headers, identifier).first()["name"] == "x"
    with pytest.raises(ValueError):
        filters.single_header(headers, "Well 7")


def test_citation_once_per_source_in_order(spark):
    rows_ = [(1, 1, "B.", 0.0, None, None), (1, 0, "A.", 86400.0, "L", "u"), (1, 2, "B.", None, None, None), (2, 0, None, None, "", "")]
    df = spark.createDataFrame(rows_, "q int, source_ord int, citation string, fetched_at double, license string, source_url string")
    got = dict(map(tuple, federation.federated_citation(df, "q").collect()))
    assert got == {1: "A. Accessed 1970-01-02. Licensed L. Source: u B.", 2: "Geoscience Australia borehole data."}


def test_logs_of_many_regions_are_read_once(spark, tmp_path):
    """A bore in several regions, one in none, regions without bores; the plan scans the logs once."""
    from borelake.functions.geometry import SHAPE_TYPE

    ring = lambda x, y, s: [{"x": float(a), "y": float(b)} for a, b in ((x, y), (x + s, y), (x + s, y + s), (x, y + s))]
    regions = spark.createDataFrame([(1, [[ring(0, 0, 4)]]), (2, [[ring(1, 1, 2)]]), (3, [[ring(50, 50, 1)]])], f"region int, shape {SHAPE_TYPE}")
    headers = spark.createDataFrame(
        [("S", "a", 1, "A", 2.0, 2.0), ("S", "b", 2, "B", 0.5, 0.5), ("S", "c", 3, "C", 9.0, 9.0), ("S", "a", 4, "A2", 0.2, 0.2)],
        "source string, bore_key string, row_no bigint, name string, longitude double, latitude double")
    raw = spark.createDataFrame(
        [(i, k, float(i), float(i + 1)) for i, k in enumerate("aabbca")], "row_no bigint, HydroCode string, FromDepth double, ToDepth double")
    raw.write.parquet(str(tmp_path / "logs"))
    logs = mapping.state_logs(spark.read.parquet(str(tmp_path / "logs")), "stratigraphy")
    found = joins.logs_in_regions(headers, logs, regions, "region", "stratigraphy")
    got = sorted((r.region, r.longitude, r.top_depth_m) for r in found.collect())
    want = [(g, x, t) for g, x, ts in ((1, 2.0, (0, 1, 5)), (1, 0.5, (2, 3)), (1, 0.2, (0, 1, 5)), (2, 2.0, (0, 1, 5))) for t in ts]
    assert got == sorted(want)
    assert found._jdf.queryExecution().executedPlan().toString().count("HydroCode") and str(
        found._jdf.queryExecution().optimizedPlan()).count("Relation [row_no") == 1


def test_order_of_an_interval_table(spark):
    headers = spark.createDataFrame([("S", "a", 7, "A", 2.0, 2.0)], "source string, bore_key string, row_no bigint, name string, longitude double, latitude double")
    raw = spark.createDataFrame([(3, "a", 1.0, 2.0), (9, "a", 0.0, 1.0)], "row_no bigint, HydroCode string, FromDepth double, ToDepth double")
    found = joins.in_query_order(headers, mapping.state_logs(raw, "stratigraphy"), "stratigraphy")
    assert found.columns[-3:] == ["source_ord", "bore_row_no", "log_row_no"]
    assert [(r.source_ord, r.bore_row_no, r.log_row_no) for r in found.orderBy(*found.columns[-3:]).collect()] == [(0, 7, 3), (0, 7, 9)]


def test_predicate_on_a_property_without_a_column(spark):
    raw = spark.createDataFrame(
        [(1, "12.5", '{"owner":"Shire","depth":"30"}'), (2, "x", '{"owner":"Farm"}'), (3, None, None)],
        "eno int, elevation_m string, source_attributes string")
    owner = "get_json_object(source_attributes, '$.owner')"
    assert [r.eno for r in filters.by_attribute(raw, f"{owner} = 'Shire' AND elevation_m > 4").collect()] == [1]
    assert [r.eno for r in filters.by_attribute(raw, f"{owner} IS NULL").collect()] == [3]
    assert filters.by_attribute(raw, "elevation_m > 4").columns == raw.columns


def test_many_cuts_are_halved_in_generated_code(spark, monkeypatch):
    monkeypatch.setattr(ordinal, "IN_CODE", 3)
    days = [(None if i % 7 == 0 else f"k{i % 5}", None if i % 11 == 0 else i * 13 % 97, i) for i in range(400)]
    df = spark.createDataFrame(days, "k string, d int, i long").withColumn("day", F.date_add(F.lit("2020-01-30").cast("date"), F.col("d")))
    cuts = ordinal.Cuts(df, ["k", "day"], 23)
    assert len(cuts.places) > 8
    ranged = cuts.with_range(df)
    assert ranged.columns == [*df.columns, "_range"]
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "filter(" not in plan
    least = lambda value: (value is not None, value or "")
    key = lambda k, day: (k is not None, k or "", day is not None, str(day))
    places = [key(*p) for p in cuts.places]
    for row in ranged.collect():
        assert row["_range"] == sum(p <= key(row["k"], row["day"]) for p in places)
    got = ordinal.with_ordinal(df, ["day", "i"], ["k"], "n").collect()
    for k in {row["k"] for row in got}:
        mine = sorted((row for row in got if row["k"] == k), key=lambda row: (*least(row["day"] and str(row["day"])), row["i"]))
        assert [row["n"] for row in mine] == list(range(1, len(mine) + 1))
