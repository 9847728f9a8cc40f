import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from borelake import AllBores, NationalBores, Region, SnapshotStore, StateBores, build_national, build_state
from borelake.operators import contracts, mapping
from borelake.schema import HEADER_COLUMNS, LOG_KINDS, export_columns
from borelake.sources import landed, registry, sinks, snapshot
from borelake.operators import joins
from borelake.sources.artifacts import check_artifacts
from borelake.sources.registry import StateSource

from .conftest import rows

BOX = (143.0, -36.0, 144.0, -34.0)
NOW = 1_700_000_000.0


def land_state(spark, root, state="NSW", shift=0.0, logs=True):
    bores = [(1, "IN", 143.5 + shift, -35.0, 100.0, "P1", 40.0), (2, "EDGE", 144.0, -34.0, None, "P2", None),
             (3, "OUT", 150.0, -30.0, 5.0, "P3", None), (4, "DRY", 143.1, -35.9, 5.0, "P4", None)]
    spark.createDataFrame(bores, "OBJECTID long, HydroCode string, Longitude double, Latitude double, RefElev double, StateBoreID string, BoreDepth double") \
        .write.parquet(f"{root}/{state}/NGIS_Bore")
    if logs:
        strat = [("IN", "Sand", 0.0, 5.0), ("IN", "Unknown", 5.0, 9.0), ("IN", "Unknown", 9.0, 5.0), ("EDGE", "Clay", None, 3.0), ("ORPHAN", "Clay", 0.0, 1.0)]
        spark.createDataFrame(strat, "HydroCode string, Description string, FromDepth double, ToDepth double") \
            .coalesce(1).write.parquet(f"{root}/{state}/NGIS_BoreholeLog")
        spark.createDataFrame([(1, "IN", "Casing", "PVC", 0.0, 4.0)], "OBJECTID int, HydroCode string, ConstructionType string, Material string, FromDepth double, ToDepth double") \
            .write.option("header", True).parquet(f"{root}/{state}/NGIS_ConstructionLog")


def page(path, features, announced):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        json.dump({"type": "FeatureCollection", "numberMatched": announced, "features": features}, out, indent=1)


def land_national(root):
    def header(eno, lon, lat, **more):
        return {"type": "Feature", "geometry": lon and {"type": "Point", "coordinates": [lon, lat]},
                "properties": {"eno": eno, "name": f"n{eno}", "identifier": f"http://pid.geoscience.gov.au/samplingFeature/au/BH{eno}", "drillingMethod": "Diamond", **more}}

    page(f"{root}/headers/p1.json", [header(1, 143.5, -35.0, elevation_m="12.5"), header(2, 150.0, -30.0)], 3)
    page(f"{root}/headers/p2.json", [header(3, None, None, GDA94_dlong=143.2, GDA94_dlat=-34.5, odd={"a": 1})], 3)
    log = [{"geometry": None, "properties": {"ENO": e, "INTERVAL_BEGIN_M": t, "INTERVAL_END_M": b, "STRAT_UNIT_NAME": u}}
           for e, t, b, u in ((1, "0", "5", "unknown"), (1, 5, 4, "X"), (3, 1.5, None, "Y"), (9, 0, 1, "Z"), ("null", 0, 1, "Z"))]
    page(f"{root}/stratigraphy/p1.json", log, 5)
    page(f"{root}/earth_material/p1.json", [{"geometry": None, "properties": {"ENO": 3, "INTERVAL_BEGIN_M": 0, "INTERVAL_END_M": 2, "LITHOLOGY": "sand"}}], 1)
    outer = [[142, -36], [145, -36], [145, -33], [142, -33], [142, -36]]
    hole = [[143, -35.5], [144, -35.5], [144, -34.2], [143, -34.2], [143, -35.5]]
    far = [[[150, -30], [151, -30], [151, -29], [150, -30]]]
    page(f"{root}/hydrogeology/p1.json", [
        {"geometry": {"type": "Polygon", "coordinates": [outer, hole]}, "properties": {"ufi": "u1", "prodty": "high", "feature": "f"}},
        {"geometry": {"type": "MultiPolygon", "coordinates": [far, [outer]]}, "properties": {"ufi": "u2", "prodty": "low"}},
        {"geometry": {"type": "Polygon", "coordinates": far}, "properties": {"ufi": "u3", "prodty": "low"}}], 3)


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landed"))
    land_state(spark, root)
    land_state(spark, root, "VIC", shift=0.1)
    land_national(f"{root}/ga")
    store = SnapshotStore(spark, str(tmp_path_factory.mktemp("store")))
    cores = {state: build_state(store, root, state, now=NOW) for state in ("NSW", "VIC")}
    national = build_national(store, f"{root}/ga", now=NOW)
    return root, store, cores, national


def queries(world):
    _, store, cores, national = world
    together = {layer: cores["NSW"][layer].unionByName(cores["VIC"][layer], allowMissingColumns=True) for layer in cores["NSW"]}
    states = StateBores(together["bores"], {k: together[k] for k in LOG_KINDS},
                        {f"NGIS:{s}": store.provenance(f"ngis-{s.lower()}-bores-opt1") for s in cores})
    ga = NationalBores(national["headers"], {k: national[k] for k in ("stratigraphy", "earth_material")},
                       national["hydrogeology"], store.provenance("ga-headers"))
    return ga, states, AllBores(ga, states)


def test_state_store_keeps_orphans_and_positions(world):
    strat = world[2]["NSW"]["stratigraphy"]
    got = {(r["HydroCode"], r["Longitude"]) for r in strat.collect()}
    assert got == {("IN", 143.5), ("EDGE", 144.0), ("ORPHAN", None)}
    assert world[2]["NSW"]["earth_material"].count() == 0
    assert sorted(r["row_no"] for r in strat.collect()) == [1, 2, 3, 4, 5]


def test_state_query(world):
    found = queries(world)[1].boreholes("nsw", bbox=BOX)
    assert sorted(r["identifier"] for r in found.headers.collect()) == ["DRY", "EDGE", "IN"]
    assert found.header_table().columns == list(HEADER_COLUMNS)
    strat = found.log_table("stratigraphy")
    assert strat.columns == list(export_columns("stratigraphy"))
    reasons = sorted((r["unit"], str(r["invalid_reason"])) for r in strat.collect())
    assert reasons == [("Clay", "missing depth"), ("Sand", "None"), ("Unknown", "inverted interval (top > bottom)"), ("Unknown", "unknown formation")]
    assert found.log_table("construction").count() == 1 and found.log_table("earth_material").count() == 0
    assert found.logs("stratigraphy").count() == 4
    lists = {r["bore_key"]: [i["unit"] for i in r["intervals"]] for r in found.interval_lists(10).collect()}
    assert lists == {"IN": ["Sand", "Unknown", "Unknown"], "EDGE": ["Clay"]}
    assert found.citation() == (
        "Bureau of Meteorology National Groundwater Information System (NGIS), NSW core, 2014-11 extract. "
        "Accessed 2023-11-14. Licensed CC BY 4.0. Source: https://data.gov.au/data/dataset/b0f37930-a810-4819-8fb6-8008538fa53b")
    with pytest.raises(ValueError):
        found.log_table("water")


def test_national_query(world):
    ga = queries(world)[0]
    found = ga.boreholes(bbox=BOX)
    assert sorted(r["eno"] for r in found.headers.collect()) == [1, 3]
    assert ga.boreholes(bbox=BOX, count_only=True) == found.count() == 2
    assert ga.boreholes(bbox=BOX, where="drillingMethod = 'Rotary'", count_only=True) == 0
    assert [r["eno"] for r in ga.borehole("http://pid.example/BH2").collect()] == [2]
    assert sorted((r["eno"], r["valid"]) for r in found.log_table().collect()) == [(1, False), (1, True), (3, False)]
    odd = [json.loads(r["source_attributes"]) for r in found.headers.where("eno = 3").collect()]
    assert odd[0]["odd"] == {"a": 1}
    triangle = Region.from_polygon([(143, -36), (144, -36), (143, -34)])
    assert ga.boreholes(triangle, count_only=True) == 2
    assert ga.boreholes(Region.from_polygon([(143, -36), (144, -36), (143, -34.9)]), refine="envelope", count_only=True) == 1
    assert ga.boreholes(Region.from_polygon([(143, -36), (144, -36), (143, -34.9)]), count_only=True) == 0
    assert sorted(r["row_no"] for r in world[3]["headers"].collect()) == [1, 2, 3]


def test_hydrogeology_with_holes_and_parts(world):
    ga = queries(world)[0]
    in_hole = (143.2, -35.2, 143.4, -34.9)
    assert rows(ga.hydrogeology(bbox=in_hole).select("ufi")) == [("u2",)]
    assert ga.hydrogeology(bbox=BOX, count_only=True) == 2
    assert rows(ga.hydrogeology(bbox=BOX, where="prodty = 'high'").select("ufi", "prodty")) == [("u1", "high")]
    bad = {r["check"]: r["n_failed"] for r in contracts.ring_sizes(ga.hydro).collect()}
    assert bad == {"rings_have_area": 0}


def test_federated_query(world):
    ga, states, everything = queries(world)
    found = everything.boreholes(bbox=BOX)
    assert {r["source"]: r["n"] for r in found.sources().collect()} == {"GA": 2, "NGIS:NSW": 3, "NGIS:VIC": 3}
    assert {r["source"] for r in found.log_table("construction").collect()} == {"NGIS:NSW", "NGIS:VIC"}
    per = {}
    for r in found.log_table("stratigraphy").collect():
        per[r["source"]] = per.get(r["source"], 0) + 1
    assert per == {"GA": 3, "NGIS:NSW": 4, "NGIS:VIC": 4}
    order = [r[0] for r in found.headers.select("source").distinct().join(found.headers.groupBy("source").agg(F.min("source_ord").alias("o")), "source").orderBy("o").collect()]
    assert order == ["GA", "NGIS:NSW", "NGIS:VIC"]
    assert found.citation().count("Accessed 2023-11-14.") == 3
    assert everything.boreholes(bbox=BOX, sources="GA").log_table("construction").count() == 0
    only = everything.boreholes(bbox=BOX, sources="NGIS:NSW")
    assert {r["source"] for r in only.headers.collect()} == {"NGIS:NSW"}
    assert everything.boreholes(bbox=(115, -33, 116, -32), sources="NGIS").count() == 0
    assert everything.boreholes(bbox=(151.0, -29.5, 152.0, -28.5)).count() == 0


def test_rebuild_only_when_stale(spark, world, tmp_path):
    root, _, _, _ = world
    store = SnapshotStore(spark, str(tmp_path))
    with pytest.raises(RuntimeError):
        build_state(store, root, "NSW", offline=True)
    build_state(store, root, "NSW", now=NOW)
    first = store.entry("ngis-nsw-bores-opt1")["entry"]
    build_state(store, root, "NSW", now=NOW + 5)
    assert store.entry("ngis-nsw-bores-opt1")["entry"] == first
    reissued = tuple(StateSource(s.state, s.vintage, s.dataset_url, s.zip_bytes, "other", s.min_lon, s.min_lat, s.max_lon, s.max_lat) for s in registry.STATE_SOURCES)
    assert build_state(store, root, "NSW", sources=reissued, offline=True)["bores"].count() == 4
    assert store.entry("ngis-nsw-bores-opt1")["entry"] == first
    build_state(store, root, "NSW", sources=reissued, now=NOW + 9)
    assert store.entry("ngis-nsw-bores-opt1")["entry"] != first
    with pytest.raises(ValueError):
        build_state(store, root, "TAS")


def test_missing_bore_layer_is_an_error(spark, tmp_path):
    with pytest.raises(RuntimeError):
        landed.read_state_core(spark, str(tmp_path), "NSW")


def test_csv_core(spark, tmp_path):
    spark.createDataFrame([(5, "A", "143.5", "-35", "none")], "OBJECTID int, HydroCode string, Longitude string, Latitude string, RefElev string") \
        .write.option("header", True).csv(f"{tmp_path}/NSW/NGIS_Bore")
    core = landed.read_state_core(spark, str(tmp_path), "nsw", "csv")
    row = mapping.state_headers(core["bores"], "NGIS:NSW").first()
    assert (row["row_no"], row["longitude"], row["elevation_m"]) == (5, 143.5, None)


def test_snapshot_decisions(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    assert store.get("k") is None and store.manifest().count() == 0
    built = []

    def build():
        built.append(1)
        return spark.range(4)

    ask = dict(build=build, now=NOW, provenance={"license": "L"})
    with pytest.raises(RuntimeError):
        store.get_or_build("k", offline=True, **ask)
    assert store.get_or_build("k", fingerprint="4", **ask).count() == 4 and len(built) == 1
    store.get_or_build("k", fingerprint="4", **ask)
    assert len(built) == 1
    store.get_or_build("k", fingerprint="5", **{**ask, "now": NOW + 1})
    assert len(built) == 2
    store.get_or_build("k", **{**ask, "now": NOW + 2})
    assert len(built) == 2
    month = snapshot.MAX_AGE_SECONDS
    store.get_or_build("k", **{**ask, "now": NOW + 1 + month})
    assert len(built) == 2, "exactly at the age limit is still fresh"
    store.get_or_build("k", **{**ask, "now": NOW + 2 + month})
    assert len(built) == 3
    store.get_or_build("k", offline=True, force=True, **{**ask, "now": NOW + 9 * month})
    assert len(built) == 3
    store.get_or_build("k", force=True, **{**ask, "now": NOW + 3 + month})
    assert len(built) == 4
    store.get_or_build("e", etag="a", **ask)
    store.get_or_build("e", etag="b", not_modified=True, **ask)
    assert len(built) == 5
    store.get_or_build("e", etag="b", **{**ask, "now": NOW + 1})
    assert len(built) == 6
    entry = store.provenance("k")
    assert (entry["feature_count"], entry["license"], entry["format_version"]) == (4, "L", 1)
    hashes = {r["content_hash"] for r in store.entries().where("key = 'k'").collect()}
    assert len(hashes) == 1
    totals = store.summary().first()
    assert (totals["entry_count"], totals["feature_count"]) == (2, 8) and totals["total_bytes"] > 0


def test_artifacts(spark, tmp_path):
    for state, content in (("NSW", b"a" * 100), ("VIC", b"b" * 50), ("QLD", b"c" * 10)):
        os.makedirs(tmp_path / state)
        (tmp_path / state / "core.zip").write_bytes(content)
    sources = [StateSource("NSW", "v", "u", 100, hashlib.md5(b"a" * 100).hexdigest(), *[None] * 4),
               StateSource("VIC", "v", "u", 50, "0" * 32, *[None] * 4), StateSource("QLD", "v", "u", 11, hashlib.md5(b"c" * 10).hexdigest(), *[None] * 4)]
    got = {r["state"]: (r["size_ok"], r["md5_ok"]) for r in check_artifacts(spark, str(tmp_path), registry.registry_table(spark, sources)).collect()}
    assert got == {"NSW": (True, True), "VIC": (True, False), "QLD": (False, False)}


def test_registry_and_routing():
    assert registry.get_source(" nsw ").state == "NSW"
    with pytest.raises(ValueError):
        registry.get_source("WA")
    assert registry.states_meeting((143.0, -36.0, 144.0, -34.0)) == ["NSW", "VIC"]
    assert registry.states_meeting((153.64, -28.10, 160.0, -20.0)) == ["NSW"]
    unknown = (StateSource("X", "v", "u", 1, "m", None, None, None, None),)
    assert registry.states_meeting((0, 0, 1, 1), unknown) == ["X"]


def test_pages_add_up(spark, world):
    pages = landed.page_totals(landed.read_pages(spark, f"{world[0]}/ga/headers"), "headers")
    assert contracts.landed_totals(pages).first().asDict() == {"layer": "headers", "landed": 3, "announced": 3, "complete": True}


def test_field_and_layer_gaps(spark, world):
    headers = landed.read_header_features(spark, f"{world[0]}/ga/headers")
    sent = {k for r in headers.collect() for k in json.loads(r["source_attributes"])}
    want = {f for f in contracts.REQUIRED_FIELDS["headers"] if f not in sent}
    assert {r["field"] for r in contracts.missing_fields(headers, "headers").collect()} == want
    plain = spark.createDataFrame([(1, "n", "s")], "eno long, name string, state string")
    assert contracts.missing_fields(plain, "headers").collect() == [("headers", "elevation_m")]
    assert contracts.missing_layers(["a", "b"], ["b"]) == ["a"]


def test_box_query_reaches_the_scan(spark, world):
    """Envelope and source filters are pushed to Parquet, and only needed columns are read."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    ga, states, _ = queries(world)
    for query in (ga.boreholes(bbox=BOX).headers, states.boreholes("NSW", bbox=BOX).headers):
        plan = query.select("longitude")._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(point_lon,143.0)" in plan and "LessThanOrEqual(point_lat,-34.0)" in plan
        assert "source_attributes" not in plan and "RefElev" not in plan
    logs = states.boreholes("NSW", bbox=BOX).log_tables["stratigraphy"]
    for logs in (logs, ga.boreholes(bbox=BOX).log_tables["stratigraphy"]):
        plan = logs._jdf.queryExecution().executedPlan().toString()
        assert "LessThanOrEqual(code_min_lon,144.0)" in plan and "GreaterThanOrEqual(code_max_lat,-36.0)" in plan


def test_a_whole_store_answers_like_its_parts(spark, world):
    _, store, _, _ = world
    ga, states, every = queries(world)
    whole = AllBores.from_store(store)
    found, want = whole.boreholes(bbox=BOX), every.boreholes(bbox=BOX)
    assert rows(found.header_table()) == rows(want.header_table())
    for kind in LOG_KINDS:
        assert rows(found.log_table(kind)) == rows(want.log_table(kind))
    assert found.citation() == want.citation()
    assert whole.national.hydrogeology_citation().startswith("Hydrogeology of Australia, Geoscience Australia, accessed")
    assert ga.hydrogeology_citation() == "Hydrogeology of Australia, Geoscience Australia."
    order = [(r["source"], r["row_no"]) for r in found.headers.orderBy("source_ord", "row_no").collect()]
    assert [(r["source"], r["row_no"]) for i in (0, 3, -1) for r in found.at(i).collect()] == [order[0], order[3], order[-1]]
    with pytest.raises(ValueError):
        AllBores.from_store(SnapshotStore(spark, f"{store.root}-none"))


def test_new_headers_place_the_national_logs_again(spark, tmp_path):
    root = f"{tmp_path}/ga"
    land_national(root)
    store = SnapshotStore(spark, f"{tmp_path}/store")
    first = build_national(store, root, now=NOW)
    assert build_national(store, root, now=NOW + 1)["stratigraphy"].inputFiles() == first["stratigraphy"].inputFiles()
    page(f"{root}/headers/p3.json", [{"geometry": {"type": "Point", "coordinates": [143.4, -35.1]}, "properties": {"eno": 9}}], 4)
    tables = build_national(store, root, now=NOW + 2)
    ga = NationalBores(tables["headers"], {"stratigraphy": tables["stratigraphy"]})
    assert 9 in {r["eno"] for r in ga.boreholes(bbox=BOX).log_table().collect()}


def test_details_of_each_snapshot(world):
    details = {r["key"]: r for r in world[1].details(now=NOW + 60).collect()}
    assert len(details) == 12 and details["ga-headers"]["feature_count"] == 3
    assert all(r["size_bytes"] > 0 and r["age_seconds"] == 60.0 for r in details.values())
    assert details["ngis-nsw-bores-opt1"]["query"] == '{"service":"ngis","state":"NSW","layer":"bores"}'


def test_a_code_with_a_bore_outside_the_box_keeps_its_logs(spark):
    bores = spark.createDataFrame(
        [(1, "A", 143.5, -35.0), (2, "A", 150.0, -30.0), (3, "B", 150.0, -30.0), (4, "C", None, None)],
        "row_no long, HydroCode string, Longitude double, Latitude double",
    )
    logs = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (4, "D")], "row_no long, HydroCode string")
    bounded = joins.with_code_bounds(joins.with_bore_position(logs, bores), bores)
    assert bounded.count() == 4
    assert [r["row_no"] for r in joins.logs_near(bounded, BOX).collect()] == [1]


def test_keys_outside_the_set_count_within_their_source(spark):
    headers = spark.createDataFrame([("NGIS:NSW", "1")], "source string, bore_key string")
    logs = spark.createDataFrame([("NGIS:VIC", "1"), ("NGIS:NSW", "1")], "source string, bore_key string")
    assert contracts.logs_outside_set(logs, headers).first()["n_failed"] == 1
    assert contracts.logs_outside_set(logs.drop("source"), headers).first()["n_failed"] == 0


def test_empty_store_has_a_summary(spark, tmp_path):
    from borelake import SnapshotStore

    assert SnapshotStore(spark, f"{tmp_path}/empty").summary().first().asDict() == {
        "entry_count": 0, "feature_count": 0, "total_bytes": 0
    }


def test_source_partitions_are_pruned(spark, world, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    states = queries(world)[1]
    sinks.write_table(sinks.laid_out(states.bores, "point_lon", "point_lat"), f"{tmp_path}/bores")
    stored = StateBores(spark.read.parquet(f"{tmp_path}/bores"), {})
    plan = stored.boreholes("VIC", bbox=BOX).headers._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan or "PartitionFilters: [(source" in plan
    assert stored.boreholes("VIC", bbox=BOX).count() == 3


def test_a_second_build_opens_no_page(spark, tmp_path, monkeypatch):
    from borelake.sources import landed

    root = f"{tmp_path}/ga"
    land_national(root)
    store = SnapshotStore(spark, f"{tmp_path}/store")
    first = build_national(store, root, now=NOW)
    monkeypatch.setattr(landed, "read_pages", lambda *_: pytest.fail("a page was opened"))
    again = build_national(store, root, now=NOW + 1)
    assert {k: t.inputFiles() for k, t in again.items()} == {k: t.inputFiles() for k, t in first.items()}
    monkeypatch.undo()
    page(f"{root}/hydrogeology/p9.json", [{"geometry": {"type": "Polygon", "coordinates": [[[143.1, -35.1], [143.2, -35.1], [143.2, -35.0], [143.1, -35.1]]]}, "properties": {"ufi": 99}}], 1)
    changed = build_national(store, root, now=NOW + 2)
    assert changed["hydrogeology"].count() == first["hydrogeology"].count() + 1
    assert changed["headers"].inputFiles() == first["headers"].inputFiles()


def test_counts_and_depths_come_from_what_was_kept(spark, world):
    found = AllBores.from_store(world[1]).boreholes(bbox=BOX, sources="NSW")
    assert set(found.summaries) == set(LOG_KINDS)
    for kind in ("stratigraphy", "construction"):
        counted = found.interval_counts(kind)
        assert not any("/data/ngis-nsw-" + kind in f for f in counted.inputFiles())
        plain = queries(world)[1].boreholes("nsw", bbox=BOX).interval_counts(kind)
        assert sorted(map(tuple, counted.select("bore_key", "row_no", "n_intervals").collect())) == sorted(
            map(tuple, plain.select("bore_key", "row_no", "n_intervals").collect()))
    depths = {r["bore_key"]: r["total_depth_m"] for r in found.total_depths().collect()}
    unkept = queries(world)[1].boreholes("nsw", bbox=BOX).total_depths()
    assert depths == {r["bore_key"]: r["total_depth_m"] for r in unkept.collect()}
    assert not AllBores.from_store(world[1]).boreholes(bbox=BOX).summaries


def test_summaries_of_parts_merge(spark):
    from borelake.operators.mapping import state_logs
    from borelake.operators.summary import code_summary, merged_summaries

    raw = spark.createDataFrame(
        [(i, None if i % 7 == 0 else f"k{i % 5}", float(i), None if i % 4 == 0 else float(60 - i), "Unknown" if i % 9 == 0 else "Sand") for i in range(60)],
        "row_no bigint, HydroCode string, FromDepth double, ToDepth double, Description string")
    logs = state_logs(raw, "stratigraphy", "NGIS:NSW")
    whole = code_summary(logs)
    parts = [code_summary(logs.where(f"row_no % 3 = {i}")) for i in range(3)]
    merged = merged_summaries(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))
    assert all(r.n_valid + r.n_missing + r.n_inverted + r.n_unknown == r.n_intervals for r in whole.collect())


def test_a_build_counts_its_checks(world):
    store = world[1]
    found = {k: {r["check"]: (r["n_checked"], r["n_failed"]) for r in store.checks(k).collect()}
             for k in ("ga-headers", "ga-stratigraphy", "ga-hydrogeology", "ngis-nsw-bores-opt1", "ngis-nsw-stratigraphy-opt1")}
    headers = contracts.header_checks(mapping.national_headers(world[3]["headers"])).collect()
    assert found["ga-headers"] == {r["check"]: (r["n_checked"], r["n_failed"]) for r in headers}
    for key, logs in (("ga-stratigraphy", mapping.national_logs(world[3]["stratigraphy"], "stratigraphy")),
                      ("ngis-nsw-stratigraphy-opt1", mapping.state_logs(world[2]["NSW"]["stratigraphy"], "stratigraphy"))):
        assert found[key] == {r["check"]: (r["n_checked"], r["n_failed"]) for r in contracts.log_checks(logs).collect()}
    assert set(found["ga-hydrogeology"]) == {"rings_have_area", "vertices_in_australia"}
    assert store.checks("nowhere") is None


def test_many_regions_of_all_sources_at_once(spark, world):
    from borelake.functions.geometry import SHAPE_TYPE

    def ring(x0, y0, x1, y1):
        return [{"x": float(x), "y": float(y)} for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))]

    x0, y0, x1, y1 = BOX
    boxes = {"all": BOX, "west": (x0, y0, (x0 + x1) / 2, y1), "none": (x0, y0, x0 + 1e-4, y0 + 1e-4)}
    regions = spark.createDataFrame([(k, [[ring(*b)]]) for k, b in boxes.items()], f"region string, shape {SHAPE_TYPE}")
    everything = AllBores.from_store(world[1])
    found = everything.log_tables_in(regions, "region")
    assert found.columns == ["region", *export_columns("stratigraphy")]
    for name, box in boxes.items():
        alone = everything.boreholes(bbox=box).log_table().collect()
        together = found.where(F.col("region") == name).drop("region").collect()
        assert sorted(map(str, together)) == sorted(map(str, alone))
    assert found.where("region = 'all'").count() > 0
    with pytest.raises(ValueError, match="no region"):
        everything.log_tables_in(regions.where("false"), "region")


def test_large_lookups_of_bores_are_hashed_not_sorted(spark, monkeypatch):
    bores = spark.createDataFrame(
        [("A", 1, 146.0, -35.0), ("B", 2, 147.0, -36.0), ("B", 3, 148.0, -36.5)],
        "HydroCode string, row_no bigint, Longitude double, Latitude double",
    )
    logs = spark.createDataFrame([(i, code) for i, code in enumerate(["A", "B", "B", "C", None])], "row_no bigint, HydroCode string")
    lookup = joins.bore_lookup(bores).localCheckpoint()
    small = rows(joins.with_bore_place(logs, lookup))
    monkeypatch.setattr(joins, "BROADCAST_LIMIT", 100)  # less than the lookup has, more than a task's share of it
    placed = joins.with_bore_place(logs, lookup)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert rows(placed) == small and len(small) == 5


def test_layout_sorts_by_one_number_of_the_cell(spark):
    points = spark.range(200).select(
        F.col("id").alias("row_no"), F.when(F.col("id") % 9 > 0, 140 + F.col("id") % 7 - 3.5).alias("lon"),
        F.when(F.col("id") % 9 > 0, F.col("id") % 5 - 2.25).alias("lat"),
    )
    placed = sinks.laid_out(points, "lon", "lat", 1.0)
    assert placed.columns == points.columns and rows(placed) == rows(points)
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [_cell" in plan
    cells = [(r.lat is not None, r.lat, r.lon, r.row_no) for r in placed.collect()]
    firsts = [(c[0], c[1] // 1 if c[0] else 0, c[2] // 1 if c[0] else 0, c[3]) for c in cells]
    assert firsts == sorted(firsts)
