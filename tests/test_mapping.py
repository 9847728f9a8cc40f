import json

from pyspark.sql import functions as F

from borelake.operators import mapping
from borelake.schema import HEADER_COLUMNS


def test_national_header_prefers_the_point_and_keeps_the_record(spark):
    raw = spark.createDataFrame(
        [
            (1, "a", "Point", 149.0, -35.0, "150.0", "-30.0", " None "),
            (2, "b", "Polygon", 1.0, 2.0, "150.0", "-30.0", "12.5"),
            (3, "c", None, None, None, None, "-30.0", "12d"),
        ],
        "eno long, name string, geom_type string, geom_lon double, geom_lat double, "
        "GDA94_dlong string, GDA94_dlat string, elevation_m string",
    )
    out = mapping.national_headers(raw)
    assert tuple(out.columns[:15]) == HEADER_COLUMNS
    got = {r["eno"]: r for r in out.collect()}
    assert (got[1]["longitude"], got[1]["latitude"]) == (149.0, -35.0)
    assert (got[2]["longitude"], got[2]["latitude"]) == (150.0, -30.0)
    assert (got[3]["longitude"], got[3]["latitude"]) == (None, -30.0)
    assert [got[i]["elevation_m"] for i in (1, 2, 3)] == [None, 12.5, None]
    assert got[1]["source"] == "GA" and got[1]["bore_key"] == "1"
    assert json.loads(got[3]["source_attributes"])["GDA94_dlong"] is None


def test_state_comes_from_the_tag_only_when_it_has_a_colon(spark):
    raw = spark.createDataFrame([(" C1 ", 140.0, -35.0, 7)], "HydroCode string, Longitude double, Latitude double, StateTerritory int")
    tagged = mapping.state_headers(raw, "NGIS:NSW").first()
    assert (tagged["state"], tagged["source"], tagged["identifier"]) == ("NSW", "NGIS:NSW", "C1")
    assert mapping.state_headers(raw, "NGIS").first()["state"] is None
    assert json.loads(tagged["source_attributes"]) == {
        "HydroCode": " C1 ", "Longitude": 140.0, "Latitude": -35.0, "StateTerritory": 7}


def test_validity_order_and_source_rules(spark):
    raw = spark.createDataFrame(
        [(1, 0.0, 5.0, "Sand"), (2, 5.0, 5.0, "Sand"), (3, 9.0, 5.0, " UNKNOWN "), (4, None, 5.0, "Unknown"),
         (5, 0.0, 5.0, "unknown"), (6, float("nan"), 5.0, "Sand")],
        "row_no long, FromDepth double, ToDepth double, Description string",
    ).withColumn("HydroCode", F.lit("X"))
    got = {r["row_no"]: r["invalid_reason"] for r in mapping.state_logs(raw, "stratigraphy").collect()}
    assert got == {1: None, 2: None, 3: "inverted interval (top > bottom)", 4: "missing depth",
                   5: "unknown formation", 6: "missing depth"}
    national = raw.select("row_no", F.lit("1").alias("ENO"), F.col("FromDepth").alias("INTERVAL_BEGIN_M"),
                          F.col("ToDepth").alias("INTERVAL_END_M"), F.col("Description").alias("STRAT_UNIT_NAME"))
    kept = {r["row_no"]: r["valid"] for r in mapping.national_logs(national, "stratigraphy").collect()}
    assert kept[5] is True and kept[4] is False


def test_log_bag_leaves_out_the_added_position(spark):
    raw = spark.createDataFrame([("X", 1.0, 140.0, -35.0, 140.0, "extra")],
                                "HydroCode string, FromDepth double, Longitude double, Latitude double, code_min_lon double, Other string")
    bag = json.loads(mapping.state_logs(raw, "construction").first()["source_attributes"])
    assert bag == {"HydroCode": "X", "FromDepth": 1.0, "Other": "extra"}


def test_hydro_units_renames_and_keeps_the_rest(spark):
    raw = spark.createDataFrame([(" f ", "t", "d", "none", "a", 5, 1.0)],
                                "feature string, type string, distbn string, prodty string, aquif_ty string, ufi int, min_lon double")
    row = mapping.hydro_units(raw).first().asDict()
    assert row == {"feature": "f", "type": "t", "distribution": "d", "productivity": None, "aquifer_type": "a",
                   "ufi": "5", "min_lon": 1.0}


def test_empty_layers_keep_their_schema(spark):
    raw = spark.createDataFrame([], "HydroCode string, row_no long")
    out = mapping.state_logs(raw, "earth_material", "NGIS:VIC")
    assert out.count() == 0 and "lithology_group" in out.columns
