"""One registered query per operator, each over whole tables.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``ORACLES`` maps the same name to the
SQL that must give the same rows. The raw views are turned into canonical tables by the library's
own mappings first, as a user would.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from borelake import AllBores, SnapshotStore, build_state
from borelake.config import shared_path
from borelake.functions.coerce import clean_text, parse_number
from borelake.functions.citation import citation_text
from borelake.functions.geometry import bounds_of, box_shape, is_box
from borelake.functions.keys import key_set_digest, log_key, query_key, region_key
from borelake.operators import (
    compilation, contracts, federation, filters, joins, mapping, ordinal, spatial_join, summary, validity,
)
from borelake.operators.hot_keys import over_tasks
from borelake.region import Region
from borelake.sources import artifacts, landed, registry, sinks, snapshot

from .fixtures import Fixtures, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BOX = Region.from_bbox(143.0, -36.0, 147.0, -31.0)
TRIANGLE = Region.from_polygon([(142.0, -38.0), (152.0, -38.0), (147.0, -30.0)])
NOW = 1_706_000_000.0
LOCAL_PID = "http://pid.example/samplingFeature/au/BH7"


def register(name: str, sql: str | None = None):
    """Register a query that receives the views, with the SQL it is compared with."""

    def keep(body):
        QUERIES[name] = lambda spark, sf_dir: body(Fixtures(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return body

    return keep


# Canonical tables from the raw views -----------------------------------------------------------


def bores(fx: Fixtures) -> DataFrame:
    tag = F.concat(F.lit("NGIS:"), F.col("state_core"))
    return mapping.state_headers(fx.fx_ngis_bore, tag)


def strat(fx: Fixtures) -> DataFrame:
    return mapping.state_logs(fx.fx_ngis_boreholelog, "stratigraphy")


def earth(fx: Fixtures) -> DataFrame:
    return mapping.state_logs(fx.fx_ngis_lithologylog, "earth_material")


def construction(fx: Fixtures) -> DataFrame:
    return mapping.state_logs(fx.fx_ngis_constructionlog, "construction")


def ga_headers(fx: Fixtures) -> DataFrame:
    raw = fx.fx_ga_header.withColumn("row_no", F.col("eno"))
    return mapping.national_headers(raw)


def ga_strat(fx: Fixtures) -> DataFrame:
    return mapping.national_logs(fx.fx_ga_strat, "stratigraphy")


def tagged_strat(fx: Fixtures) -> DataFrame:
    """State stratigraphy with the source of its core, as a landed table partitioned by source."""
    cores = fx.table("customer").select(
        F.concat(F.lit("GW"), "c_custkey").alias("HydroCode"),
        F.expr("concat('NGIS:', CASE c_nationkey % 3 WHEN 0 THEN 'NSW' WHEN 1 THEN 'VIC' ELSE 'QLD' END)")
        .alias("source"),
    )
    return mapping.state_logs(fx.fx_ngis_boreholelog.join(cores, "HydroCode", "left"), "stratigraphy")


def hydro_shapes(fx: Fixtures) -> DataFrame:
    return fx.fx_hydro.withColumn("shape", box_shape(*(F.col(c) for c in BOUNDS)))


BOUNDS = ("min_lon", "min_lat", "max_lon", "max_lat")

# The same tables in SQL ------------------------------------------------------------------------


def _txt(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) IN ('', 'none', 'null', 'nan') THEN NULL ELSE trim({c}) END"


def _num(c: str) -> str:
    return f"try_cast(trim({c}) AS double)"


_NS, _ND, _NB = "CAST(NULL AS varchar)", "CAST(NULL AS double)", "CAST(NULL AS bigint)"
_REASON = (
    "CASE WHEN top_depth_m IS NULL OR bottom_depth_m IS NULL THEN 'missing depth' "
    "WHEN top_depth_m > bottom_depth_m THEN 'inverted interval (top > bottom)' {more}END"
)

_BORES = f"""
bores AS (
  SELECT row_no, {_NB} AS eno, {_txt('"StateBoreID"')} AS name, {_txt('"HydroCode"')} AS identifier,
         "Longitude" AS longitude, "Latitude" AS latitude, "RefElev" AS elevation_m,
         state_core AS state, {_NS} AS province, {_txt('"FType"')} AS purpose,
         {_txt('"Status"')} AS status, {_NS} AS drilling_method, 'NGIS:' || state_core AS source,
         "BoreDepth" AS bore_depth_m, "DrilledDepth" AS drilled_depth_m,
         {_txt('"DrilledDate"')} AS drilled_date, {_txt('"RefElevDesc"')} AS depth_reference,
         {_txt('"HydroCode"')} AS bore_key
  FROM fx_ngis_bore)"""

_STRAT = f"""
strat0 AS (
  SELECT row_no, "HydroCode" AS bore_key, {_NB} AS eno, {_txt('"HydroCode"')} AS borehole_name,
         "FromDepth" AS top_depth_m, "ToDepth" AS bottom_depth_m, "RefElev" AS ref_elev_m_ahd,
         "TopElev" AS top_elev_m_ahd, "BottomElev" AS bottom_elev_m_ahd,
         {_txt('"Description"')} AS unit, {_NS} AS unit_pid, {_NS} AS older_age, {_NS} AS younger_age,
         {_ND} AS older_age_ma, {_ND} AS younger_age_ma, {_NS} AS top_contact, {_NS} AS base_contact,
         {_NS} AS geological_province, {_NB} AS stratigraphy_id, {_txt('"Comment"')} AS comment
  FROM fx_ngis_boreholelog),
strat1 AS (
  SELECT *, {_REASON.format(more="WHEN lower(unit) = 'unknown' THEN 'unknown formation' ")} AS invalid_reason
  FROM strat0),
strat AS (SELECT *, invalid_reason IS NULL AS valid FROM strat1)"""

_EARTH = f"""
earth0 AS (
  SELECT row_no, "HydroCode" AS bore_key, {_NB} AS eno, {_txt('"HydroCode"')} AS borehole_name,
         "FromDepth" AS top_depth_m, "ToDepth" AS bottom_depth_m, "RefElev" AS ref_elev_m_ahd,
         {_ND} AS top_elev_m_ahd, {_ND} AS bottom_elev_m_ahd, {_NS} AS lithology,
         {_txt('"MajorLithCode"')} AS lithology_group, {_txt('"MinorLithCode"')} AS lithology_qualifier,
         {_txt('"Description"')} AS description, {_NS} AS geological_province, {_NB} AS earth_material_id
  FROM fx_ngis_lithologylog),
earth1 AS (SELECT *, {_REASON.format(more="")} AS invalid_reason FROM earth0),
earth AS (SELECT *, invalid_reason IS NULL AS valid FROM earth1)"""

_CONSTRUCTION = f"""
construction0 AS (
  SELECT row_no, "HydroCode" AS bore_key, {_NB} AS eno, {_txt('"HydroCode"')} AS borehole_name,
         "FromDepth" AS top_depth_m, "ToDepth" AS bottom_depth_m, "RefElev" AS ref_elev_m_ahd,
         {_ND} AS top_elev_m_ahd, {_ND} AS bottom_elev_m_ahd,
         "ConstructionType" AS construction_type, "Material" AS material,
         "InnerDiameter" AS inner_diameter, "OuterDiameter" AS outer_diameter,
         "Property" AS property, "PropertySize" AS property_size, "DrillMethod" AS drill_method
  FROM fx_ngis_constructionlog),
construction1 AS (SELECT *, {_REASON.format(more="")} AS invalid_reason FROM construction0),
construction AS (SELECT *, invalid_reason IS NULL AS valid FROM construction1)"""

_GA = f"""
ga AS (
  SELECT eno, name, identifier, coalesce(geom_lon, "GDA94_dlong") AS longitude,
         coalesce(geom_lat, "GDA94_dlat") AS latitude, {_num('elevation_m')} AS elevation_m,
         {_NS} AS state, {_NS} AS province, {_NS} AS purpose, {_NS} AS status,
         "drillingMethod" AS drilling_method, 'GA' AS source, {_ND} AS bore_depth_m,
         {_ND} AS drilled_depth_m, {_NS} AS drilled_date, CAST(eno AS varchar) AS bore_key
  FROM fx_ga_header)"""

_GA_STRAT = f"""
gs0 AS (
  SELECT row_no, try_cast("ENO" AS bigint) AS eno, "BOREHOLE_NAME" AS borehole_name,
         {_num('"INTERVAL_BEGIN_M"')} AS top_depth_m, {_num('"INTERVAL_END_M"')} AS bottom_depth_m,
         {_num('"DEPTH_REF_POINT_ELEV_M_AHD"')} AS ref_elev_m_ahd, {_ND} AS top_elev_m_ahd,
         {_ND} AS bottom_elev_m_ahd, "STRAT_UNIT_NAME" AS unit, {_NS} AS unit_pid, {_NS} AS older_age,
         {_NS} AS younger_age, {_ND} AS older_age_ma, {_ND} AS younger_age_ma, {_NS} AS top_contact,
         {_NS} AS base_contact, {_NS} AS geological_province, {_NB} AS stratigraphy_id, {_NS} AS comment
  FROM fx_ga_strat),
gs1 AS (SELECT *, {_REASON.format(more="")} AS invalid_reason FROM gs0),
gs AS (SELECT *, invalid_reason IS NULL AS valid FROM gs1)"""

_HEADER = ", ".join(mapping.HEADER_COLUMNS)
_LOG = "eno, borehole_name, top_depth_m, bottom_depth_m, ref_elev_m_ahd, top_elev_m_ahd, bottom_elev_m_ahd"
_PAYLOAD = {kind: ", ".join(cols) for kind, cols in mapping.LOG_PAYLOAD.items()}
_FLAGS = "valid, invalid_reason"


def _export(headers: str, logs: str, kind: str, on: str) -> str:
    cols = [c.strip() for c in f"top_depth_m, bottom_depth_m, ref_elev_m_ahd, top_elev_m_ahd, bottom_elev_m_ahd, {_PAYLOAD[kind]}, {_FLAGS}".split(",")]
    body = ", ".join(f"l.{c} AS {c}" for c in cols)
    return (
        f"SELECT h.source AS source, l.eno AS eno, coalesce(l.borehole_name, h.name) AS borehole_name, "
        f"h.longitude AS longitude, h.latitude AS latitude, {body} FROM {headers} h JOIN {logs} l ON {on}"
    )


def with_(*parts: str) -> str:
    return "WITH " + ",".join(p.strip() for p in parts) + "\n"


# Projections -----------------------------------------------------------------------------------


@register("coerce_header", f"""
SELECT eno, {_num('elevation_m')} AS elevation, {_txt('elevation_m')} AS elevation_text FROM fx_ga_header
""")
def _(fx):
    return fx.fx_ga_header.select(
        "eno", parse_number(F.col("elevation_m")).alias("elevation"),
        clean_text(F.col("elevation_m")).alias("elevation_text"),
    )


@register("ga_header_map", with_(_GA) + f"SELECT {_HEADER}, bore_key FROM ga")
def _(fx):
    return ga_headers(fx).select(*mapping.HEADER_COLUMNS, "bore_key")


@register("ngis_bore_map", with_(_BORES) + f"SELECT row_no, {_HEADER}, depth_reference FROM bores")
def _(fx):
    return bores(fx).select("row_no", *mapping.HEADER_COLUMNS, "depth_reference")


def _mapped(df: DataFrame, kind: str) -> DataFrame:
    names = [c.strip() for c in f"row_no, {_LOG}, {_PAYLOAD[kind]}, {_FLAGS}".split(",")]
    return df.select(*names)


@register("strat_map_ngis", with_(_STRAT) + f"SELECT row_no, {_LOG}, {_PAYLOAD['stratigraphy']}, {_FLAGS} FROM strat")
def _(fx):
    return _mapped(strat(fx), "stratigraphy")


@register("strat_map_ga", with_(_GA_STRAT) + f"SELECT row_no, {_LOG}, {_PAYLOAD['stratigraphy']}, {_FLAGS} FROM gs")
def _(fx):
    return _mapped(ga_strat(fx), "stratigraphy")


@register("earth_map_ga", f"""
WITH e0 AS (
  SELECT row_no, CAST("ENO" AS bigint) AS eno, {_txt('"BOREHOLE_NAME"')} AS borehole_name,
         "INTERVAL_BEGIN_M" AS top_depth_m, "INTERVAL_END_M" AS bottom_depth_m,
         {_ND} AS ref_elev_m_ahd, {_ND} AS top_elev_m_ahd, {_ND} AS bottom_elev_m_ahd,
         "LITHOLOGY" AS lithology, "LITHOLOGY_GROUP" AS lithology_group,
         {_txt('"LITHOLOGY_QUALIFIER"')} AS lithology_qualifier, "EARTH_MATERIAL_DESC" AS description,
         {_NS} AS geological_province, "EARTH_MATERIAL_ID" AS earth_material_id FROM fx_ga_earth),
e1 AS (SELECT *, {_REASON.format(more="")} AS invalid_reason FROM e0)
SELECT *, invalid_reason IS NULL AS valid FROM e1""")
def _(fx):
    return _mapped(mapping.national_logs(fx.fx_ga_earth, "earth_material"), "earth_material")


@register("lith_map_ngis", with_(_EARTH) + f"SELECT row_no, {_LOG}, {_PAYLOAD['earth_material']}, {_FLAGS} FROM earth")
def _(fx):
    return _mapped(earth(fx), "earth_material")


@register("construction_map_ngis", with_(_CONSTRUCTION) + f"SELECT row_no, {_LOG}, {_PAYLOAD['construction']}, {_FLAGS} FROM construction")
def _(fx):
    return _mapped(construction(fx), "construction")


@register("construction_map_canonical", with_(_CONSTRUCTION) + f"""
SELECT row_no, CAST(row_no AS bigint) AS eno, borehole_name, top_depth_m, bottom_depth_m, ref_elev_m_ahd,
       top_elev_m_ahd, bottom_elev_m_ahd, {_PAYLOAD['construction']}, {_FLAGS} FROM construction""")
def _(fx):
    raw = fx.fx_ngis_constructionlog.select(
        "row_no", F.col("row_no").cast("string").alias("ENO"), F.col("HydroCode").alias("BOREHOLE_NAME"),
        F.col("FromDepth").alias("INTERVAL_BEGIN_M"), F.col("ToDepth").cast("string").alias("INTERVAL_END_M"),
        F.col("RefElev").alias("DEPTH_REF_POINT_ELEV_M_AHD"),
        *(F.col(state).alias(mapping.NATIONAL_PAYLOAD["construction"][name])
          for name, state in mapping.STATE_PAYLOAD["construction"].items()),
    )
    return _mapped(mapping.national_logs(raw, "construction"), "construction")


@register("hydro_map", f"""
SELECT feature, {_NS} AS type, {_NS} AS distribution, prodty AS productivity, {_NS} AS aquifer_type,
       CAST(ufi AS varchar) AS ufi, min_lon, min_lat, max_lon, max_lat FROM fx_hydro""")
def _(fx):
    return mapping.hydro_units(fx.fx_hydro)


@register("raw_bag", """
SELECT row_no, concat('{"HydroCode":', to_json("HydroCode"), ',"ConstructionType":"', "ConstructionType",
  '","Material":"PVC","InnerDiameter":100.0,"OuterDiameter":110.0,"Property":"Slotted","PropertySize":0.5,"DrillMethod":"',
  "DrillMethod", '","FromDepth":', CAST("FromDepth" AS varchar), ',"ToDepth":', CAST("ToDepth" AS varchar),
  ',"RefElev":100.0}') AS source_attributes FROM fx_ngis_constructionlog""")
def _(fx):
    return construction(fx).select("row_no", "source_attributes")


@register("bore_points", """
SELECT row_no, CASE WHEN "Longitude" IS NULL OR "Latitude" IS NULL THEN NULL ELSE "Longitude" END AS point_lon,
       CASE WHEN "Longitude" IS NULL OR "Latitude" IS NULL THEN NULL ELSE "Latitude" END AS point_lat
FROM fx_ngis_bore""")
def _(fx):
    return joins.with_point(fx.fx_ngis_bore).select("row_no", "point_lon", "point_lat")


@register("records_without_geometry", """
SELECT eno, name, identifier, "GDA94_dlong", "GDA94_dlat", elevation_m, "drillingMethod" FROM fx_ga_header""")
def _(fx):
    return mapping.without_geometry(fx.fx_ga_header)


@register("identifier_eno", "SELECT identifier, eno AS identifier_eno FROM fx_ga_header")
def _(fx):
    return filters.with_identifier_eno(fx.fx_ga_header).select("identifier", "identifier_eno")


# Filters ---------------------------------------------------------------------------------------

_IN_BOX = "longitude BETWEEN 143 AND 147 AND latitude BETWEEN -36 AND -31"
_IN_TRIANGLE = (
    "latitude >= -38 AND 8 * (longitude - 142) >= 5 * (latitude + 38) "
    "AND 8 * (152 - longitude) >= 5 * (latitude + 38)"
)


@register("bbox_headers", with_(_BORES) + f"SELECT {_HEADER} FROM bores WHERE {_IN_BOX}")
def _(fx):
    return joins.export_headers(filters.in_region(bores(fx), BOX))


@register("bbox_count", with_(_BORES) + f"SELECT count(*) AS n FROM bores WHERE {_IN_BOX}")
def _(fx):
    return summary.count_rows(filters.in_region(bores(fx), BOX))


@register("attr_and_bbox", with_(_GA) + f"""
SELECT {_HEADER} FROM ga WHERE drilling_method = 'Diamond' AND {_IN_BOX}""")
def _(fx):
    raw = filters.by_attribute(fx.fx_ga_header, "drillingMethod = 'Diamond'")
    return joins.export_headers(filters.in_region(mapping.national_headers(raw), BOX))


@register("attr_number", """
SELECT eno, elevation_m FROM fx_ga_header
WHERE try_cast(trim(elevation_m) AS double) > 4 AND "drillingMethod" = 'Rotary'""")
def _(fx):
    found = filters.by_attribute(fx.fx_ga_header, "elevation_m > 4 AND drillingMethod = 'Rotary'")
    return found.select("eno", "elevation_m")


@register("single_header", with_(_GA) + f"SELECT {_HEADER} FROM ga WHERE eno = 7")
def _(fx):
    return joins.export_headers(filters.single_header(ga_headers(fx), LOCAL_PID))


@register("polygon_headers", with_(_BORES) + f"SELECT {_HEADER} FROM bores WHERE {_IN_TRIANGLE}")
def _(fx):
    return joins.export_headers(filters.in_region(bores(fx), TRIANGLE))


@register("polygon_envelope_headers", with_(_GA) + f"""
SELECT {_HEADER} FROM ga WHERE longitude BETWEEN 142 AND 152 AND latitude BETWEEN -38 AND -30""")
def _(fx):
    return joins.export_headers(filters.in_region(ga_headers(fx), TRIANGLE, refine="envelope"))


@register("hydro_in_region", """
SELECT ufi, feature, prodty FROM fx_hydro
WHERE max_lon >= 142 AND min_lon <= 152 AND max_lat >= -38 AND min_lat <= -30
  AND 8 * (max_lon - 142) >= 5 * (greatest(min_lat, -38) + 38)
  AND 8 * (152 - min_lon) >= 5 * (greatest(min_lat, -38) + 38)""")
def _(fx):
    found = spatial_join.polygons_in_region(
        hydro_shapes(fx), filters.region_shape(TRIANGLE), TRIANGLE.bounds, stored_bounds=BOUNDS
    )
    return found.select("ufi", "feature", "prodty")


@register("hydro_in_indexed_region")
def _(fx):
    found = spatial_join.polygons_in_region(hydro_shapes(fx), TRIANGLE, stored_bounds=BOUNDS)
    return found.select("ufi", "feature", "prodty")


ORACLES["hydro_in_indexed_region"] = ORACLES["hydro_in_region"]


@register("hydro_count", """
SELECT count(*) AS n FROM fx_hydro WHERE prodty = 'high'
  AND max_lon >= 143 AND min_lon <= 147 AND max_lat >= -36 AND min_lat <= -31""")
def _(fx):
    raw = filters.by_attribute(hydro_shapes(fx), "prodty = 'high'")
    return summary.count_rows(
        spatial_join.polygons_in_region(raw, filters.region_shape(BOX), BOX.bounds, stored_bounds=BOUNDS)
    )


@register("source_filter", with_(_BORES) + f"SELECT {_HEADER} FROM bores WHERE source IN ('NGIS:NSW', 'NGIS:QLD')")
def _(fx):
    return joins.export_headers(filters.by_source(bores(fx), ["nsw", "ngis:qld"]))


@register("valid_intervals", with_(_STRAT) + "SELECT row_no, unit, top_depth_m, bottom_depth_m FROM strat WHERE valid")
def _(fx):
    return filters.valid_only(strat(fx)).select("row_no", "unit", "top_depth_m", "bottom_depth_m")


@register("keyed_logs", """SELECT row_no, try_cast("ENO" AS bigint) AS eno FROM fx_ga_strat
WHERE try_cast("ENO" AS bigint) IS NOT NULL""")
def _(fx):
    return filters.keyed(ga_strat(fx), "eno").select("row_no", "eno")


@register("collection_keys", with_(_GA) + f"SELECT eno FROM ga WHERE {_IN_BOX} AND eno IS NOT NULL")
def _(fx):
    return filters.collection_keys(filters.in_region(ga_headers(fx), BOX))


@register("region_validity", """
SELECT box_id, min_lon < max_lon AND min_lat < max_lat AS region_valid,
       least(min_lon, max_lon) AS x0, min_lat AS y0, greatest(min_lon, max_lon) AS x1, max_lat AS y1,
       min_lon <> max_lon AND min_lat <> max_lat AS has_area FROM fx_box""")
def _(fx):
    boxes = filters.regions_from_boxes(fx.fx_box, *BOUNDS)
    x0, y0, x1, y1 = bounds_of(F.col("shape"))
    return validity.with_validity(boxes.withColumnRenamed("region_valid", "ordered")).select(
        "box_id", F.col("ordered").alias("region_valid"), x0.alias("x0"), y0.alias("y0"),
        x1.alias("x1"), y1.alias("y1"), (F.col("region_valid") & is_box(F.col("shape"))).alias("has_area"),
    )


# Holes and parts by the number of their case: west, south, east and north in units from the region's corner.
HOLES = {0: (2, 2, 4, 4), 1: (20, 20, 22, 22), 2: (8, 8, 12, 12), 3: (0, 2, 3, 5), 4: (0, 0, 10, 10)}
PARTS = {1: (30, 30, 33, 33), 2: (5, 5, 15, 15), 3: (10, 0, 14, 10), 4: (2.5, 2.5, 3.5, 3.5)}
_VALID_PARTED = "hole IN (0, 3, 5) AND (other IN (0, 1, 3) OR other = 4 AND hole = 0)"


def parted_shapes(fx: Fixtures) -> DataFrame:
    """Regions of a square, maybe a hole, maybe a second square."""
    def ring(west, south, east, north):
        return box_shape(*(F.col(c) + F.lit(float(k)) * F.col("u") for c, k in (("x", west), ("y", south), ("x", east), ("y", north))))[0][0]

    def case(column, rings):
        return F.array_compact(F.array(*(F.when(F.col(column) == k, ring(*at)) for k, at in rings.items())))

    first = F.concat(F.array(ring(0, 0, 10, 10)), case("hole", HOLES))
    second = F.transform(case("other", PARTS), lambda r: F.array(r))
    return over_tasks(fx.fx_parted).select("region_id", F.concat(F.array(first), second).alias("shape"))


def _in_parted(lon: str, lat: str) -> str:
    """SQL: a point lies in a region's square and not within its hole, or in its second square."""
    def held(at, sign="<="):
        west, south, east, north = at
        return f"(x + {west}e0 * u {sign} {lon} AND {lon} {sign} x + {east}e0 * u AND y + {south}e0 * u {sign} {lat} AND {lat} {sign} y + {north}e0 * u)"

    holes = " OR ".join(f"(hole = {k} AND {held(at, '<')})" for k, at in HOLES.items())
    parts = " OR ".join(f"(other = {k} AND {held(at)})" for k, at in PARTS.items())
    return f"({held((0, 0, 10, 10))} AND NOT ({holes}) OR {parts})"


@register("region_validity_parts", f"SELECT region_id, {_VALID_PARTED} AS region_valid FROM fx_parted")
def _(fx):
    return validity.with_validity(parted_shapes(fx)).select("region_id", "region_valid")


@register("header_at_position", with_(_BORES) + f"""
SELECT {_HEADER} FROM (SELECT *, row_number() OVER (ORDER BY row_no) AS place FROM bores) WHERE place = 21""")
def _(fx):
    return joins.export_headers(filters.at_position(bores(fx), 20))


# Joins -----------------------------------------------------------------------------------------

_DENORMALISED = """
points AS (
  SELECT "HydroCode", "Longitude", "Latitude" FROM (
    SELECT *, row_number() OVER (PARTITION BY "HydroCode" ORDER BY row_no DESC) AS rn
    FROM fx_ngis_bore WHERE "HydroCode" IS NOT NULL) WHERE rn = 1),
placed AS (
  SELECT l.*, p."Longitude", p."Latitude", p."HydroCode" IS NOT NULL AS found
  FROM fx_ngis_boreholelog l LEFT JOIN points p ON l."HydroCode" = p."HydroCode")"""


@register("log_denormalise", with_(_DENORMALISED) + """
SELECT row_no, "HydroCode", "Description", "FromDepth", "ToDepth", "Longitude", "Latitude" FROM placed""")
def _(fx):
    placed = joins.with_bore_position(fx.fx_ngis_boreholelog, fx.fx_ngis_bore)
    return placed.select(
        "row_no", "HydroCode", "Description", "FromDepth", "ToDepth", "Longitude", "Latitude"
    )


@register("orphan_logs", """
SELECT row_no, "HydroCode" AS bore_key FROM fx_ngis_boreholelog l
WHERE NOT EXISTS (SELECT 1 FROM fx_ngis_bore b WHERE b."HydroCode" = l."HydroCode")""")
def _(fx):
    return joins.orphan_logs(strat(fx), bores(fx)).select("row_no", "bore_key")


@register("strat_export", with_(_BORES, _STRAT) + _export("bores", "strat", "stratigraphy", "h.bore_key = l.bore_key"))
def _(fx):
    return joins.export_logs(bores(fx), strat(fx), "stratigraphy")


@register("earth_export", with_(_BORES, _EARTH) + _export("bores", "earth", "earth_material", "h.bore_key = l.bore_key"))
def _(fx):
    return joins.export_logs(bores(fx), earth(fx), "earth_material")


@register("construction_export", with_(_BORES, _CONSTRUCTION) + _export("bores", "construction", "construction", "h.bore_key = l.bore_key"))
def _(fx):
    return joins.export_logs(bores(fx), construction(fx), "construction")


@register("national_export", with_(_GA, _GA_STRAT) + _export("ga", "gs", "stratigraphy", "h.eno = l.eno"))
def _(fx):
    return joins.export_logs(ga_headers(fx), ga_strat(fx), "stratigraphy")


@register("box_strat_export", with_(_BORES, _STRAT) + _export(
    f"(SELECT * FROM bores WHERE {_IN_BOX})", "strat", "stratigraphy", "h.bore_key = l.bore_key"))
def _(fx):
    return joins.export_logs(filters.in_region(bores(fx), BOX), strat(fx), "stratigraphy")


@register("logs_semi", with_(_BORES, _STRAT) + f"""
SELECT row_no, bore_key, unit FROM strat WHERE bore_key IN (SELECT bore_key FROM bores WHERE {_IN_BOX})""")
def _(fx):
    found = joins.logs_of(strat(fx), filters.in_region(bores(fx), BOX))
    return found.select("row_no", "bore_key", "unit")


@register("bores_with_logs", with_(_BORES) + """
SELECT row_no, bore_key FROM bores b
WHERE EXISTS (SELECT 1 FROM fx_ngis_constructionlog l WHERE l."HydroCode" = b.bore_key)""")
def _(fx):
    return joins.bores_with_logs(bores(fx), construction(fx)).select("row_no", "bore_key")


@register("bores_without_logs", with_(_BORES) + """
SELECT row_no, bore_key FROM bores b
WHERE NOT EXISTS (SELECT 1 FROM fx_ngis_constructionlog l WHERE l."HydroCode" = b.bore_key)""")
def _(fx):
    return joins.bores_without_logs(bores(fx), construction(fx)).select("row_no", "bore_key")


_REGISTRY = """
reg(state, x0, y0, x1, y1) AS (VALUES ('NSW', 140.99e0, -37.70e0, 153.64e0, -28.10e0),
  ('VIC', 140.95e0, -39.05e0, 149.90e0, -34.02e0), ('QLD', 137.90e0, -30.80e0, 153.57e0, -9.42e0))"""


@register("state_routing", with_(_REGISTRY) + """
SELECT box_id, state FROM fx_box JOIN reg
  ON x0 <= max_lon AND min_lon <= x1 AND y0 <= max_lat AND min_lat <= y1""")
def _(fx):
    return registry.route_to_states(fx.fx_box, BOUNDS).select("box_id", "state")


@register("bore_registry", with_(_BORES) + """
SELECT row_no, state, CASE state WHEN 'NSW' THEN 98390403 WHEN 'VIC' THEN 1105719595 ELSE 48203959 END::bigint AS zip_bytes,
  'Bureau of Meteorology National Groundwater Information System (NGIS), ' || state || ' core, ' ||
  CASE state WHEN 'NSW' THEN '2014-11' WHEN 'VIC' THEN '2014-03' ELSE '2014' END || ' extract' AS description
FROM bores""")
def _(fx):
    known = registry.registry_table(fx.spark).select("state", "zip_bytes", "description")
    # a fixed table of three rows
    return bores(fx).select("row_no", "state").join(F.broadcast(known), "state")


@register("multi_region_counts", with_(_BORES) + """
SELECT region_id, r_name, count(*) AS n FROM fx_region JOIN bores
  ON longitude BETWEEN min_lon AND max_lon AND latitude BETWEEN min_lat AND max_lat
GROUP BY region_id, r_name""")
def _(fx):
    regions = filters.regions_from_boxes(fx.fx_region, *BOUNDS).select("region_id", "r_name", "shape")
    pairs = spatial_join.points_in_polygons(bores(fx), regions)
    return pairs.groupBy("region_id", "r_name").agg(F.count(F.lit(1)).alias("n"))


@register("hydro_overlay", with_(_BORES) + """
SELECT row_no, bore_key, ufi, feature FROM bores JOIN fx_hydro
  ON longitude BETWEEN min_lon AND max_lon AND latitude BETWEEN min_lat AND max_lat""")
def _(fx):
    units = hydro_shapes(fx).select("ufi", "feature", "shape")
    return spatial_join.points_in_polygons(bores(fx), units).select("row_no", "bore_key", "ufi", "feature")


@register("bores_in_boxes", with_(_BORES) + """
SELECT row_no, box_id FROM bores JOIN fx_box
  ON min_lon < max_lon AND min_lat < max_lat
 AND longitude BETWEEN min_lon AND max_lon AND latitude BETWEEN min_lat AND max_lat""")
def _(fx):
    boxes = filters.regions_from_boxes(fx.fx_box, *BOUNDS).where("region_valid")
    return spatial_join.points_in_polygons(
        bores(fx), boxes.select("box_id", "shape"), cell=1.0
    ).select("row_no", "box_id")


@register("points_in_parts", with_(_BORES) + f"""
SELECT row_no, region_id FROM bores JOIN fx_parted ON longitude BETWEEN x AND x + 33 * u
  AND latitude BETWEEN y AND y + 33 * u AND {_in_parted('longitude', 'latitude')}""")
def _(fx):
    return spatial_join.points_in_polygons(bores(fx), parted_shapes(fx)).select("row_no", "region_id")


@register("logs_in_boxes", with_(_BORES, _STRAT) + "SELECT b.box_id AS box_id, e.* EXCLUDE (bore_row_no) FROM (" + _export(
    "bores", "strat", "stratigraphy", "h.bore_key = l.bore_key").replace("SELECT", "SELECT h.row_no AS bore_row_no,", 1) + """) e
JOIN fx_box b ON min_lon < max_lon AND min_lat < max_lat
 AND longitude BETWEEN min_lon AND max_lon AND latitude BETWEEN min_lat AND max_lat""")
def _(fx):
    boxes = filters.regions_from_boxes(fx.fx_box, *BOUNDS).where("region_valid")
    return joins.logs_in_regions(bores(fx), strat(fx), boxes, "box_id", "stratigraphy")


# Unions ----------------------------------------------------------------------------------------


def all_headers(fx: Fixtures) -> DataFrame:
    return federation.federated_headers([ga_headers(fx), bores(fx)])


@register("federated_headers", with_(_GA, _BORES) + f"""
SELECT {_HEADER}, 0 AS source_ord FROM ga WHERE {_IN_BOX}
UNION ALL SELECT {_HEADER}, 1 AS source_ord FROM bores WHERE {_IN_BOX}""")
def _(fx):
    parts = (filters.in_region(df, BOX) for df in (ga_headers(fx), bores(fx)))
    return federation.federated_headers(parts).select(*mapping.HEADER_COLUMNS, "source_ord")


@register("federated_strat", with_(_GA, _BORES, _GA_STRAT, _STRAT) + _export(
    f"(SELECT * FROM ga WHERE {_IN_BOX})", "gs", "stratigraphy", "h.eno = l.eno") + " UNION ALL " + _export(
    f"(SELECT * FROM bores WHERE {_IN_BOX})", "strat", "stratigraphy", "h.bore_key = l.bore_key"))
def _(fx):
    logs = federation.federated_logs("stratigraphy", ga_strat(fx), tagged_strat(fx))
    return joins.export_logs(filters.in_region(all_headers(fx), BOX), logs, "stratigraphy")


@register("federated_construction", with_(_GA, _BORES, _CONSTRUCTION) + _export(
    f"(SELECT * FROM bores WHERE {_IN_BOX})", "construction", "construction", "h.bore_key = l.bore_key"))
def _(fx):
    logs = federation.federated_logs("construction", None, construction(fx))
    return joins.export_logs(filters.in_region(all_headers(fx), BOX), logs, "construction")


@register("ordered_log_table", with_(_GA, _BORES, _GA_STRAT, _STRAT) + _export(
    f"(SELECT *, eno AS row_no, 0 AS source_ord FROM ga WHERE {_IN_BOX})", "gs", "stratigraphy", "h.eno = l.eno"
    ).replace(" FROM ", ", h.source_ord AS source_ord, h.row_no AS bore_row_no, l.row_no AS log_row_no FROM ", 1) + " UNION ALL " + _export(
    f"(SELECT *, 1 AS source_ord FROM bores WHERE {_IN_BOX})", "strat", "stratigraphy", "h.bore_key = l.bore_key"
    ).replace(" FROM ", ", h.source_ord AS source_ord, h.row_no AS bore_row_no, l.row_no AS log_row_no FROM ", 1))
def _(fx):
    logs = federation.federated_logs("stratigraphy", ga_strat(fx), tagged_strat(fx))
    return joins.in_query_order(filters.in_region(all_headers(fx), BOX), logs, "stratigraphy")


@register("source_counts", with_(_GA, _BORES) + """
SELECT source, count(*) AS n FROM (SELECT source FROM ga UNION ALL SELECT source FROM bores) GROUP BY source""")
def _(fx):
    return summary.rows_per_source(all_headers(fx))


@register("missing_layers", """
SELECT state, layer FROM (
  SELECT state, unnest(['bores', 'stratigraphy', 'earth_material', 'construction']) AS layer FROM fx_states)
WHERE concat('ngis-', lower(state), '-', layer, '-opt1') NOT IN (SELECT "key" FROM fx_entries)""")
def _(fx):
    expected = snapshot.expected_layers(fx.fx_states)
    seen = snapshot.newest_entries(fx.fx_entries).select("key")
    gaps = expected.select("key").exceptAll(seen)
    return expected.join(gaps, "key", "left_semi").select("state", "layer")


# Aggregates ------------------------------------------------------------------------------------

_COUNTS = """
counts AS (
  SELECT b.row_no, b.bore_key, b.source, count(*) AS n_intervals
  FROM bores b JOIN strat l ON b.bore_key = l.bore_key GROUP BY b.row_no, b.bore_key, b.source)"""


def strat_counts(fx: Fixtures) -> DataFrame:
    return summary.interval_counts(bores(fx).select("row_no", "bore_key", "source"), strat(fx))


@register("interval_counts", with_(_BORES, _STRAT, _COUNTS) + "SELECT row_no, bore_key, source, n_intervals FROM counts")
def _(fx):
    return strat_counts(fx)


@register("bores_by_interval_count", with_(_BORES, _STRAT, _COUNTS) + "SELECT bore_key, n_intervals FROM counts ORDER BY n_intervals")
def _(fx):
    return summary.by_interval_count(strat_counts(fx)).select("bore_key", "n_intervals")


@register("interval_p98", with_(_BORES, _STRAT, _COUNTS) + """,
ranked AS (SELECT n_intervals, row_number() OVER (ORDER BY n_intervals) - 1 AS r FROM counts),
spot AS (SELECT (count(*) - 1) * 0.98e0 AS pos FROM counts),
ends AS (
  SELECT pos, max(CASE WHEN r = floor(pos) THEN n_intervals END) AS lo,
         max(CASE WHEN r = ceil(pos) THEN n_intervals END) AS hi FROM ranked, spot GROUP BY pos)
SELECT CASE WHEN floor(pos) = ceil(pos) THEN CAST(lo AS double)
            ELSE (ceil(pos) - pos) * lo + (pos - floor(pos)) * hi END AS p FROM ends""")
def _(fx):
    return summary.interval_percentile(strat_counts(fx), 0.98)


@register("total_intervals", with_(_BORES, _STRAT, _COUNTS) + "SELECT CAST(sum(n_intervals) AS bigint) AS n_intervals FROM counts")
def _(fx):
    return summary.total_intervals(strat_counts(fx))


@register("deepest_interval", """
SELECT "HydroCode" AS bore_key, max("ToDepth") AS deepest_m FROM fx_ngis_boreholelog
WHERE "HydroCode" IS NOT NULL GROUP BY "HydroCode" """)
def _(fx):
    return summary.deepest_interval(bores(fx), strat(fx))


_TOTAL = """
deepest AS (SELECT bore_key, max(bottom_depth_m) AS deepest_m FROM strat WHERE bore_key IS NOT NULL GROUP BY bore_key),
totals AS (SELECT b.*, coalesce(bore_depth_m, drilled_depth_m, deepest_m) AS total_depth_m
           FROM bores b LEFT JOIN deepest d ON b.bore_key = d.bore_key)"""


@register("total_depth", with_(_BORES, _STRAT, _TOTAL) + "SELECT row_no, bore_key, total_depth_m FROM totals")
def _(fx):
    return summary.with_total_depth(bores(fx), strat(fx)).select("row_no", "bore_key", "total_depth_m")


@register("layer_counts", """
SELECT 'bores' AS layer, count(*) AS n_rows FROM fx_ngis_bore
UNION ALL SELECT 'stratigraphy', count(*) FROM fx_ngis_boreholelog
UNION ALL SELECT 'earth_material', count(*) FROM fx_ngis_lithologylog
UNION ALL SELECT 'construction', count(*) FROM fx_ngis_constructionlog""")
def _(fx):
    return summary.rows_per_layer({
        "bores": fx.fx_ngis_bore, "stratigraphy": fx.fx_ngis_boreholelog,
        "earth_material": fx.fx_ngis_lithologylog, "construction": fx.fx_ngis_constructionlog,
    })


@register("distinct_keys", """
SELECT DISTINCT try_cast("ENO" AS bigint) AS eno FROM fx_ga_strat WHERE try_cast("ENO" AS bigint) IS NOT NULL""")
def _(fx):
    return summary.distinct_keys(ga_strat(fx))


@register("interval_rows", """
SELECT "HydroCode" AS bore_key, row_number() OVER (PARTITION BY "HydroCode" ORDER BY row_no) AS position,
       row_no, "Description" AS description
FROM fx_ngis_boreholelog WHERE "HydroCode" IS NOT NULL""")
def _(fx):
    logs = fx.fx_ngis_boreholelog.select(F.col("HydroCode").alias("bore_key"), "row_no", F.col("Description").alias("description"))
    return ordinal.interval_rows(logs)


def _lists_sql(limit):
    return f"""
WITH numbered AS (
  SELECT "HydroCode" AS bore_key, row_no,
         row_number() OVER (PARTITION BY "HydroCode" ORDER BY row_no) - 1 AS pos,
         count(*) OVER (PARTITION BY "HydroCode") AS total
  FROM fx_ngis_boreholelog WHERE "HydroCode" IS NOT NULL)
SELECT bore_key, pos // {limit} AS part, (total + {limit} - 1) // {limit} AS n_parts, count(*) AS n,
       string_agg(CAST(row_no AS varchar), ',' ORDER BY row_no) AS rows_in_order
FROM numbered GROUP BY ALL"""


def _lists(fx, limit, columns):
    lists = ordinal.interval_lists(strat(fx), limit, columns=columns)
    in_order = F.array_join(F.transform("intervals", lambda i: i["row_no"].cast("string")), ",")
    return lists.select("bore_key", "part", "n_parts", "n", in_order.alias("rows_in_order"))


@register("interval_lists", _lists_sql(1000))
def _(fx):
    return _lists(fx, 1000, ["row_no", "unit", "top_depth_m", "bottom_depth_m"])


@register("interval_lists_in_parts", _lists_sql(40))
def _(fx):
    return _lists(fx, 40, ["row_no", "unit"])


@register("validity_summary", with_(_STRAT) + """
SELECT valid, invalid_reason, count(*) AS n FROM strat GROUP BY valid, invalid_reason""")
def _(fx):
    return summary.validity_summary(strat(fx))


# Derived columns and row ids -------------------------------------------------------------------

_AHD = """coalesce(l.top_elev_m_ahd, l.ref_elev_m_ahd - l.top_depth_m) AS {top},
       coalesce(l.bottom_elev_m_ahd, l.ref_elev_m_ahd - l.bottom_depth_m) AS {base}"""


@register("ahd_elevation", with_(_STRAT) + f"SELECT row_no, {_AHD.format(top='top_ahd_m', base='bottom_ahd_m')} FROM strat l")
def _(fx):
    return compilation.with_elevations(strat(fx)).select("row_no", "top_ahd_m", "bottom_ahd_m")


_UNITS = f"""
units AS (
  SELECT row_number() OVER (PARTITION BY h.source ORDER BY h.row_no, l.row_no) AS "OBJECTID",
       {_NS} AS "GA_GUID", {_NS} AS "GA_BOREHOLE_GUID", h.eno AS "GA_ENO",
       coalesce(h.identifier, CAST(h.eno AS varchar)) AS "UWI",
       coalesce(l.borehole_name, h.name) AS "BOREHOLE_NAME", h.latitude AS "GDA94_LATITUDE",
       h.longitude AS "GDA94_LONGITUDE", h.elevation_m AS "GL_AHD_M", {_NS} AS "WD_AHD_M",
       {_NS} AS "SRTM_HE_AHD_M", coalesce(l.ref_elev_m_ahd, h.elevation_m) AS "DATUM_ELEVATION_AHD_M",
       h.depth_reference AS "DATUM_NAME", h.total_depth_m AS "TD_MD_M", l.unit AS "SOURCE_UNIT",
       l.unit AS "GA_UNIT", l.unit_pid AS "GA_ASUD_NO", l.top_depth_m AS "TOP_MD_M",
       l.bottom_depth_m AS "BASE_MD_M", {_AHD.format(top='"TOP_AHD_M"', base='"BASE_AHD_M"')},
       coalesce(l.top_elev_m_ahd, l.ref_elev_m_ahd - l.top_depth_m) AS "Z_AHD_M",
       h.source AS "DATA_SOURCE", {_NS} AS "GA_HYDROSTRAT", {_NS} AS "HIERARCHY", {_NS} AS "TAG",
       {_NS} AS "Z_M_SRTM", {_NS} AS "PREFERRED", l.comment AS "COMMENT"
  FROM totals h JOIN strat l ON h.bore_key = l.bore_key)"""


@register("units_compilation", with_(_BORES, _STRAT, _TOTAL, _UNITS) + "SELECT * FROM units")
def _(fx):
    return compilation.units_compilation(bores(fx), strat(fx))


@register("object_ids", with_(_BORES, _STRAT) + """
SELECT h.source AS source, h.row_no AS bore_row_no, l.row_no AS log_row_no,
       row_number() OVER (PARTITION BY h.source ORDER BY h.row_no, l.row_no) AS object_id
FROM bores h JOIN strat l ON h.bore_key = l.bore_key""")
def _(fx):
    joined = joins.join_logs(bores(fx), strat(fx), ["source", "row_no"]).select(
        F.col("h_source").alias("source"), F.col("h_row_no").alias("bore_row_no"),
        F.col("l_row_no").alias("log_row_no"),
    )
    return ordinal.with_ordinal(joined, ["bore_row_no", "log_row_no"], ["source"], "object_id")


@register("units_csv", with_(_BORES, _STRAT, _TOTAL, _UNITS) + """
SELECT "DATA_SOURCE", "OBJECTID", "UWI", "DATUM_NAME", "SOURCE_UNIT", "COMMENT", "GA_GUID", "TOP_MD_M", "TD_MD_M" FROM units""")
def _(fx):
    path = shared_path(fx.spark, "units-csv")
    sinks.write_csv(compilation.units_compilation(bores(fx), strat(fx)), path, by="DATA_SOURCE", order="OBJECTID")
    # Files alone, one by one: the folder names must not be needed.
    back = fx.spark.read.option("header", True).option("recursiveFileLookup", True).csv(path)
    if tuple(back.columns) != tuple(compilation.UNIT_COLUMNS):
        raise ValueError(f"unexpected header: {back.columns}")
    return back.select(
        "DATA_SOURCE", F.col("OBJECTID").cast("bigint"), "UWI", "DATUM_NAME", "SOURCE_UNIT", "COMMENT",
        "GA_GUID", F.col("TOP_MD_M").cast("double"), F.col("TD_MD_M").cast("double"),
    )


# Keys and text ---------------------------------------------------------------------------------


@register("region_keys", """
SELECT box_id, sha256(concat_ws(',', x0 || ' ' || y0, x1 || ' ' || y0, x1 || ' ' || y1, x0 || ' ' || y1)) AS region_key
FROM (SELECT box_id, CAST(floor(min_lon * 1e6 + 0.5e0) AS bigint) AS x0, CAST(floor(min_lat * 1e6 + 0.5e0) AS bigint) AS y0,
             CAST(floor(max_lon * 1e6 + 0.5e0) AS bigint) AS x1, CAST(floor(max_lat * 1e6 + 0.5e0) AS bigint) AS y1
      FROM fx_box WHERE min_lon < max_lon AND min_lat < max_lat)""")
def _(fx):
    boxes = filters.regions_from_boxes(fx.fx_box, *BOUNDS).where("region_valid")
    return boxes.select("box_id", region_key(F.col("shape")).alias("region_key"))


@register("query_keys", """
SELECT box_id, concat(sha256(CAST(box_id AS varchar)), '-', substr(sha256(concat('svc|layer|', coalesce(pred, ''))), 1, 12)) AS query_key
FROM (SELECT box_id, CASE WHEN box_id % 2 = 0 THEN 'a > ' || box_id END AS pred FROM fx_box)""")
def _(fx):
    predicate = F.when(F.col("box_id") % 2 == 0, F.concat(F.lit("a > "), "box_id"))
    footprint = F.sha2(F.col("box_id").cast("string"), 256)
    key = query_key(footprint, F.lit("svc"), F.lit("layer"), predicate)
    return fx.fx_box.select("box_id", key.alias("query_key"))


@register("region_query_keys", """
SELECT box_id, concat(sha256(concat_ws(',', x0 || ' ' || y0, x1 || ' ' || y0, x1 || ' ' || y1, x0 || ' ' || y1)), '-',
         substr(sha256(concat('svc|layer|', coalesce(pred, ''))), 1, 12)) AS query_key
FROM (SELECT box_id, CASE WHEN box_id % 2 = 0 THEN 'a > ' || box_id END AS pred,
             CAST(floor(min_lon * 1e6 + 0.5e0) AS bigint) AS x0, CAST(floor(min_lat * 1e6 + 0.5e0) AS bigint) AS y0,
             CAST(floor(max_lon * 1e6 + 0.5e0) AS bigint) AS x1, CAST(floor(max_lat * 1e6 + 0.5e0) AS bigint) AS y1
      FROM fx_box WHERE min_lon < max_lon AND min_lat < max_lat)""")
def _(fx):
    boxes = filters.regions_from_boxes(fx.fx_box, *BOUNDS).where("region_valid")
    predicate = F.when(F.col("box_id") % 2 == 0, F.concat(F.lit("a > "), "box_id"))
    key = query_key(region_key(F.col("shape")), F.lit("svc"), F.lit("layer"), predicate)
    return boxes.select("box_id", key.alias("query_key"))


@register("log_set_key", """
WITH k AS (SELECT DISTINCT b, eno, md5(CAST(eno AS varchar)) AS d FROM (
  SELECT "STRAT_UNIT_NAME" AS b, try_cast("ENO" AS bigint) AS eno FROM fx_ga_strat) WHERE eno IS NOT NULL),
s AS (SELECT b, count(*) AS n_keys, sum(('0x' || substr(d, 1, 12))::bigint) AS p1,
             sum(('0x' || substr(d, 13, 12))::bigint) AS p2 FROM k GROUP BY b)
SELECT b AS unit, n_keys, concat('logs-stratigraphy-', substr(sha256(concat_ws('|', n_keys, p1, p2)), 1, 12)) AS log_key FROM s""")
def _(fx):
    digest = key_set_digest(ga_strat(fx), "eno", by=["unit"])
    return digest.select("unit", "n_keys", log_key(F.lit("stratigraphy"), F.col("key_digest")).alias("log_key"))


_CITE = """concat_ws(' ', CASE WHEN citation IS NULL OR citation = '' THEN 'Geoscience Australia borehole data.' ELSE citation END,
  'Accessed ' || strftime(DATE '1970-01-01' + CAST(floor(fetched_at / 86400) AS integer), '%Y-%m-%d') || '.',
  'Licensed ' || license || '.', 'Source: ' || source_url)"""


@register("citation_text", f"SELECT query, source_ord, {_CITE} AS citation_text FROM fx_provenance")
def _(fx):
    text = citation_text(F.col("citation"), F.col("fetched_at"), F.col("license"), F.col("source_url"))
    return fx.fx_provenance.select("query", "source_ord", text.alias("citation_text"))


@register("federated_citation", f"""
WITH t AS (SELECT query, {_CITE} AS txt, min(source_ord) AS ord FROM fx_provenance GROUP BY 1, 2)
SELECT query, string_agg(txt, ' ' ORDER BY ord, txt) AS citation FROM t GROUP BY query""")
def _(fx):
    return federation.federated_citation(fx.fx_provenance, "query")


@register("federated_provenance", """
SELECT 'A' AS source, 0 AS source_ord, query, citation, license FROM fx_provenance WHERE source_ord % 2 = 0
UNION ALL SELECT 'B', 1, query, citation, license FROM fx_provenance WHERE source_ord % 2 = 1""")
def _(fx):
    rows = fx.fx_provenance
    parts = {"A": rows.where("source_ord % 2 = 0"), "B": rows.where("source_ord % 2 = 1")}
    return federation.federated_provenance(
        {tag: part.select("query", "citation", "license") for tag, part in parts.items()}
    ).select("source", "source_ord", "query", "citation", "license")


# Snapshots -------------------------------------------------------------------------------------

_NEWEST = """
newest AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY "key" ORDER BY fetched_at DESC, entry DESC) AS rn FROM fx_entries)
  WHERE rn = 1)"""
_EXPECTED = """
expected AS (
  SELECT state, layer, concat('ngis-', lower(state), '-', layer, '-opt1') AS "key",
         concat(state, '|', zip_md5, '|opt1') AS stamp
  FROM (SELECT *, unnest(['bores', 'stratigraphy', 'earth_material', 'construction']) AS layer FROM fx_states))"""


def newest(fx: Fixtures) -> DataFrame:
    return snapshot.newest_entries(fx.fx_entries)


@register("snapshot_gate", with_(_NEWEST, _EXPECTED) + """,
gate AS (
  SELECT state, bool_and(n."key" IS NOT NULL) AS present,
         bool_and(coalesce(n.server_fingerprint = stamp, false)) AS fresh
  FROM expected e LEFT JOIN newest n ON e."key" = n."key" GROUP BY state)
SELECT *, CASE WHEN fresh OR present THEN 'serve' ELSE 'error' END AS action FROM gate""")
def _(fx):
    gate = snapshot.snapshot_gate(snapshot.expected_layers(fx.fx_states), newest(fx))
    return snapshot.gate_action(gate, offline=True)


@register("freshness_action", with_(_NEWEST) + f"""
SELECT a."key" AS "key", validator, CASE
  WHEN offline AND n."key" IS NOT NULL THEN 'serve' WHEN offline THEN 'error'
  WHEN force OR n."key" IS NULL OR {NOW}e0 - n.fetched_at > 2592000 THEN 'refetch'
  WHEN not_modified THEN 'serve'
  WHEN validator = 'count' AND n.server_fingerprint IS NOT DISTINCT FROM current_fingerprint THEN 'serve'
  WHEN validator = 'etag' AND n.etag = current_etag THEN 'serve'
  WHEN validator = 'none' THEN 'serve' ELSE 'refetch' END AS action
FROM fx_asked a LEFT JOIN newest n ON a."key" = n."key" """)
def _(fx):
    return snapshot.freshness_action(fx.fx_asked, newest(fx), NOW).select("key", "validator", "action")


@register("superseded_sweep", with_(_NEWEST, _EXPECTED) + """
SELECT "key", entry FROM newest WHERE "key" NOT IN (SELECT "key" FROM expected)""")
def _(fx):
    keep = snapshot.expected_layers(fx.fx_states)
    return snapshot.superseded(newest(fx), keep).select("key", "entry")


@register("manifest_summary", with_(_NEWEST) + """
SELECT count(*) AS entry_count, CAST(sum(feature_count) AS bigint) AS feature_count,
       CAST(sum(size_bytes) AS bigint) AS total_bytes FROM newest""")
def _(fx):
    return snapshot.manifest_summary(newest(fx))


@register("snapshot_roundtrip", """
SELECT row_no, "HydroCode", "Description", "FromDepth", "ToDepth",
       CASE WHEN "HydroCode" IS NULL THEN 0 ELSE 1 END AS keyed,
       (SELECT count(*) FROM fx_ngis_boreholelog) AS feature_count FROM fx_ngis_boreholelog""")
def _(fx):
    store = SnapshotStore(fx.spark, shared_path(fx.spark, "snapshots"))
    store.put("logs", fx.fx_ngis_boreholelog, {"license": "CC BY 4.0"}, now=NOW)
    about = store.provenance("logs")
    return store.get("logs").select(
        "row_no", "HydroCode", "Description", "FromDepth", "ToDepth",
        F.col("HydroCode").isNotNull().cast("int").alias("keyed"),
        F.lit(about["feature_count"]).cast("bigint").alias("feature_count"),
    )


# Landed files ----------------------------------------------------------------------------------


def land_pages(fx: Fixtures, features: DataFrame, size: int = 1000) -> str:
    """Write features (``row_no, geometry, properties``) as pages of at most ``size``, a page a line.

    A range of rows lies in order in one task, so its features are written one after the other, and a page
    also ends where a range does: pages are not shuffled again, nor held as arrays.
    """
    path = shared_path(fx.spark, "pages")
    paged = ordinal.with_ordinal(features, ["row_no"], name="_n", ends="_end")
    place = (F.col("_end.place") - 1) % size
    closes = F.col("_end.last") | (place == size - 1)
    lead = F.when(place == 0, '{"features":[').otherwise(",")
    rest = F.when(closes, F.concat(F.lit('],"numberMatched":'), (place + 1).cast("string"), F.lit("}\n"))).otherwise("")
    feature = F.to_json(F.struct("geometry", "properties"))
    # A blank instead of a line's end after each feature, as a page is one line.
    paged.select(F.concat(lead, feature, rest).alias("value")).write.option("lineSep", " ").text(path)
    return path


def plain_features(raw: DataFrame) -> DataFrame:
    """Log records as features without geometry."""
    nowhere = F.lit(None).cast("struct<type:string,coordinates:array<double>>")
    return raw.select("row_no", nowhere.alias("geometry"), F.struct(*(c for c in raw.columns if c != "row_no")).alias("properties"))


@register("header_pages_scan", with_(_GA) + f"SELECT {_HEADER} FROM ga")
def _(fx):
    raw = fx.fx_ga_header
    point = F.struct(
        F.lit("Point").alias("type"), F.array("geom_lon", "geom_lat").alias("coordinates")
    )
    props = F.struct(*(c for c in raw.columns if c not in ("geom_lon", "geom_lat")))
    features = raw.select(
        F.col("eno").alias("row_no"), F.when(F.col("geom_lon").isNotNull(), point).alias("geometry"),
        props.alias("properties"),
    )
    landed_headers = landed.read_header_features(fx.spark, land_pages(fx, features), multi_line=False)
    return mapping.national_headers(landed_headers).select(*mapping.HEADER_COLUMNS)


@register("missing_fields", """
SELECT 'headers' AS layer, field FROM (VALUES ('state')) t(field)
UNION ALL SELECT 'stratigraphy', field FROM (VALUES ('BOREHOLE_PID'), ('INTERVAL_LENGTH_M')) t(field)
WHERE EXISTS (SELECT 1 FROM fx_ga_header) AND EXISTS (SELECT 1 FROM fx_ga_strat)""")
def _(fx):
    def features(raw, order):
        nowhere = F.lit(None).cast("struct<type:string,coordinates:array<double>>")
        props = F.struct(*(c for c in raw.columns if c != "row_no"))
        return raw.select(F.col(order).alias("row_no"), nowhere.alias("geometry"), props.alias("properties"))

    headers = landed.read_header_features(fx.spark, land_pages(fx, features(fx.fx_ga_header, "eno")), multi_line=False)
    logs = landed.read_log_features(
        fx.spark, land_pages(fx, features(fx.fx_ga_strat, "row_no")), "stratigraphy", multi_line=False
    )
    return contracts.missing_fields(headers, "headers").unionByName(contracts.missing_fields(logs, "stratigraphy"))


@register("log_pages_scan", with_(_GA_STRAT) + f"""
SELECT {_LOG}, {_PAYLOAD['stratigraphy']}, {_FLAGS} FROM gs WHERE eno IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 0)""")
def _(fx):
    raw = fx.fx_ga_strat
    features = raw.select(
        "row_no", F.lit(None).cast("struct<type:string,coordinates:array<double>>").alias("geometry"),
        F.struct(*(c for c in raw.columns if c != "row_no")).alias("properties"),
    )
    logs = mapping.national_logs(
        landed.read_log_features(
            fx.spark, land_pages(fx, features), "stratigraphy", multi_line=False
        ),
        "stratigraphy",
    )
    wanted = ga_headers(fx).where("eno % 2 = 0")
    return joins.logs_of(logs, wanted).select(
        *[c.strip() for c in f"{_LOG}, {_PAYLOAD['stratigraphy']}, {_FLAGS}".split(",")]
    )


@register("earth_pages_scan", f"""
WITH e0 AS (
  SELECT CAST("ENO" AS bigint) AS eno, {_txt('"BOREHOLE_NAME"')} AS borehole_name,
         "INTERVAL_BEGIN_M" AS top_depth_m, "INTERVAL_END_M" AS bottom_depth_m,
         {_ND} AS ref_elev_m_ahd, {_ND} AS top_elev_m_ahd, {_ND} AS bottom_elev_m_ahd,
         "LITHOLOGY" AS lithology, "LITHOLOGY_GROUP" AS lithology_group,
         {_txt('"LITHOLOGY_QUALIFIER"')} AS lithology_qualifier, "EARTH_MATERIAL_DESC" AS description,
         {_NS} AS geological_province, "EARTH_MATERIAL_ID" AS earth_material_id FROM fx_ga_earth),
e1 AS (SELECT *, {_REASON.format(more="")} AS invalid_reason FROM e0)
SELECT *, invalid_reason IS NULL AS valid FROM e1 WHERE eno IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 1)""")
def _(fx):
    path = land_pages(fx, plain_features(fx.fx_ga_earth))
    logs = mapping.national_logs(landed.read_log_features(fx.spark, path, "earth_material", multi_line=False), "earth_material")
    found = joins.logs_of(logs, ga_headers(fx).where("eno % 2 = 1"))
    return found.select(*[c.strip() for c in f"{_LOG}, {_PAYLOAD['earth_material']}, {_FLAGS}".split(",")])


@register("split_pages_scan", f"""
SELECT CAST("ENO" AS bigint) AS eno, {_txt('"BOREHOLE_NAME"')} AS borehole_name,
       "INTERVAL_BEGIN_M" AS top_depth_m, "INTERVAL_END_M" AS bottom_depth_m,
       "LITHOLOGY" AS lithology, {_txt('"LITHOLOGY_QUALIFIER"')} AS lithology_qualifier,
       concat('}},{{"features":[{{"', "EARTH_MATERIAL_DESC", ']') AS description, "EARTH_MATERIAL_ID" AS earth_material_id
FROM fx_ga_earth""")
def _(fx):
    """Pages cut between tasks, whose texts look like the borders of features."""
    odd = fx.fx_ga_earth.withColumn(
        "EARTH_MATERIAL_DESC", F.concat(F.lit('},{"features":[{"'), "EARTH_MATERIAL_DESC", F.lit("]"))
    )
    features = landed.read_log_features(fx.spark, land_pages(fx, plain_features(odd)), "earth_material", split=True)
    return mapping.national_logs(features, "earth_material").select(
        "eno", "borehole_name", "top_depth_m", "bottom_depth_m", "lithology", "lithology_qualifier",
        "description", "earth_material_id",
    )


@register("hydro_pages_scan", """
SELECT CAST(ufi AS varchar) AS ufi, feature, prodty, min_lon, min_lat, max_lon, max_lat, CAST(1 AS integer) AS n_rings FROM fx_hydro""")
def _(fx):
    raw = fx.fx_hydro
    corners = [("min_lon", "min_lat"), ("max_lon", "min_lat"), ("max_lon", "max_lat"),
               ("min_lon", "max_lat"), ("min_lon", "min_lat")]
    ring = F.array(*(F.array(x, y) for x, y in corners))
    as_text = F.when(F.col("ufi") % 2 == 0, F.to_json(F.array(ring))).otherwise(
        F.to_json(F.array(F.array(ring)))
    )
    kind = F.when(F.col("ufi") % 2 == 0, "Polygon").otherwise("MultiPolygon")
    props = F.to_json(F.struct("ufi", "feature", "prodty"))
    feature = F.concat(
        F.lit('{"geometry":{"type":"'), kind, F.lit('","coordinates":'), as_text,
        F.lit('},"properties":'), props, F.lit("}"),
    )
    path = shared_path(fx.spark, "hydro-pages")
    page = F.floor(F.col("ufi") / 10)
    raw.groupBy(page.alias("_page")).agg(
        F.concat(F.lit('{"features":['), F.array_join(F.collect_list(feature), ","), F.lit("]}")).alias("value")
    ).select("value").write.text(path)
    units = landed.read_hydro_features(fx.spark, path, multi_line=False)
    return units.select(
        "ufi", "feature", "prodty", *BOUNDS, F.size(F.flatten("shape")).alias("n_rings")
    )


@register("state_core_scan", with_(_BORES, _STRAT) + _export("bores", "strat", "stratigraphy", "h.bore_key = l.bore_key") + " AND h.source = 'NGIS:NSW'")
def _(fx):
    root = shared_path(fx.spark, "cores")
    fx.fx_ngis_bore.where("state_core = 'NSW'").write.parquet(f"{root}/NSW/NGIS_Bore")
    fx.fx_ngis_boreholelog.write.parquet(f"{root}/NSW/NGIS_BoreholeLog")
    core = landed.read_state_core(fx.spark, root, "nsw")
    return joins.export_logs(
        mapping.state_headers(core["bores"], "NGIS:NSW"),
        mapping.state_logs(core["stratigraphy"], "stratigraphy"), "stratigraphy",
    )


@register("log_tables", with_(_BORES, _CONSTRUCTION) + _export(
    "bores", "construction", "construction", "h.bore_key = l.bore_key AND h.source = 'NGIS:VIC'"))
def _(fx):
    path = shared_path(fx.spark, "log-tables")
    exported = joins.export_logs(bores(fx), construction(fx), "construction")
    sinks.write_table(sinks.laid_out(exported, "longitude", "latitude"), path)
    return filters.by_source(fx.spark.read.parquet(path), "VIC")


@register("store_box_export", with_(_BORES, _STRAT) + _export(
    f"(SELECT * FROM bores WHERE source = 'NGIS:NSW' AND {_IN_BOX})", "strat", "stratigraphy", "h.bore_key = l.bore_key"))
def _(fx):
    """The way of a user: land a state core, build its store, ask all sources of the store for a box."""
    return stored_state(fx).boreholes(region=BOX, sources="NSW").log_table("stratigraphy")


def stored_state(fx: Fixtures) -> AllBores:
    """All that the store of the NSW core holds."""
    return AllBores.from_store(state_store(fx))


def state_store(fx: Fixtures) -> SnapshotStore:
    """The NSW core, landed and built into a store of its own."""
    root, spark = shared_path(fx.spark, "cores"), fx.spark
    fx.fx_ngis_bore.where("state_core = 'NSW'").write.parquet(f"{root}/NSW/NGIS_Bore")
    fx.fx_ngis_boreholelog.write.parquet(f"{root}/NSW/NGIS_BoreholeLog")
    fx.fx_ngis_constructionlog.write.parquet(f"{root}/NSW/NGIS_ConstructionLog")
    store = SnapshotStore(spark, shared_path(spark, "store"))
    build_state(store, root, "nsw", now=NOW)
    return store


@register("store_checks", with_(_BORES, _STRAT) + """,
n AS (SELECT * FROM bores WHERE source = 'NGIS:NSW')
SELECT 'bores' AS layer, 'position_in_australia' AS "check", count(*) FILTER (longitude IS NOT NULL AND latitude IS NOT NULL) AS n_checked,
       count(*) FILTER (NOT (longitude BETWEEN 112 AND 154 AND latitude BETWEEN -44 AND -10)) AS n_failed FROM n
UNION ALL SELECT 'bores', 'header_has_key', count(*), count(*) FILTER (bore_key IS NULL) FROM n
UNION ALL SELECT 'stratigraphy', 'depths_numeric', count(*), count(*) FILTER (top_depth_m IS NULL OR bottom_depth_m IS NULL) FROM strat
UNION ALL SELECT 'stratigraphy', 'depths_not_negative', count(*) FILTER (top_depth_m IS NOT NULL AND bottom_depth_m IS NOT NULL), 0 FROM strat
UNION ALL SELECT 'stratigraphy', 'top_above_bottom', count(*) FILTER (top_depth_m IS NOT NULL AND bottom_depth_m IS NOT NULL),
       count(*) FILTER (top_depth_m > bottom_depth_m) FROM strat
UNION ALL SELECT 'stratigraphy', 'log_has_key', count(*), count(*) FILTER (bore_key IS NULL) FROM strat""")
def _(fx):
    """What the build's own writes counted, read back from beside the manifest."""
    store = state_store(fx)
    return federation.union_all(
        store.checks(f"ngis-nsw-{layer}-opt1").select(F.lit(layer).alias("layer"), "check", "n_checked", "n_failed")
        for layer in ("bores", "stratigraphy")
    )


@register("store_interval_counts", with_(_BORES, _STRAT) + f"""
SELECT row_no, bore_key, (SELECT count(*) FROM strat l WHERE l.bore_key = h.bore_key) AS n_intervals
FROM bores h WHERE source = 'NGIS:NSW' AND {_IN_BOX} AND bore_key IN (SELECT bore_key FROM strat)""")
def _(fx):
    """From what the build kept beside the logs, without opening them."""
    return stored_state(fx).boreholes(region=BOX, sources="NSW").interval_counts().select("row_no", "bore_key", "n_intervals")


@register("store_total_depths", with_(_BORES, _STRAT) + f"""
SELECT row_no, bore_key, coalesce(bore_depth_m, drilled_depth_m,
  (SELECT max(bottom_depth_m) FROM strat l WHERE l.bore_key = h.bore_key)) AS total_depth_m
FROM bores h WHERE source = 'NGIS:NSW' AND {_IN_BOX}""")
def _(fx):
    return stored_state(fx).boreholes(region=BOX, sources="NSW").total_depths().select("row_no", "bore_key", "total_depth_m")


@register("artifact_check", """
SELECT state, state <> 'QLD' AS size_ok, state = 'NSW' AS md5_ok FROM (
  SELECT DISTINCT CASE c_nationkey % 3 WHEN 0 THEN 'NSW' WHEN 1 THEN 'VIC' ELSE 'QLD' END AS state FROM customer)""")
def _(fx):
    """One small file per state, told by its customers; the registry is wrong on one sum and one size."""
    state = F.expr("CASE c_nationkey % 3 WHEN 0 THEN 'NSW' WHEN 1 THEN 'VIC' ELSE 'QLD' END")
    told = fx.table("customer").groupBy(state.alias("state")).agg(
        F.concat_ws(" ", F.count(F.lit(1)), F.sum("c_custkey")).alias("value")
    )
    root = shared_path(fx.spark, "archives")
    for code in ("NSW", "VIC", "QLD"):
        told.where(F.col("state") == code).select("value").coalesce(1).write.text(f"{root}/{code}")
    content = F.concat("value", F.lit("\n"))
    known = told.select(
        "state", (F.octet_length(content) + (F.col("state") == "QLD").cast("int")).cast("bigint").alias("zip_bytes"),
        F.md5(F.when(F.col("state") == "VIC", F.lit("other")).otherwise(content).cast("binary")).alias("zip_md5"),
    )
    return artifacts.check_artifacts(fx.spark, root, known, "*.txt").select("state", "size_ok", "md5_ok")


# Contract checks -------------------------------------------------------------------------------

_CHECKS = f"""
SELECT 'position_in_australia' AS "check", count(*) FILTER (longitude IS NOT NULL AND latitude IS NOT NULL) AS n_checked,
       count(*) FILTER (NOT (longitude BETWEEN 112 AND 154 AND latitude BETWEEN -44 AND -10)) AS n_failed FROM bores
UNION ALL SELECT 'position_in_box', count(*) FILTER (longitude IS NOT NULL AND latitude IS NOT NULL),
       count(*) FILTER (longitude IS NOT NULL AND latitude IS NOT NULL AND NOT ({_IN_BOX})) FROM bores
UNION ALL SELECT 'header_has_key', count(*), count(*) FILTER (bore_key IS NULL) FROM bores
UNION ALL SELECT 'identifier_is_pid', count(identifier), count(identifier) FROM bores
UNION ALL SELECT 'depths_numeric', count(*), count(*) FILTER (top_depth_m IS NULL OR bottom_depth_m IS NULL) FROM strat
UNION ALL SELECT 'depths_not_negative', count(*) FILTER (top_depth_m IS NOT NULL AND bottom_depth_m IS NOT NULL),
       count(*) FILTER (top_depth_m < 0 OR bottom_depth_m < 0 AND top_depth_m IS NOT NULL) FROM strat
UNION ALL SELECT 'top_above_bottom', count(*) FILTER (top_depth_m IS NOT NULL AND bottom_depth_m IS NOT NULL),
       count(*) FILTER (top_depth_m > bottom_depth_m) FROM strat
UNION ALL SELECT 'log_has_key', count(*), count(*) FILTER (bore_key IS NULL) FROM strat
UNION ALL SELECT 'log_key_in_set', count(bore_key),
       count(bore_key) FILTER (bore_key NOT IN (SELECT bore_key FROM bores WHERE bore_key IS NOT NULL)) FROM strat
UNION ALL SELECT 'feature_populated', 1, CASE WHEN bool_or(feature <> '') THEN 0 ELSE 1 END FROM fx_hydro
UNION ALL SELECT 'prodty_populated', 1, CASE WHEN bool_or(prodty <> '') THEN 0 ELSE 1 END FROM fx_hydro
UNION ALL SELECT 'rings_have_area', count(*), 0 FROM fx_hydro
UNION ALL SELECT 'vertices_in_australia', count(*),
       count(*) FILTER (min_lon < 112 OR max_lon > 154 OR min_lat < -44 OR max_lat > -10) FROM fx_hydro"""


@register("contract_report", with_(_BORES, _STRAT) + _CHECKS)
def _(fx):
    headers, logs, units = bores(fx), strat(fx), hydro_shapes(fx)
    return federation.union_all([
        contracts.header_checks(headers, BOX.bounds), contracts.log_checks(logs),
        contracts.logs_outside_set(logs, headers), contracts.populated(units, "feature", "prodty"),
        contracts.ring_sizes(units), contracts.vertices_in_australia(units),
    ])


@register("pid_report", """
SELECT 'identifier_is_pid' AS "check", count(*) AS n_checked, count(*) FILTER (eno % 3 = 0) AS n_failed FROM fx_ga_header
UNION ALL SELECT 'header_has_key', count(*), 0 FROM fx_ga_header
UNION ALL SELECT 'position_in_australia', count(*), count(*) FILTER ("GDA94_dlong" > 154) FROM fx_ga_header""")
def _(fx):
    host = F.when(F.col("eno") % 3 == 0, "http://pid.example").otherwise("http://pid.geoscience.gov.au")
    named = F.concat(host, F.lit("/samplingFeature/au/BH"), F.col("eno").cast("string"))
    return contracts.header_checks(ga_headers(fx).withColumn("identifier", named))


@register("ring_report", """
SELECT 'rings_have_area' AS "check", count(*) AS n_checked, count(*) FILTER (c_custkey % 7 = 0) AS n_failed FROM customer""")
def _(fx):
    """Rings as landed: closed squares, of which every seventh lost two of its five vertices."""
    corner = lambda dx, dy: F.struct((F.col("c_custkey") + dx).cast("double").alias("x"), F.lit(float(dy)).alias("y"))
    ring = F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1), corner(0, 0))
    landed_ring = F.when(F.col("c_custkey") % 7 == 0, F.slice(ring, 1, 3)).otherwise(ring)
    return contracts.ring_sizes(fx.table("customer").select(F.array(F.array(landed_ring)).alias("shape")))


@register("tagged_log_keys", """
SELECT 'log_key_in_set' AS "check", count(*) AS n_checked,
       count(*) FILTER (NOT EXISTS (SELECT 1 FROM fx_ngis_bore b WHERE b."HydroCode" = l."HydroCode")) AS n_failed
FROM fx_ngis_boreholelog l JOIN customer ON l."HydroCode" = concat('GW', CAST(c_custkey AS varchar))""")
def _(fx):
    """Within the source that both sides are tagged with; logs without a source are not checked."""
    return contracts.logs_outside_set(tagged_strat(fx).where("source IS NOT NULL"), bores(fx))


@register("page_totals", """
SELECT 'headers' AS layer, count(*) AS landed, count(*) AS announced, true AS complete FROM fx_ga_header
UNION ALL SELECT 'stratigraphy', count(*) FILTER (l_linenumber < 7), count(*), count(*) FILTER (l_linenumber >= 7) = 0 FROM lineitem""")
def _(fx):
    """Landed pages against the totals that they announce; some pages of the logs were never landed."""
    headers = fx.fx_ga_header.withColumn("row_no", F.col("eno"))
    lines = fx.table("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_no"), "l_linenumber")
    parts = []
    for layer, raw, kept in (("headers", headers, F.lit(True)), ("stratigraphy", lines, F.col("properties.l_linenumber") < 7)):
        total, features = raw.count(), plain_features(raw).where(kept)
        path = shared_path(fx.spark, "announced-pages")
        feature = F.struct("geometry", "properties")
        features.groupBy(F.pmod(F.xxhash64("row_no"), F.lit(8 + total // 500)).alias("_page")).agg(
            F.lit(total).alias("numberMatched"), F.collect_list(feature).alias("features")
        ).write.json(path)
        parts.append(landed.page_totals(landed.read_pages(fx.spark, path, multi_line=False), layer))
    return contracts.landed_totals(federation.union_all(parts)).select("layer", "landed", "announced", "complete")


@register("count_drift", """
SELECT layer, n_rows, expected, abs(n_rows - expected) <= expected * 0.2e0 AS within FROM (
  SELECT 'bores' AS layer, count(*) AS n_rows, (SELECT count(*) FROM customer) AS expected FROM fx_ngis_bore
  UNION ALL SELECT 'construction', count(*), (SELECT count(*) FROM orders) FROM fx_ngis_constructionlog)""")
def _(fx):
    rows = summary.rows_per_layer({"bores": fx.fx_ngis_bore, "construction": fx.fx_ngis_constructionlog})
    expected = summary.rows_per_layer({"bores": fx.table("customer"), "construction": fx.table("orders")})
    both = rows.join(expected.withColumnRenamed("n_rows", "expected"), "layer")
    return contracts.count_drift(both)


@register("landed_totals", """
SELECT l_returnflag AS layer, CAST(sum(l_linenumber) AS bigint) AS landed, CAST(max(l_orderkey) AS bigint) AS announced,
       sum(l_linenumber) = max(l_orderkey) AS complete FROM lineitem GROUP BY l_returnflag""")
def _(fx):
    pages = fx.table("lineitem").select(
        F.col("l_returnflag").alias("layer"), F.col("l_linenumber").cast("bigint").alias("n_features"),
        F.col("l_orderkey").alias("announced"),
    )
    return contracts.landed_totals(pages)


@register("fan_out", with_(_BORES, _STRAT, _COUNTS) + """
SELECT count(*) AS n_bores, CAST(sum(n_intervals) AS bigint) AS n_rows,
       sum(n_intervals) / count(*) BETWEEN 1 AND 100 AS plausible FROM counts""")
def _(fx):
    return contracts.fan_out(strat_counts(fx))
