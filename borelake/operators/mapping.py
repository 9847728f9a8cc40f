"""Raw layers to canonical headers and intervals.

Every function is one projection: Catalyst fuses it with the scan and prunes the raw columns that
end up unused. Raw columns a layer lacks become typed nulls. Mapped frames carry, beside the
canonical columns, ``bore_key`` (the text that joins headers to logs within a source), ``row_no``
when the raw layer has one, and ``source_attributes`` (the whole raw record as JSON).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import double_of, long_of, quoted, text_of, with_stripped
from ..functions.intervals import depth_or_unit_reason, depth_reason
from ..schema import HEADER_COLUMNS, HEADER_EXTRAS, LOG_PAYLOAD, LOG_PREFIX, check_kind, type_name

NATIONAL = "GA"

# Canonical column <- raw column, for each layer of each source family.
NATIONAL_HEADER = {
    "eno": "eno", "name": "name", "identifier": "identifier", "elevation_m": "elevation_m",
    "state": "state", "province": "geologicalProvinces", "purpose": "purpose", "status": "status",
    "drilling_method": "drillingMethod", "observation_method": "observationMethod",
    "data_custodian": "boreholeDataCustodian", "depth_reference": "depthReferencePoints",
}
STATE_HEADER = {
    "name": "StateBoreID", "identifier": "HydroCode", "longitude": "Longitude",
    "latitude": "Latitude", "elevation_m": "RefElev", "purpose": "FType", "status": "Status",
    "data_custodian": "Agency", "depth_reference": "RefElevDesc", "bore_depth_m": "BoreDepth",
    "drilled_depth_m": "DrilledDepth", "drilled_date": "DrilledDate",
}
NATIONAL_LOG = {
    "eno": "ENO", "borehole_name": "BOREHOLE_NAME", "top_depth_m": "INTERVAL_BEGIN_M",
    "bottom_depth_m": "INTERVAL_END_M", "ref_elev_m_ahd": "DEPTH_REF_POINT_ELEV_M_AHD",
    "top_elev_m_ahd": "INTERVAL_BEGIN_ELEV_M_AHD", "bottom_elev_m_ahd": "INTERVAL_END_ELEV_M_AHD",
}
STATE_LOG = {
    "borehole_name": "HydroCode", "top_depth_m": "FromDepth", "bottom_depth_m": "ToDepth",
    "ref_elev_m_ahd": "RefElev", "top_elev_m_ahd": "TopElev", "bottom_elev_m_ahd": "BottomElev",
}
NATIONAL_PAYLOAD = {
    "stratigraphy": {
        "unit": "STRAT_UNIT_NAME", "unit_pid": "STRAT_UNIT_PID", "older_age": "OLDER_AGE",
        "younger_age": "YOUNGER_AGE", "older_age_ma": "OLDER_AGE_MA",
        "younger_age_ma": "YOUNGER_AGE_MA", "top_contact": "TOP_CONTACT_NAME",
        "base_contact": "BASE_CONTACT_NAME", "geological_province": "GEOLOGICAL_PROVINCE",
        "stratigraphy_id": "STRATIGRAPHY_ID", "comment": "COMMENT",
    },
    "earth_material": {
        "lithology": "LITHOLOGY", "lithology_group": "LITHOLOGY_GROUP",
        "lithology_qualifier": "LITHOLOGY_QUALIFIER", "description": "EARTH_MATERIAL_DESC",
        "geological_province": "GEOLOGICAL_PROVINCE", "earth_material_id": "EARTH_MATERIAL_ID",
    },
    "construction": {
        "construction_type": "CONSTRUCTION_TYPE", "material": "MATERIAL",
        "inner_diameter": "INNER_DIAMETER", "outer_diameter": "OUTER_DIAMETER",
        "property": "PROPERTY", "property_size": "PROPERTY_SIZE", "drill_method": "DRILL_METHOD",
    },
}
STATE_PAYLOAD = {
    "stratigraphy": {"unit": "Description", "comment": "Comment"},
    "earth_material": {
        "lithology_group": "MajorLithCode", "lithology_qualifier": "MinorLithCode",
        "description": "Description",
    },
    "construction": {
        "construction_type": "ConstructionType", "material": "Material",
        "inner_diameter": "InnerDiameter", "outer_diameter": "OuterDiameter",
        "property": "Property", "property_size": "PropertySize", "drill_method": "DrillMethod",
    },
}
HYDRO_UNIT = {
    "feature": "feature", "type": "type", "distribution": "distbn", "productivity": "prodty",
    "aquifer_type": "aquif_ty", "ufi": "ufi",
}

# Raw columns a build adds, kept out of the raw record.
NOT_IN_HEADER_BAG = ("geometry", "geom_type", "geom_lon", "geom_lat", "point_lon", "point_lat")
CODE_BOUNDS = ("code_min_lon", "code_min_lat", "code_max_lon", "code_max_lat")
NOT_IN_LOG_BAG = ("geometry", "Longitude", "Latitude", "point_lon", "point_lat", *CODE_BOUNDS)
_CARRIED = ("row_no", "source")


def raw_bag(raw: DataFrame, leave_out: tuple[str, ...]) -> Column:
    """The raw record as JSON text, nulls kept, columns in their order; landed text if there is one."""
    if "source_attributes" in raw.columns:
        return F.col("source_attributes")
    kept = [
        quoted(c) for c in raw.columns
        if c not in leave_out and c not in _CARRIED and not c.startswith("_stripped_")
    ]
    if not kept:
        return F.lit("{}")
    return F.to_json(F.struct(*kept), {"ignoreNullFields": "false"})


def _read(raw: DataFrame, column: str, names: dict[str, str]) -> Column:
    name = names.get(column, "")
    reader = {"double": double_of, "bigint": long_of}.get(type_name(column), text_of)
    return reader(raw, name)


def _carried(raw: DataFrame) -> list[Column]:
    return [F.col("row_no")] if "row_no" in raw.columns else []


def _tag(raw: DataFrame, source: Column | str | None) -> Column | None:
    if source is None:
        return F.col("source") if "source" in raw.columns else None
    return source if isinstance(source, Column) else F.lit(source)


def point_columns(raw: DataFrame) -> tuple[Column, Column]:
    """Longitude and latitude of a national feature: its point, else its properties."""
    lon, lat = double_of(raw, "geom_lon"), double_of(raw, "geom_lat")
    if "geom_type" in raw.columns:
        is_point = F.col("geom_type") == "Point"
        lon, lat = F.when(is_point, lon), F.when(is_point, lat)
    return (
        F.coalesce(lon, double_of(raw, "GDA94_dlong")),
        F.coalesce(lat, double_of(raw, "GDA94_dlat")),
    )


def with_national_point(raw: DataFrame) -> DataFrame:
    """Adds ``point_lon``/``point_lat`` to national headers, as plain columns a scan can filter."""
    lon, lat = clean_position(*point_columns(raw))
    return raw.withColumn("point_lon", lon).withColumn("point_lat", lat)


def clean_position(lon: Column, lat: Column) -> tuple[Column, Column]:
    """A position needs both coordinates: one missing makes both null."""
    both = lon.isNotNull() & lat.isNotNull()
    return F.when(both, lon), F.when(both, lat)


def national_headers(raw: DataFrame) -> DataFrame:
    """National header features to canonical headers."""
    raw = with_stripped(raw, [*NATIONAL_HEADER.values(), "GDA94_dlong", "GDA94_dlat"])
    lon, lat = point_columns(raw)
    special = {"longitude": lon, "latitude": lat, "source": F.lit(NATIONAL)}
    columns = [
        special[c] if c in special else _read(raw, c, NATIONAL_HEADER)
        for c in HEADER_COLUMNS + HEADER_EXTRAS
    ]
    return raw.select(
        *_carried(raw),
        *(c.alias(n) for c, n in zip(columns, HEADER_COLUMNS + HEADER_EXTRAS, strict=True)),
        raw_bag(raw, NOT_IN_HEADER_BAG).alias("source_attributes"),
    ).withColumn("bore_key", F.col("eno").cast("string"))


def state_headers(raw: DataFrame, source: Column | str | None = None) -> DataFrame:
    """State bores to canonical headers; the state comes from the source tag, not the record."""
    tag = _tag(raw, source)
    if tag is None:
        raise ValueError("state bores need a source tag: pass source= or give a source column")
    raw = with_stripped(raw, STATE_HEADER.values())
    state = F.when(tag.contains(":"), F.element_at(F.split(tag, ":"), -1))
    special = {"eno": F.lit(None).cast("bigint"), "state": state, "source": tag}
    columns = [
        special[c] if c in special else _read(raw, c, STATE_HEADER)
        for c in HEADER_COLUMNS + HEADER_EXTRAS
    ]
    return raw.select(
        *_carried(raw),
        *(c.alias(n) for c, n in zip(columns, HEADER_COLUMNS + HEADER_EXTRAS, strict=True)),
        raw_bag(raw, NOT_IN_HEADER_BAG).alias("source_attributes"),
    ).withColumn("bore_key", F.col("identifier"))


def _intervals(
    raw: DataFrame,
    kind: str,
    names: dict[str, str],
    tag: Column | None,
    key: Column | None,
    state_rules: bool,
) -> DataFrame:
    payload = LOG_PAYLOAD[check_kind(kind)]
    plain = [c for c in LOG_PREFIX if c not in ("source", "longitude", "latitude")]
    raw = with_stripped(raw, names.values())
    mapped = raw.select(
        *_carried(raw),
        *([] if tag is None else [tag.alias("source")]),
        *([] if key is None else [key.alias("bore_key")]),
        *(_read(raw, c, names).alias(c) for c in (*plain, *payload)),
        raw_bag(raw, NOT_IN_LOG_BAG).alias("source_attributes"),
    )
    top, bottom = F.col("top_depth_m"), F.col("bottom_depth_m")
    if state_rules and kind == "stratigraphy":
        reason = depth_or_unit_reason(top, bottom, F.col("unit"))
    else:
        reason = depth_reason(top, bottom)
    return mapped.withColumn("invalid_reason", reason).withColumn(
        "valid", F.col("invalid_reason").isNull()
    )


def national_logs(raw: DataFrame, kind: str) -> DataFrame:
    """National log features to canonical intervals, keyed by borehole number."""
    names = {**NATIONAL_LOG, **NATIONAL_PAYLOAD[check_kind(kind)]}
    mapped = _intervals(raw, kind, names, F.lit(NATIONAL), None, state_rules=False)
    return mapped.withColumn("bore_key", F.col("eno").cast("string"))


def state_logs(raw: DataFrame, kind: str, source: Column | str | None = None) -> DataFrame:
    """State log rows to canonical intervals.

    The join key is the *raw* code: a padded code does not reach its bore. Without a source tag
    the rows join on the code alone.
    """
    code = quoted("HydroCode") if "HydroCode" in raw.columns else F.lit(None)
    names = {**STATE_LOG, **STATE_PAYLOAD[check_kind(kind)]}
    return _intervals(raw, kind, names, _tag(raw, source), code.cast("string"), state_rules=True)


def hydro_units(raw: DataFrame) -> DataFrame:
    """Readable names for the six attributes of a hydrogeology polygon; other columns stay."""
    renamed = [text_of(raw, name).alias(new) for new, name in HYDRO_UNIT.items()]
    others = [quoted(c) for c in raw.columns if c not in HYDRO_UNIT.values()]
    return raw.select(*renamed, *others)


def without_geometry(raw: DataFrame) -> DataFrame:
    """Attributes only."""
    return raw.drop("geometry", "geom_type", "geom_lon", "geom_lat")

