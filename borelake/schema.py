"""Canonical tables: column names, order and types."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed value: every coordinate is lon/lat in GDA94, never reprojected.
CRS = "EPSG:4283"

LOG_KINDS = ("stratigraphy", "earth_material", "construction")

# The contractual columns of each exported table, in order.
HEADER_COLUMNS = (
    "eno", "name", "identifier", "longitude", "latitude", "elevation_m", "state", "province",
    "purpose", "status", "drilling_method", "source", "bore_depth_m", "drilled_depth_m",
    "drilled_date",
)
HEADER_EXTRAS = ("observation_method", "data_custodian", "depth_reference")

LOG_PREFIX = (
    "source", "eno", "borehole_name", "longitude", "latitude", "top_depth_m", "bottom_depth_m",
    "ref_elev_m_ahd", "top_elev_m_ahd", "bottom_elev_m_ahd",
)
LOG_PAYLOAD = {
    "stratigraphy": (
        "unit", "unit_pid", "older_age", "younger_age", "older_age_ma", "younger_age_ma",
        "top_contact", "base_contact", "geological_province", "stratigraphy_id", "comment",
    ),
    "earth_material": (
        "lithology", "lithology_group", "lithology_qualifier", "description",
        "geological_province", "earth_material_id",
    ),
    "construction": (
        "construction_type", "material", "inner_diameter", "outer_diameter", "property",
        "property_size", "drill_method",
    ),
}

_DOUBLES = {
    "longitude", "latitude", "elevation_m", "bore_depth_m", "drilled_depth_m", "top_depth_m",
    "bottom_depth_m", "ref_elev_m_ahd", "top_elev_m_ahd", "bottom_elev_m_ahd", "older_age_ma",
    "younger_age_ma", "inner_diameter", "outer_diameter", "property_size",
}
_LONGS = {"eno", "stratigraphy_id", "earth_material_id"}


def check_kind(kind: str) -> str:
    """The log kind itself, or ``ValueError``."""
    if kind not in LOG_KINDS:
        raise ValueError(f"Unknown log kind {kind!r}; expected one of {', '.join(LOG_KINDS)}.")
    return kind


def type_name(column: str) -> str:
    """SQL type of a canonical column."""
    if column in _DOUBLES:
        return "double"
    if column in _LONGS:
        return "bigint"
    return "boolean" if column == "valid" else "string"


def export_columns(kind: str) -> tuple[str, ...]:
    """Columns of an exported log table."""
    return (*LOG_PREFIX, *LOG_PAYLOAD[check_kind(kind)], "valid", "invalid_reason")


def struct_of(columns) -> T.StructType:
    """A Spark schema for canonical columns."""
    return T.StructType.fromDDL(", ".join(f"`{c}` {type_name(c)}" for c in columns))
