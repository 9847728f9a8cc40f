"""Interval validity and elevations. Bad intervals are flagged, never dropped."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reasons an interval can be flagged with, and the unit name that flags one.
MISSING_DEPTH = "missing depth"
INVERTED = "inverted interval (top > bottom)"
UNKNOWN_UNIT = "unknown formation"
UNKNOWN_NAME = "unknown"


def depth_reason(top: Column, bottom: Column) -> Column:
    """Why the depths are unusable, or null. Zero thickness is fine."""
    return F.when(top.isNull() | bottom.isNull(), MISSING_DEPTH).when(top > bottom, INVERTED)


def depth_or_unit_reason(top: Column, bottom: Column, unit: Column) -> Column:
    """Depth reason first, then the unknown-unit reason used by state stratigraphy."""
    unknown = F.when(F.lower(unit) == UNKNOWN_NAME, UNKNOWN_UNIT)
    return F.coalesce(depth_reason(top, bottom), unknown)


def absolute_elevation(own: Column, reference: Column, depth: Column) -> Column:
    """Recorded elevation, else reference elevation minus depth; null when neither exists."""
    return F.coalesce(own, reference - depth)
