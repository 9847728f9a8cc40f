"""Region, attribute, source and validity filters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import parse_number
from ..functions.geometry import SHAPE_TYPE, box_shape, in_box, point_in_literal_parts
from ..functions.keys import eno_of_identifier
from ..region import Region
from ..sources.registry import STATE_EXTENTS
from .ordinal import equal_to, key_at
from .spatial_join import points_in_polygons

# Raw fields that hold measurements.
NUMERIC_FIELDS = ("elevation_m", "GDA94_dlong", "GDA94_dlat")
# More edges than this are not unrolled into the generated code; the grid join takes over.
INLINE_EDGES = 64


def region_shape(region: Region) -> Column:
    """The region as a constant shape column."""
    rings = [
        [F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ring)) for ring in rings]
        for rings in region.polygons
    ]
    return F.array(*(F.array(*polygon) for polygon in rings)).cast(SHAPE_TYPE)


def in_region(
    points: DataFrame, region: Region, lon: str = "longitude", lat: str = "latitude",
    refine: str = "exact",
) -> DataFrame:
    """Points inside a region, edges included; points without a position never match.

    The envelope conjunct is always present, so it prunes row groups. ``refine='envelope'`` stops
    there, which is what the national service does.
    """
    if refine not in ("exact", "envelope"):
        raise ValueError(f"refine must be 'exact' or 'envelope', not {refine!r}")
    near = points.where(in_box(F.col(lon), F.col(lat), region.bounds))
    if refine == "envelope" or region.is_box:
        return near
    if len(region.edges) <= INLINE_EDGES:
        return near.where(point_in_literal_parts(F.col(lon), F.col(lat), region.part_edges))
    one = points.sparkSession.createDataFrame([(region.shape(),)], f"shape {SHAPE_TYPE}")
    return points_in_polygons(near, one, lon=lon, lat=lat, how="left_semi")


def raw_in_region(raw: DataFrame, region: Region, refine: str = "exact") -> DataFrame | None:
    """The region filter on plain stored coordinates, so that its envelope reaches the scan.

    Uses ``point_lon``/``point_lat`` or numeric ``Longitude``/``Latitude``; None without either.
    A NaN lies in no box, so raw numbers filter like cleaned ones.
    """
    for lon, lat in (("point_lon", "point_lat"), ("Longitude", "Latitude")):
        if all(c in raw.columns and raw.schema[c].dataType == T.DoubleType() for c in (lon, lat)):
            return in_region(raw, region, lon, lat, refine)
    return None


def by_attribute(raw: DataFrame, predicate: str | None) -> DataFrame:
    """An SQL predicate over *raw* column names.

    The measured header fields arrive as text; in the predicate they are the numbers they hold, and
    null where they hold none. A property without a column is reached through
    ``get_json_object(source_attributes, '$.name')``.
    """
    if not predicate:
        return raw
    texts = [c for c in NUMERIC_FIELDS if c in raw.columns and raw.schema[c].dataType == T.StringType()]
    kept = {c: f"_text_{c}" for c in texts}
    typed = raw.withColumns({kept[c]: F.col(c) for c in texts}).withColumns({c: parse_number(F.col(c)) for c in texts})
    found = typed.where(F.expr(predicate))
    return found.withColumns({c: F.col(kept[c]) for c in texts}).select(*raw.columns) if texts else found


def single_header(headers: DataFrame, identifier) -> DataFrame:
    """The first header with a borehole number, given as a number, text or PID."""
    text = str(identifier).strip()
    number = int(text) if text.isdigit() else None
    if number is None:
        head, mark, tail = text.rpartition("BH")
        if not mark or not tail.isdigit():
            raise ValueError(f"Cannot derive a borehole number from identifier {identifier!r}.")
        number = int(tail)
    found = headers.where(F.col("eno") == F.lit(number))
    order = "row_no" if "row_no" in headers.columns else "bore_key"
    return found.orderBy(order).limit(1)


def with_identifier_eno(df: DataFrame, identifier: str = "identifier") -> DataFrame:
    """Adds ``identifier_eno``, the borehole number an identifier names."""
    return df.withColumn("identifier_eno", eno_of_identifier(F.col(identifier)))


def normal_sources(sources: str | Iterable[str] | None) -> set[str] | None:
    """Upper-cased source names; one bare name counts as a list of one; None means all."""
    if sources is None:
        return None
    names = [sources] if isinstance(sources, str) else list(sources)
    return {n.strip().upper() for n in names}


def source_tags(sources: str | Iterable[str] | None, states: Iterable[str] = tuple(STATE_EXTENTS)) -> list[str]:
    """Source tags a request names, national first: ``GA``, ``NGIS``, ``NGIS:NSW`` or ``NSW``."""
    wanted = normal_sources(sources)
    tags = ["GA"] if wanted is None or "GA" in wanted else []
    for state in states:
        code = state.upper()
        if wanted is None or wanted & {"NGIS", f"NGIS:{code}", code}:
            tags.append(f"NGIS:{code}")
    return tags


def by_source(df: DataFrame, sources: str | Iterable[str] | None) -> DataFrame:
    """Rows of the named sources; on a table partitioned by source this prunes partitions."""
    if sources is None:
        return df
    return df.where(F.col("source").isin(*source_tags(sources)))


def valid_only(logs: DataFrame) -> DataFrame:
    """Intervals fit for interpolation."""
    return logs.where("valid")


def keyed(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key is present."""
    return df.where(F.col(key).isNotNull())


def collection_keys(headers: DataFrame) -> DataFrame:
    """Borehole numbers of a collection: nulls skipped, repeats kept."""
    return keyed(headers.select("eno"), "eno")


def at_position(df: DataFrame, position: int, order: Sequence[str] = ("row_no",)) -> DataFrame:
    """The row at a position of the collection, counted from 0, or from the end where negative.

    No row is there beyond either end. ``order`` must be unique. The row is found by counting ranges of
    the ordering, without a sort of the table, and read by its key.
    """
    key = key_at(df, position, list(order))
    return df.where(F.lit(False)) if key is None else df.where(equal_to(key))


def regions_from_boxes(boxes: DataFrame, *bounds: str) -> DataFrame:
    """Adds ``shape`` and ``region_valid`` to a table of boxes; a reversed box is invalid."""
    x0, y0, x1, y1 = (F.col(b) for b in bounds)
    ordered = (x0 < x1) & (y0 < y1)
    return boxes.withColumn("shape", box_shape(x0, y0, x1, y1)).withColumn(
        "region_valid", F.coalesce(ordered, F.lit(False))
    )
