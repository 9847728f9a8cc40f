"""Header-to-log joins.

The log side is the big one and is joined through ``spread_join``, so a bore that holds a third of
all intervals is spread over tasks. A side that only answers "is there a match" is made distinct
first, which leaves one row per key and task. Anything that can be aggregated before a join is
(see ``summary``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BROADCAST_LIMIT, park
from ..functions.coerce import double_of, long_of
from ..schema import HEADER_COLUMNS, LOG_PAYLOAD, check_kind
from .hot_keys import most_tasks, side_bytes, spread_join
from .mapping import CODE_BOUNDS, NATIONAL_HEADER, NATIONAL_LOG, clean_position
from .spatial_join import points_in_polygons


def last_positions(bores: DataFrame, order: str = "row_no") -> DataFrame:
    """``HydroCode`` to the position of its last bore row, even when that position is null.

    ``max_by`` combines map-side, so a code shared by a third of all bores costs one row per task.
    """
    position = F.struct(F.col("Longitude").alias("lon"), F.col("Latitude").alias("lat"))
    return (
        bores.where(F.col("HydroCode").isNotNull())
        .groupBy("HydroCode")
        .agg(F.max_by(position, F.col(order)).alias("_p"))
        .select("HydroCode", F.col("_p.lon").alias("_lon"), F.col("_p.lat").alias("_lat"))
    )


def with_bore_position(logs: DataFrame, bores: DataFrame, order: str = "row_no") -> DataFrame:
    """Every log row with its bore's position; rows without a bore stay, with null position."""
    kept = [c for c in logs.columns if c not in ("Longitude", "Latitude")]
    positions = park(last_positions(bores, order), "positions")
    joined = spread_join(logs.select(*kept), positions, ["HydroCode"], "left")
    return joined.select(
        *kept, F.col("_lon").alias("Longitude"), F.col("_lat").alias("Latitude")
    )


def bore_lookup(bores: DataFrame, order: str = "row_no") -> DataFrame:
    """What a code's logs need of its bores: the last one's position, and the envelope of all; one aggregate."""
    lon, lat = clean_position(double_of(bores, "Longitude"), double_of(bores, "Latitude"))
    placed = bores.select("HydroCode", order, F.struct(F.col("Longitude").alias("lon"), F.col("Latitude").alias("lat")).alias("_p"),
                          lon.alias("x"), lat.alias("y"))
    return placed.where(F.col("HydroCode").isNotNull()).groupBy("HydroCode").agg(
        F.max_by("_p", order).alias("_p"), F.min("x").alias("code_min_lon"), F.min("y").alias("code_min_lat"),
        F.max("x").alias("code_max_lon"), F.max("y").alias("code_max_lat"),
    ).select("HydroCode", F.col("_p.lon").alias("_lon"), F.col("_p.lat").alias("_lat"), *CODE_BOUNDS)


def with_bore_place(logs: DataFrame, lookup: DataFrame) -> DataFrame:
    """Every log row with its bore's position and its code's envelope, by one join with ``bore_lookup``.

    The layout of logs samples the join before it shuffles its rows, so they pass it twice. A lookup too large for a
    broadcast is hashed, which sorts no logs, while a task's share of it is within the broadcast limit.
    """
    kept = [c for c in logs.columns if c not in ("Longitude", "Latitude")]
    hint = "shuffle_hash" if side_bytes(lookup) <= BROADCAST_LIMIT * most_tasks(lookup) else None
    joined = spread_join(logs.select(*kept), lookup, ["HydroCode"], "left", limit=BROADCAST_LIMIT, hint=hint)
    return joined.select(*kept, F.col("_lon").alias("Longitude"), F.col("_lat").alias("Latitude"), *CODE_BOUNDS)


def with_code_bounds(logs: DataFrame, bores: DataFrame) -> DataFrame:
    """Every log row with the envelope of all bores of its code, so that a box prunes log scans.

    A code may name several bores, and its logs belong to each of them; so the last one's position
    alone would lose rows. Codes without a placed bore get nulls.
    """
    lon, lat = clean_position(double_of(bores, "Longitude"), double_of(bores, "Latitude"))
    bounds = _bounds_per(bores.select("HydroCode", lon.alias("x"), lat.alias("y")), "HydroCode")
    return spread_join(logs, park(bounds, "code-bounds"), ["HydroCode"], "left")


def with_number_bounds(logs: DataFrame, headers: DataFrame) -> DataFrame:
    """The same for national logs, by the borehole number that headers and logs read from their text."""
    eno = long_of(headers, NATIONAL_HEADER["eno"]).alias("_eno")
    bounds = _bounds_per(headers.select(eno, F.col("point_lon").alias("x"), F.col("point_lat").alias("y")), "_eno")
    numbered = logs.withColumn("_eno", long_of(logs, NATIONAL_LOG["eno"]))
    return spread_join(numbered, park(bounds, "code-bounds"), ["_eno"], "left").drop("_eno")


def _bounds_per(placed: DataFrame, key: str) -> DataFrame:
    return placed.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min("x").alias("code_min_lon"), F.min("y").alias("code_min_lat"),
        F.max("x").alias("code_max_lon"), F.max("y").alias("code_max_lat"),
    )


def logs_near(logs: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Logs whose code has a bore that may lie in the box; all logs of a table without such bounds."""
    if not set(CODE_BOUNDS) <= set(logs.columns):
        return logs
    x0, y0, x1, y1 = box
    return logs.where(
        (F.col("code_min_lon") <= x1) & (F.col("code_max_lon") >= x0)
        & (F.col("code_min_lat") <= y1) & (F.col("code_max_lat") >= y0)
    )


def with_point(raw: DataFrame, lon: str = "Longitude", lat: str = "Latitude") -> DataFrame:
    """Adds ``point_lon``/``point_lat``: parsed, NaN as missing, both or neither."""
    x, y = clean_position(double_of(raw, lon), double_of(raw, lat))
    return raw.withColumn("point_lon", x).withColumn("point_lat", y)


def join_keys(headers: DataFrame, logs: DataFrame) -> list[str]:
    """Logs that carry their own source join within it."""
    tagged = "source" in logs.columns and "source" in headers.columns
    return ["source", "bore_key"] if tagged else ["bore_key"]


def join_logs(
    headers: DataFrame, logs: DataFrame, header_columns: Sequence[str] | None = None
) -> DataFrame:
    """Headers to intervals; columns are prefixed ``h_`` and ``l_``. Two headers with one key each
    receive the same intervals.

    ``header_columns`` narrows the header side before it is measured and perhaps broadcast.
    """
    keys = join_keys(headers, logs)

    def renamed(df, columns, prefix):
        return df.select(*keys, *(F.col(c).alias(prefix + c) for c in columns if c not in keys))

    left = renamed(logs, logs.columns, "l_")
    return spread_join(left, renamed(headers, header_columns or headers.columns, "h_"), keys)


def export_logs(headers: DataFrame, logs: DataFrame, kind: str, carried: Sequence[str] = (), log_order: str | None = None) -> DataFrame:
    """The contractual interval table: header's position and source, interval's name else header's.

    ``carried``: further header columns, which stand last, then, under the name ``log_order``, the
    interval's own place among its landed rows.
    """
    payload = LOG_PAYLOAD[check_kind(kind)]
    joined = join_logs(headers, logs, ["source", "name", "longitude", "latitude", *carried])
    source = F.col("source") if "source" in joined.columns else F.col("h_source")
    return joined.select(
        source.alias("source"),
        F.col("l_eno").alias("eno"),
        F.coalesce("l_borehole_name", "h_name").alias("borehole_name"),
        F.col("h_longitude").alias("longitude"),
        F.col("h_latitude").alias("latitude"),
        *(
            F.col(f"l_{c}").alias(c)
            for c in (
                "top_depth_m", "bottom_depth_m", "ref_elev_m_ahd", "top_elev_m_ahd",
                "bottom_elev_m_ahd", *payload, "valid", "invalid_reason",
            )
        ),
        *(F.col(f"h_{c}").alias(c) for c in carried),
        *([F.col("l_row_no").alias(log_order)] if log_order else []),
    )


def logs_in_regions(
    headers: DataFrame, logs: DataFrame, regions: DataFrame, region_key: str, kind: str, shape: str = "shape"
) -> DataFrame:
    """The interval table of every region of a table: ``region_key`` and the contractual columns.

    Bores meet the regions first and carry the keys of all that hold them, so the logs are read and
    joined once, whatever number of regions asks for a bore; regions part again at the very end.
    An interval appears once for each region of its bore, and a region without intervals not at all.
    """
    needed = [c for c in dict.fromkeys(("bore_key", "row_no", "source", "name", "longitude", "latitude")) if c in headers.columns]
    asked = regions.select(F.col(region_key).alias("_region"), F.col(shape).alias("shape"))
    pairs = points_in_polygons(headers.select(*needed), asked)
    held = pairs.groupBy(*needed).agg(F.sort_array(F.collect_list("_region")).alias("_regions"))
    exported = export_logs(park(held, "bores-in-regions"), logs, kind, carried=("_regions",))
    rest = [c for c in exported.columns if c != "_regions"]
    return exported.select(F.explode("_regions").alias(region_key), *rest)


def in_query_order(headers: DataFrame, logs: DataFrame, kind: str) -> DataFrame:
    """The interval table with its order: ``source_ord, bore_row_no, log_row_no`` stand last.

    Sorting by them puts sources, bores and intervals as the query asked for them.
    """
    ordered = headers if "source_ord" in headers.columns else headers.withColumn("source_ord", F.lit(0))
    placed = ordered.withColumn("bore_row_no", F.col("row_no"))
    return export_logs(placed, logs, kind, ("source_ord", "bore_row_no"), log_order="log_row_no")


def export_headers(headers: DataFrame) -> DataFrame:
    """The contractual header table."""
    return headers.select(*HEADER_COLUMNS)


def logs_of(logs: DataFrame, headers: DataFrame) -> DataFrame:
    """Intervals whose bore is in ``headers``; columns unchanged.

    A frame without the key column passes through whole.
    """
    if "bore_key" not in logs.columns:
        return logs
    keys = join_keys(headers, logs)
    return spread_join(logs, headers.select(*keys).distinct(), keys, "left_semi")


def bores_with_logs(headers: DataFrame, logs: DataFrame) -> DataFrame:
    """Headers that have at least one interval."""
    keys = join_keys(headers, logs)
    return spread_join(headers, _logged_keys(logs, keys), keys, "left_semi")


def bores_without_logs(headers: DataFrame, logs: DataFrame) -> DataFrame:
    """Headers that have none, null keys included."""
    keys = join_keys(headers, logs)
    return spread_join(headers, _logged_keys(logs, keys), keys, "left_anti")


def _logged_keys(logs: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct keys of the logs, written once so that measuring them costs no second pass."""
    return park(logs.select(*keys).distinct(), "logged-keys")


def orphan_logs(logs: DataFrame, headers: DataFrame) -> DataFrame:
    """Intervals whose bore is not among ``headers``, null keys included."""
    keys = join_keys(headers, logs)
    return spread_join(logs, headers.select(*keys).distinct(), keys, "left_anti")
