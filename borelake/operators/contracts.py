"""Checks that landed data still keeps its contract.

Each check is a set of conditional counts, so one pass over a table answers all of its checks.
Results are ``check, n_checked, n_failed``; a check passes when nothing failed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import double_of, long_of, text_of
from ..functions.geometry import in_box
from ..functions.keys import PID_PATTERN
from .joins import join_keys
from .mapping import NATIONAL_HEADER, NATIONAL_LOG, STATE_LOG

# Plausible positions, accepted drift of row counts and fan-out per logged bore.
AUSTRALIA = (112.0, -44.0, 154.0, -10.0)
COUNT_TOLERANCE = 0.20
FAN_OUT = (1, 100)
MIN_RING_VERTICES = 4

# Raw fields each layer must keep exposing.
REQUIRED_FIELDS = {
    "headers": ("eno", "name", "state", "elevation_m"),
    "stratigraphy": (
        "ENO", "BOREHOLE_PID", "BOREHOLE_NAME", "STRAT_UNIT_NAME", "INTERVAL_BEGIN_M",
        "INTERVAL_END_M", "INTERVAL_LENGTH_M", "DEPTH_REF_POINT_ELEV_M_AHD",
    ),
    "earth_material": (
        "ENO", "BOREHOLE_PID", "LITHOLOGY", "INTERVAL_BEGIN_M", "INTERVAL_END_M",
        "INTERVAL_LENGTH_M", "DEPTH_REF_POINT_ELEV_M_AHD",
    ),
    "hydrogeology": ("ufi", "feature", "type", "distbn", "prodty", "aquif_ty"),
}


def missing_fields(raw: DataFrame, layer: str) -> DataFrame:
    """``layer, field``: required fields the layer no longer has; names are compared exactly.

    Landed features are judged by the names in their own properties, since the reader gives every
    known column whether it was sent or not; other tables by their columns.
    """
    spark, required = raw.sparkSession, [(layer, f) for f in REQUIRED_FIELDS[layer]]
    asked = spark.createDataFrame(required, "layer string, field string")
    if "source_attributes" in raw.columns:
        names = F.explode(F.json_object_keys(F.col("source_attributes").cast("string")))
        present = raw.select(names.alias("field")).distinct()
    else:
        present = spark.createDataFrame([(c,) for c in raw.columns], "field string")
    return asked.join(F.broadcast(present.where(F.col("field").isin(*REQUIRED_FIELDS[layer]))), "field", "left_anti").select("layer", "field")


def missing_layers(expected: Iterable[str], seen: Iterable[str]) -> list[str]:
    """Expected layers that were not seen."""
    found = set(seen)
    return [layer for layer in expected if layer not in found]


# A check: the rows it applies to, and what those must hold.
Checks = dict[str, tuple[Column, Column]]


def check_counts(checks: Checks) -> list[Column]:
    """Two counts per check, ``<check>.n_checked`` and ``<check>.n_failed``, for any aggregate or observation."""
    counts = []
    for name, (applies, ok) in checks.items():
        failed = applies & ~F.coalesce(ok, F.lit(False))
        counts += [F.count_if(applies).alias(f"{name}.n_checked"), F.count_if(failed).alias(f"{name}.n_failed")]
    return counts


def _report(table: DataFrame, checks: Checks) -> DataFrame:
    """One pass: for each check count the rows it applies to and those that fail it."""
    counted = table.agg(*check_counts(checks))
    rows = [
        F.struct(F.lit(name).alias("check"), *(F.col(f"`{name}.{n}`").alias(n) for n in ("n_checked", "n_failed")))
        for name in checks
    ]
    return counted.select(F.inline(F.array(*rows)))


def position_conditions(lon: Column, lat: Column, key: Column) -> Checks:
    """Positions in Australia, and a key on every row."""
    placed = lon.isNotNull() & lat.isNotNull()
    return {
        "position_in_australia": (placed, in_box(lon, lat, AUSTRALIA)), "header_has_key": (F.lit(True), key.isNotNull()),
    }


def pid_conditions(identifier: Column) -> Checks:
    """Identifiers are well-formed PIDs where there are any."""
    return {"identifier_is_pid": (identifier.isNotNull(), identifier.rlike(PID_PATTERN))}


def depth_conditions(top: Column, bottom: Column, key: Column) -> Checks:
    """Depths present, not negative and not inverted, and a key on every row."""
    both = top.isNotNull() & bottom.isNotNull()
    return {
        "depths_numeric": (F.lit(True), both), "depths_not_negative": (both, (top >= 0) & (bottom >= 0)),
        "top_above_bottom": (both, top <= bottom), "log_has_key": (F.lit(True), key.isNotNull()),
    }


def ring_conditions(shape: Column) -> Checks:
    """Rings of four landed vertices at least, all of them in plausible bounds."""
    smallest = F.array_min(F.transform(F.flatten(shape), lambda ring: F.size(ring)))
    inside = F.forall(F.flatten(F.flatten(shape)), lambda v: in_box(v["x"], v["y"], AUSTRALIA))
    return {"rings_have_area": (F.lit(True), smallest >= MIN_RING_VERTICES), "vertices_in_australia": (F.lit(True), inside)}


def header_checks(headers: DataFrame, box=None) -> DataFrame:
    """Positions in Australia (and in the asked box), every header keyed, PIDs well formed."""
    lon, lat = F.col("longitude"), F.col("latitude")
    checks = position_conditions(lon, lat, F.col("bore_key")) | pid_conditions(F.col("identifier"))
    if box is not None:
        checks["position_in_box"] = (lon.isNotNull() & lat.isNotNull(), in_box(lon, lat, box))
    return _report(headers, checks)


def log_checks(logs: DataFrame) -> DataFrame:
    """Depths present, not negative and not inverted."""
    return _report(logs, depth_conditions(F.col("top_depth_m"), F.col("bottom_depth_m"), F.col("bore_key")))


def logs_outside_set(logs: DataFrame, headers: DataFrame) -> DataFrame:
    """Logs whose key is not among the headers' keys, within their source where both are tagged.

    Logs are counted per key before the anti join, so a hot key crosses the shuffle once per task.
    """
    keys = join_keys(headers, logs)
    per_key = logs.where(F.col("bore_key").isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n")
    )
    known = headers.where(F.col("bore_key").isNotNull()).select(*keys).distinct()
    marked = per_key.join(known.withColumn("_known", F.lit(True)), keys, "left")
    zero = F.lit(0).cast("bigint")
    return marked.agg(
        F.lit("log_key_in_set").alias("check"),
        F.coalesce(F.sum("_n"), zero).alias("n_checked"),
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_n"))), zero).alias("n_failed"),
    )


def populated(raw: DataFrame, *columns: str) -> DataFrame:
    """Each column holds a value somewhere: ``check, n_checked, n_failed``."""
    found = [
        F.struct(
            F.lit(f"{c}_populated").alias("check"),
            F.lit(1).cast("bigint").alias("n_checked"),
            F.when(F.coalesce(F.bool_or(F.col(c).isNotNull() & (F.col(c).cast("string") != "")), F.lit(False)), 0)
            .otherwise(1).cast("bigint").alias("n_failed"),
        )
        for c in columns
    ]
    return raw.agg(F.array(*found).alias("_r")).select(F.inline("_r"))


def count_drift(counts: DataFrame, tolerance: float = COUNT_TOLERANCE) -> DataFrame:
    """Adds ``within`` to ``n_rows, expected``: drift stays inside the tolerance."""
    drift = F.abs(F.col("n_rows") - F.col("expected"))
    return counts.withColumn("within", drift <= F.col("expected") * F.lit(tolerance))


def landed_totals(pages: DataFrame) -> DataFrame:
    """Per layer: features landed against the total its pages announce.

    ``pages`` has ``layer, n_features, announced``; the largest announcement counts.
    """
    return pages.groupBy("layer").agg(
        F.sum("n_features").alias("landed"), F.max("announced").alias("announced")
    ).withColumn("complete", F.col("landed") == F.col("announced"))


def fan_out(counts: DataFrame) -> DataFrame:
    """Intervals per logged bore and whether the mean is plausible."""
    mean = F.sum("n_intervals") / F.count(F.lit(1))
    return counts.agg(
        F.count(F.lit(1)).alias("n_bores"),
        F.sum("n_intervals").alias("n_rows"),
        mean.between(*FAN_OUT).alias("plausible"),
    )


def ring_sizes(polygons: DataFrame, shape: str = "shape") -> DataFrame:
    """Every ring, as landed with its closing vertex, has at least four vertices."""
    checks = ring_conditions(F.col(shape))
    return _report(polygons, {"rings_have_area": checks["rings_have_area"]})


def vertices_in_australia(polygons: DataFrame, shape: str = "shape") -> DataFrame:
    """Every vertex lies in plausible bounds."""
    checks = ring_conditions(F.col(shape))
    return _report(polygons, {"vertices_in_australia": checks["vertices_in_australia"]})


def state_conditions(raw: DataFrame, layer: str) -> Checks:
    """The checks of a state layer over its raw columns, as its mapping reads them."""
    key = text_of(raw, "HydroCode")
    if layer == "bores":
        return position_conditions(F.col("point_lon"), F.col("point_lat"), key)
    code = F.col("HydroCode") if "HydroCode" in raw.columns else F.lit(None)
    return depth_conditions(double_of(raw, STATE_LOG["top_depth_m"]), double_of(raw, STATE_LOG["bottom_depth_m"]), code)


def national_conditions(raw: DataFrame, layer: str) -> Checks:
    """The checks of a national layer over its raw columns, as its mapping reads them."""
    if layer == "hydrogeology":
        return ring_conditions(F.col("shape"))
    if layer == "headers":
        places = position_conditions(F.col("point_lon"), F.col("point_lat"), long_of(raw, NATIONAL_HEADER["eno"]))
        return places | pid_conditions(text_of(raw, NATIONAL_HEADER["identifier"]))
    names = (NATIONAL_LOG[c] for c in ("top_depth_m", "bottom_depth_m"))
    return depth_conditions(*(double_of(raw, c) for c in names), long_of(raw, NATIONAL_LOG["eno"]))
