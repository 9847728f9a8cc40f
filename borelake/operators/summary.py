"""Counts and other aggregates over headers and logs.

Logs are aggregated on their key *before* they meet the headers: partial sums leave one row per
key and task, so a bore that holds a third of all intervals costs no more than any other. The
aggregate is written once, because the join measures it before using it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import park
from .hot_keys import spread_join
from .joins import join_keys


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    """Number of rows; only the columns of upstream filters are read."""
    return df.agg(F.count(F.lit(1)).alias(name))


def rows_per_layer(layers: dict[str, DataFrame]) -> DataFrame:
    """``layer, n_rows`` of each layer table, an empty one included."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("layer"), "n_rows")
        for name, df in layers.items()
    ]
    first, *rest = counted
    for other in rest:
        first = first.unionByName(other)
    return first


def intervals_per_key(headers: DataFrame, logs: DataFrame) -> DataFrame:
    """Intervals per join key, from the logs alone."""
    keys = join_keys(headers, logs)
    present = logs.where(F.col("bore_key").isNotNull())
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_intervals"))


def code_summary(logs: DataFrame) -> DataFrame:
    """What is asked of logs most, per source and raw key: ``n_intervals, deepest_m`` and rows by validity.

    It is kept beside stored logs, so that counts and depths of their bores open no log. Summaries of
    parts of a table merge by ``merged_summaries``.
    """
    keys = [c for c in ("source", "bore_key") if c in logs.columns]
    reason = F.col("invalid_reason")
    return logs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_intervals"), F.max("bottom_depth_m").alias("deepest_m"),
        F.count_if("valid").alias("n_valid"), F.count_if(reason == "missing depth").alias("n_missing"),
        F.count_if(reason.startswith("inverted")).alias("n_inverted"), F.count_if(reason == "unknown formation").alias("n_unknown"),
    )


def merged_summaries(parts: DataFrame) -> DataFrame:
    """One row per key of several ``code_summary`` tables in one."""
    keys = [c for c in ("source", "bore_key") if c in parts.columns]
    sums = [F.sum(c).alias(c) for c in ("n_intervals", "n_valid", "n_missing", "n_inverted", "n_unknown")]
    merged = parts.groupBy(*keys).agg(F.max("deepest_m").alias("deepest_m"), *sums)
    return merged.select(*parts.columns)


def interval_counts(
    headers: DataFrame, logs: DataFrame, keep_empty: bool = False, kept: DataFrame | None = None
) -> DataFrame:
    """Each header with its number of intervals; headers without any only on request.

    ``kept``: the logs' ``code_summary``, which is read in their stead.
    """
    if kept is None:
        counts = park(intervals_per_key(headers, logs), "interval-counts")
    else:
        counts = kept.where(F.col("bore_key").isNotNull()).select(*join_keys(headers, kept), "n_intervals")
    keys = [c for c in counts.columns if c != "n_intervals"]
    joined = spread_join(headers, counts, keys, "left" if keep_empty else "inner")
    return joined.withColumn("n_intervals", F.coalesce("n_intervals", F.lit(0).cast("bigint")))


def interval_percentile(counts: DataFrame, fraction: float = 0.98) -> DataFrame:
    """Interpolated percentile of ``n_intervals`` over bores.

    The counts are turned into a histogram first. N intervals give at most about sqrt(2 N)
    different counts, so the last step stays small whatever the number of bores.
    """
    histogram = counts.groupBy("n_intervals").agg(F.count(F.lit(1)).alias("_bores"))
    return histogram.agg(
        F.expr(f"percentile(n_intervals, {float(fraction)!r}D, _bores)").alias("p")
    )


def by_interval_count(counts: DataFrame) -> DataFrame:
    """Bores sorted by number of intervals, the fewest first.

    Equal counts are common, so a second key lets the sort split them between tasks.
    """
    return counts.orderBy("n_intervals", F.xxhash64(*counts.columns))


def total_intervals(counts: DataFrame) -> DataFrame:
    """Intervals over all bores."""
    return counts.agg(F.coalesce(F.sum("n_intervals"), F.lit(0).cast("bigint")).alias("n_intervals"))


def deepest_interval(headers: DataFrame, logs: DataFrame) -> DataFrame:
    """Deepest recorded bottom per join key, flagged intervals included."""
    keys = join_keys(headers, logs)
    present = logs.where(F.col("bore_key").isNotNull())
    return present.groupBy(*keys).agg(F.max("bottom_depth_m").alias("deepest_m"))


def with_total_depth(headers: DataFrame, logs: DataFrame, kept: DataFrame | None = None) -> DataFrame:
    """Adds ``total_depth_m``: bore depth, else drilled depth, else the deepest interval.

    ``kept``: the logs' ``code_summary``, which is read in their stead.
    """
    if kept is None:
        deepest = park(deepest_interval(headers, logs), "deepest")
    else:
        deepest = kept.where(F.col("bore_key").isNotNull()).select(*join_keys(headers, kept), "deepest_m")
    keys = [c for c in deepest.columns if c != "deepest_m"]
    depth = F.coalesce("bore_depth_m", "drilled_depth_m", "deepest_m")
    joined = spread_join(headers, deepest, keys, "left")
    return joined.withColumn("total_depth_m", depth).drop("deepest_m")


def distinct_keys(df: DataFrame, key: str = "eno") -> DataFrame:
    """The set of keys, sorted."""
    return df.where(F.col(key).isNotNull()).select(key).distinct().orderBy(key)


def rows_per_source(df: DataFrame) -> DataFrame:
    """Rows of each source."""
    return df.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def validity_summary(logs: DataFrame, *by: str) -> DataFrame:
    """Rows per reason an interval was flagged, the valid ones under a null reason."""
    return logs.groupBy(*by, "valid", "invalid_reason").agg(F.count(F.lit(1)).alias("n"))
