"""Keys, stamps and identifiers of regions, queries, log pulls and snapshots."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .coerce import strip
from .geometry import canonical_shape

# Fixed value: a borehole PID ends in BH and the borehole number.
PID_TAIL = r"BH([0-9]+)$"
# Fixed value: the full form of a national borehole PID.
PID_PATTERN = r"^http://pid\.geoscience\.gov\.au/samplingFeature/au/BH\d+$"


def region_key(shape: Column) -> Column:
    """Digest of a footprint; equal footprints have equal keys however they are written."""
    return F.sha2(canonical_shape(shape), 256)


def query_key(footprint_key: Column, service: Column, layer: Column, predicate: Column) -> Column:
    """Footprint digest plus twelve digits of service, layer and attribute predicate."""
    described = F.concat_ws("|", service, layer, F.coalesce(predicate, F.lit("")))
    return F.concat_ws("-", footprint_key, F.substring(F.sha2(described, 256), 1, 12))


def key_set_digest(keys: DataFrame, key: str, by: Iterable[str] = ()) -> DataFrame:
    """A digest of the *set* of keys, per group: order and repeats do not matter.

    Each distinct key adds two 48-bit slices of its MD5, so partial sums merge like any other
    aggregate and no task ever holds the set. Columns: the group, ``n_keys``, ``key_digest``.
    """
    by = list(by)
    hashed = keys.where(F.col(key).isNotNull()).select(*by, key).distinct()
    digest = F.md5(F.col(key).cast("string").cast("binary"))

    def part(start):
        return F.sum(F.conv(F.substring(digest, start, 12), 16, 10).cast("decimal(20,0)"))

    return (
        hashed.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n_keys"), part(1).alias("_a"), part(13).alias("_b"))
        .withColumn(
            "key_digest",
            F.sha2(
                F.concat_ws(
                    "|", "n_keys",
                    *(F.coalesce(F.col(c).cast("string"), F.lit("0")) for c in ("_a", "_b")),
                ),
                256,
            ),
        )
        .drop("_a", "_b")
    )


def log_key(kind: Column, digest: Column) -> Column:
    """Key of a log pull: its kind and twelve digits of its key-set digest."""
    return F.concat_ws("-", F.lit("logs"), kind, F.substring(digest, 1, 12))


def snapshot_key(state: Column, layer: Column, version: Column) -> Column:
    """Key of one layer of one state store at one build version."""
    clean = F.lower(F.trim(state))
    return F.concat(F.lit("ngis-"), clean, F.lit("-"), layer, F.lit("-opt"), version.cast("string"))


def snapshot_stamp(state: Column, artifact_md5: Column, version: Column) -> Column:
    """What a current snapshot must carry: state, artifact checksum and build version."""
    return F.concat(
        F.upper(F.trim(state)), F.lit("|"), artifact_md5, F.lit("|opt"), version.cast("string")
    )


def eno_of_identifier(identifier: Column) -> Column:
    """Borehole number from a bare number or a PID; null when it is neither."""
    text = strip(identifier.cast("string"))
    tail = F.regexp_extract(text, PID_TAIL, 1)
    return F.coalesce(
        F.when(text.rlike("^[0-9]+$"), text), F.when(tail != "", tail)
    ).try_cast("bigint")
