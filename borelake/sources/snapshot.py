"""Snapshot tables, their manifest, and the decisions made from it.

A snapshot is a new directory; its manifest row is written only after the data is complete, so a
reader never sees half a snapshot and writers need no lock.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import park, tuned
from ..functions.keys import snapshot_key, snapshot_stamp
from ..operators.contracts import check_counts
from ..operators.hot_keys import spread_join
from ..schema import LOG_KINDS
from .registry import BUILD_VERSION, STATE_SOURCES

# Format of the manifest, and the age after which a snapshot is fetched again.
FORMAT_VERSION = 1
MAX_AGE_SECONDS = 30 * 24 * 3600
STATE_LAYERS = ("bores", *LOG_KINDS)

MANIFEST = """
    key string, entry string, path string, content_hash string, feature_count bigint,
    etag string, last_modified string, server_fingerprint string, fetched_at double,
    citation string, license string, source_url string, service_version string,
    query string, format_version int
"""
_PROVENANCE = (
    "etag", "last_modified", "server_fingerprint", "citation", "license", "source_url",
    "service_version", "query",
)


def content_sum(*columns: str) -> Column:
    """Order-insensitive content sum: row hashes added as decimals, merged like any other sum."""
    return F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))


class SnapshotStore:
    """Versioned Parquet tables below one root, found through a manifest table."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = tuned(spark), root.rstrip("/")

    def entries(self) -> DataFrame:
        """Every manifest row ever written."""
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/*")
        except AnalysisException as error:
            if not (error.getCondition() or "").startswith("PATH_NOT_FOUND"):
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def manifest(self) -> DataFrame:
        """The newest row of each key."""
        return newest_entries(self.entries())

    def put(
        self, key: str, df: DataFrame, provenance: dict | None = None, now: float | None = None,
        summarise: Callable[[DataFrame], DataFrame] | None = None, checks: dict | None = None,
    ) -> str:
        """Write a snapshot and then its manifest row; returns the data path.

        Row count and content hash are observed by the write itself, in its last stage. ``summarise``
        makes a small table of the written one, which is kept beside it. ``checks`` (see
        ``operators.contracts``) are counted by the same write and kept, too.
        """
        entry = uuid.uuid4().hex
        path = f"{self.root}/data/{key}/{entry}"
        seen = Observation(entry)
        df.observe(
            seen, F.count(F.lit(1)).alias("n"), content_sum(*df.columns).alias("content"), *check_counts(checks or {})
        ).write.parquet(path)
        if checks:
            counted = [(c, int(seen.get[f"{c}.n_checked"]), int(seen.get[f"{c}.n_failed"])) for c in checks]
            table = self.spark.createDataFrame(counted, "check string, n_checked bigint, n_failed bigint")
            table.coalesce(1).write.parquet(f"{self.root}/checks/{key}/{entry}")
        if summarise is not None:
            summarise(self.spark.read.parquet(path)).write.parquet(f"{self.root}/summaries/{key}/{entry}")
        known = provenance or {}
        row = {
            "key": key, "entry": entry, "path": path,
            "content_hash": str(seen.get["content"] or 0), "feature_count": seen.get["n"],
            "fetched_at": time.time() if now is None else float(now),
            "format_version": FORMAT_VERSION,
            **{name: known.get(name) for name in _PROVENANCE},
        }
        self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.parquet(
            f"{self.root}/manifest/{entry}"
        )
        return path

    def newest(self, keys: Iterable[str]) -> dict[str, dict]:
        """The newest manifest row of each of the named keys that has a snapshot."""
        rows = self.manifest().where(F.col("key").isin(*keys)).collect()
        return {row["key"]: row.asDict() for row in rows}

    def entry(self, key: str) -> dict | None:
        """The newest manifest row of a key."""
        row = self.manifest().where(F.col("key") == key).first()
        return row.asDict() if row else None

    def get(self, key: str) -> DataFrame | None:
        """The newest snapshot of a key, or None."""
        entry = self.entry(key)
        return self.spark.read.parquet(entry["path"]) if entry else None

    def kept_summary(self, key: str, entry: dict | None = None) -> DataFrame | None:
        """The summary kept beside the newest snapshot of a key, or None where there is none."""
        return self._beside("summaries", key, entry)

    def checks(self, key: str) -> DataFrame | None:
        """``check, n_checked, n_failed`` of the newest snapshot, as its write counted them; None without any."""
        return self._beside("checks", key)

    def _beside(self, kind: str, key: str, entry: dict | None = None) -> DataFrame | None:
        entry = entry or self.entry(key)
        if entry is None:
            return None
        try:
            return self.spark.read.parquet(f"{self.root}/{kind}/{key}/{entry['entry']}")
        except AnalysisException as error:
            if not (error.getCondition() or "").startswith("PATH_NOT_FOUND"):
                raise
            return None

    def provenance(self, key: str) -> dict:
        """What is known of a key's origin; empty when it has no snapshot."""
        return self.entry(key) or {}

    def get_or_build(
        self, key: str, build, *, fingerprint: str | None = None, etag: str | None = None,
        not_modified: bool = False, provenance: dict | None = None, force: bool = False,
        offline: bool = False, max_age: float = MAX_AGE_SECONDS, now: float | None = None,
        checks: Callable[[DataFrame], dict] | None = None,
    ) -> DataFrame:
        """Serve a key's snapshot while it is fresh, else build it; offline never builds."""
        now = time.time() if now is None else now
        validator = "count" if fingerprint is not None else "etag" if etag is not None else "none"
        asked = self.spark.range(1).select(
            F.lit(key).alias("key"), F.lit(offline).alias("offline"), F.lit(force).alias("force"),
            F.lit(validator).alias("validator"),
            F.lit(fingerprint).cast("string").alias("current_fingerprint"),
            F.lit(etag).cast("string").alias("current_etag"),
            F.lit(not_modified).alias("not_modified"),
        )
        row = freshness_action(asked, self.manifest(), now, max_age).first()
        if row["action"] == "error":
            raise RuntimeError(f"No snapshot of {key!r} is stored, and offline none can be built.")
        if row["action"] == "refetch":
            known = {"server_fingerprint": fingerprint, "etag": etag, **(provenance or {})}
            built = build()
            self.put(key, built, known, now, checks=checks(built) if checks else None)
        return self.get(key)

    def summary(self) -> DataFrame:
        """Number of snapshots, their rows and their bytes on disk."""
        return manifest_summary(self.details())

    def details(self, now: float | None = None) -> DataFrame:
        """Per key its rows, bytes on disk, age in seconds, query and origin."""
        now = time.time() if now is None else float(now)
        return self._sized().select(
            "key", "feature_count", "size_bytes", (F.lit(now) - F.col("fetched_at")).alias("age_seconds"),
            "query", "service_version", "source_url", "path",
        )

    def _sized(self) -> DataFrame:
        """The manifest with ``size_bytes`` of each snapshot's files."""
        manifest = self.manifest()
        if manifest.isEmpty():
            return manifest.withColumn("size_bytes", F.lit(0).cast("bigint"))
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True)
        sizes = files.load(f"{self.root}/data").select("path", F.col("length").alias("size_bytes"))
        entry = F.element_at(F.split("path", "/"), -2)
        per_entry = sizes.groupBy(entry.alias("entry")).agg(F.sum("size_bytes").alias("size_bytes"))
        return manifest.join(per_entry, "entry", "left")


def newest_entries(entries: DataFrame) -> DataFrame:
    """The newest manifest row per key."""
    names = [c for c in entries.columns if c != "key"]
    newest = F.max_by(F.struct(*names), F.struct("fetched_at", "entry"))
    return entries.groupBy("key").agg(newest.alias("_e")).select("key", "_e.*")


def is_unchanged(
    validator: Column, fingerprint: Column, current_fingerprint: Column, etag: Column,
    current_etag: Column, not_modified: Column,
) -> Column:
    """A not-modified answer, an equal ``count`` fingerprint, or an equal known ``etag``.

    With validator ``none`` there is nothing to compare and age alone decides.
    """
    return (
        F.when(not_modified, True)
        .when(validator == "count", fingerprint.eqNullSafe(current_fingerprint))
        .when(validator == "etag", F.coalesce(etag == current_etag, F.lit(False)))
        .otherwise(True)
    )


def freshness_action(
    asked: DataFrame, manifest: DataFrame, now: float, max_age: float = MAX_AGE_SECONDS
) -> DataFrame:
    """Adds ``action``: ``serve``, ``refetch`` or ``error`` to each asked key.

    ``asked`` has ``key, offline, force, validator, current_fingerprint, current_etag,
    not_modified``. The order of the rules is: offline, forced, missing, too old, changed.
    """
    stored = manifest.select("key", "fetched_at", "server_fingerprint", "etag", F.lit(True).alias("_has"))
    joined = spread_join(asked, park(stored, "stored"), ["key"], "left")
    has = F.col("_has").isNotNull()
    expired = F.col("fetched_at").isNull() | (F.lit(float(now)) - F.col("fetched_at") > max_age)
    same = is_unchanged(
        F.col("validator"), F.col("server_fingerprint"), F.col("current_fingerprint"),
        F.col("etag"), F.col("current_etag"), F.col("not_modified"),
    )
    action = (
        F.when(F.col("offline") & has, "serve")
        .when(F.col("offline"), "error")
        .when(F.col("force") | ~has | expired, "refetch")
        .when(same, "serve")
        .otherwise("refetch")
    )
    return joined.select(*asked.columns, action.alias("action"))


def expected_layers(states: DataFrame, version: int = BUILD_VERSION) -> DataFrame:
    """``state, layer, key, stamp`` each state must have; ``states`` has ``state, zip_md5``."""
    layers = F.explode(F.array(*(F.lit(layer) for layer in STATE_LAYERS)))
    each = states.select("state", "zip_md5", layers.alias("layer"))
    number = F.lit(version)
    return each.select(
        "state", "layer",
        snapshot_key(F.col("state"), F.col("layer"), number).alias("key"),
        snapshot_stamp(F.col("state"), F.col("zip_md5"), number).alias("stamp"),
    )


def snapshot_gate(expected: DataFrame, manifest: DataFrame) -> DataFrame:
    """Per state: are all layers present, and do all carry the expected stamp?"""
    stored = manifest.select("key", "server_fingerprint", F.lit(True).alias("_has"))
    present = F.col("_has").isNotNull()
    current = present & F.col("server_fingerprint").eqNullSafe(F.col("stamp"))
    return expected.join(stored, "key", "left").groupBy("state").agg(
        F.bool_and(present).alias("present"), F.bool_and(current).alias("fresh")
    )


def gate_action(gate: DataFrame, offline: bool = False, force: bool = False) -> DataFrame:
    """Adds ``action``: serve a fresh set; offline serve a whole but stale one; else rebuild."""
    return gate.withColumn(
        "action",
        F.when(F.col("fresh") & ~F.lit(force), "serve")
        .when(F.lit(offline) & F.col("present"), "serve")
        .when(F.lit(offline), "error")
        .otherwise("rebuild"),
    )


def superseded(manifest: DataFrame, keep: DataFrame, state: Column | None = None) -> DataFrame:
    """State snapshots no longer asked for: keys of the state that are not in ``keep``.

    Without ``state`` every state key counts. Both sides hold one row per snapshot key.
    """
    prefix = F.lit("ngis-") if state is None else F.concat(F.lit("ngis-"), F.lower(F.trim(state)), F.lit("-"))
    return manifest.where(F.col("key").startswith(prefix)).join(
        keep.select("key").distinct(), "key", "left_anti"
    )


def manifest_summary(entries: DataFrame) -> DataFrame:
    """Number of entries, rows and bytes; ``entries`` has ``key, feature_count, size_bytes``."""
    zero = F.lit(0).cast("bigint")
    return entries.agg(
        F.count(F.lit(1)).alias("entry_count"),
        F.coalesce(F.sum("feature_count"), zero).alias("feature_count"),
        F.coalesce(F.sum("size_bytes"), zero).alias("total_bytes"),
    )


def state_provenance(state: str, layer: str, version: int = BUILD_VERSION, sources=STATE_SOURCES) -> dict:
    """Manifest fields of one state layer; licence and page stay in their own fields."""
    from .registry import LICENSE, get_source

    source = get_source(state, sources)
    return {
        "server_fingerprint": f"{source.state}|{source.zip_md5}|opt{version}",
        "citation": f"{source.description}.",
        "license": LICENSE,
        "source_url": source.dataset_url,
        "service_version": f"NGIS {source.vintage} (opt{version})",
        "query": f'{{"service":"ngis","state":"{source.state}","layer":"{layer}"}}',
    }
