"""Build the snapshot tables of each source family from landed files."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import park
from ..functions.keys import snapshot_key
from ..operators.contracts import national_conditions, state_conditions
from ..operators.joins import bore_lookup, with_bore_place, with_number_bounds, with_point
from ..operators.mapping import state_logs, with_national_point
from ..operators.summary import code_summary
from ..schema import LOG_KINDS
from ..sources import landed
from ..sources.kept_pages import KeptPages
from ..sources.registry import (
    BUILD_VERSION, NATIONAL_PROVENANCE, STATE_SOURCES, get_source, registry_table,
)
from ..sources.sinks import laid_out
from ..sources.snapshot import (
    SnapshotStore, expected_layers, gate_action, snapshot_gate, state_provenance,
)

NATIONAL_KEYS = {
    "headers": "ga-headers",
    "stratigraphy": "ga-stratigraphy",
    "earth_material": "ga-earth_material",
    "hydrogeology": "ga-hydrogeology",
}


def state_keys(spark: SparkSession, state: str, version: int = BUILD_VERSION) -> dict[str, str]:
    """Layer to snapshot key of one state."""
    layers = ("bores", *LOG_KINDS)
    row = spark.range(1).select(
        *(snapshot_key(F.lit(state), F.lit(layer), F.lit(version)).alias(layer) for layer in layers)
    ).first()
    return row.asDict()


def summary_of(kind: str) -> Callable[[DataFrame], DataFrame]:
    """What is kept beside a state's stored logs of a kind."""
    return lambda stored: code_summary(state_logs(stored, kind))


def build_state(
    store: SnapshotStore, landed_root: str, state: str, *, fmt: str = "parquet",
    force: bool = False, offline: bool = False, sources=STATE_SOURCES, now: float | None = None,
) -> dict[str, DataFrame]:
    """The four tables of a state core, built once and served while their stamp is current.

    The contract checks of each layer are counted by its write (``store.checks``), and logs keep a
    summary per code (``store.kept_summary``). Logs get their bore's position and the envelope of their code's bores at build time, and every
    table is laid out by grid cell, so later box queries prune row groups of headers and logs.
    """
    spark, source = store.spark, get_source(state, sources)
    tag = f"NGIS:{source.state}"
    registry = registry_table(spark, sources).where(F.col("state") == source.state)
    gate = gate_action(snapshot_gate(expected_layers(registry), store.manifest()), offline, force)
    action = gate.first()["action"]
    if action == "error":
        raise RuntimeError(f"Offline and the {source.state} store is incomplete; build it once online.")
    keys = state_keys(spark, source.state)
    if action == "rebuild":
        layers = landed.read_state_core(spark, landed_root, source.state, fmt)
        lookup = park(bore_lookup(layers["bores"]), "bore-lookup")  # once for all log layers
        for layer, raw in layers.items():
            placed = raw if layer == "bores" else with_bore_place(raw, lookup)
            # One source, so its tag has no part in the layout.
            tagged = laid_out(with_point(placed.drop("source")), "point_lon", "point_lat").withColumn("source", F.lit(tag))
            store.put(
                keys[layer], tagged,
                state_provenance(source.state, layer, sources=sources), now,
                None if layer == "bores" else summary_of(layer), state_conditions(tagged, layer),
            )
    return {layer: store.get(key) for layer, key in keys.items()}


def build_national(
    store: SnapshotStore, landed_root: str, *, force: bool = False, offline: bool = False,
    max_age: float | None = None, now: float | None = None, multi_line: bool = True, split: bool = False,
) -> dict[str, DataFrame]:
    """National headers, logs and hydrogeology from ``<root>/<layer>/*.json`` pages.

    Headers are judged by the number of landed features and polygons by their pages. Pages are told by
    name, size and time from the file listing, so where they are as before none is opened, and where some
    are new or changed only those are parsed (``KeptPages``). Logs carry the envelope of their number's
    bores and lie by it, so they are judged by their pages and the headers they were placed with: new
    headers have them placed again, from what was parsed before. ``force`` parses all pages anew. With ``split`` large pages are read by
    several tasks.
    """
    spark, root = store.spark, landed_root.rstrip("/")
    age = {} if max_age is None else {"max_age": max_age}

    @cache
    def features(layer: str) -> DataFrame:
        pages = KeptPages(spark, f"{store.root}/pages/v{BUILD_VERSION}/{NATIONAL_KEYS[layer]}")
        return pages.features(f"{root}/{layer}", partial(parse, layer), anew=force)

    def parse(layer: str, paths: list[str]) -> DataFrame:
        if layer in LOG_KINDS:
            return landed.read_log_features(spark, paths, layer, multi_line, split)
        read = landed.read_header_features if layer == "headers" else landed.read_hydro_features
        return read(spark, paths, multi_line, split)

    def placed_logs(kind: str) -> DataFrame:
        logs = landed.with_landing_order(features(kind))
        return laid_out(with_number_bounds(logs, tables["headers"]), "code_min_lon", "code_min_lat")

    readers = {
        "headers": lambda: laid_out(
            with_national_point(landed.with_landing_order(features("headers"))),
            "point_lon", "point_lat",
        ),
        "stratigraphy": lambda: placed_logs("stratigraphy"),
        "earth_material": lambda: placed_logs("earth_material"),
        "hydrogeology": lambda: landed.with_landing_order(features("hydrogeology")),
    }
    tables = {}
    for layer, build in readers.items():
        fingerprint = etag = None
        if not offline:
            etag = landed.pages_stamp(spark, f"{root}/{layer}")
            if layer in LOG_KINDS:
                fingerprint = f"{store.entry(NATIONAL_KEYS['headers'])['entry']}|{etag}"
            elif layer == "headers":
                known = store.entry(NATIONAL_KEYS[layer])
                if known is not None and known["etag"] == etag:
                    fingerprint = known["server_fingerprint"]
                else:
                    fingerprint = str(features("headers").count())
        about = NATIONAL_PROVENANCE["hydrogeology" if layer == "hydrogeology" else "headers"]
        tables[layer] = store.get_or_build(
            NATIONAL_KEYS[layer], build, fingerprint=fingerprint, etag=etag, provenance=about, force=force,
            offline=offline, now=now, checks=partial(national_conditions, layer=layer), **age,
        )
    return tables
