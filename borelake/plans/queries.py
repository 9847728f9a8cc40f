"""Box and polygon queries over one source family or all of them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.citation import DEFAULT_HYDRO_CITATION, provenance_citation
from ..functions.geometry import bounds_of
from ..operators.federation import federated_logs, union_all
from ..operators.filters import (
    by_attribute, in_region, raw_in_region, single_header, source_tags,
)
from ..operators.joins import logs_near
from ..operators.mapping import national_headers, national_logs, state_headers, state_logs
from ..operators.spatial_join import polygons_in_region
from ..region import Region
from ..schema import LOG_KINDS, export_columns, struct_of
from ..sources.registry import STATE_SOURCES, states_meeting
from ..sources.snapshot import STATE_LAYERS, SnapshotStore
from .bores import Bores
from .stores import NATIONAL_KEYS, state_keys

_BOUNDS = ("min_lon", "min_lat", "max_lon", "max_lat")


def _headers_in(raw: DataFrame, footprint: Region, mapped, refine: str = "exact") -> DataFrame:
    """Canonical headers of a region; filtered before mapping where the raw position allows."""
    near = raw_in_region(raw, footprint, refine)
    return mapped(near) if near is not None else in_region(mapped(raw), footprint, refine=refine)


@dataclass(frozen=True)
class NationalBores:
    """Queries over the national tables: raw headers, raw logs by kind, raw polygons."""

    headers: DataFrame
    logs: dict[str, DataFrame]
    hydro: DataFrame | None = None
    provenance: dict = field(default_factory=dict)
    hydro_provenance: dict = field(default_factory=dict)

    def boreholes(
        self, region=None, *, bbox=None, where: str | None = None, count_only: bool = False,
        refine: str = "exact",
    ) -> Bores | int:
        """Bores of a region; ``where`` is SQL over raw names; a count reads positions only."""
        footprint = Region.resolve(region, bbox)
        found = _headers_in(by_attribute(self.headers, where), footprint, national_headers, refine)
        if count_only:
            return found.count()
        logs = {kind: national_logs(logs_near(raw, footprint.bounds), kind) for kind, raw in self.logs.items()}
        return Bores(found, logs, footprint, {"GA": self.provenance})

    def borehole(self, identifier) -> DataFrame:
        """A single header by number or PID; no row when unknown."""
        return single_header(national_headers(self.headers), identifier)

    def hydrogeology(
        self, region=None, *, bbox=None, where: str | None = None, count_only: bool = False
    ) -> DataFrame | int:
        """Raw polygons that meet a region, holes and multi-polygons included."""
        footprint = Region.resolve(region, bbox)
        stored = _BOUNDS if set(_BOUNDS) <= set(self.hydro.columns) else None
        found = polygons_in_region(
            by_attribute(self.hydro, where), footprint, stored_bounds=stored,
        )
        return found.count() if count_only else found

    def hydrogeology_citation(self) -> str:
        """The citation text of the polygons."""
        return provenance_citation(self.hydro.sparkSession, self.hydro_provenance, DEFAULT_HYDRO_CITATION)


@dataclass(frozen=True)
class StateBores:
    """Queries over state tables: raw layers with a ``source`` column, all states together."""

    bores: DataFrame
    logs: dict[str, DataFrame]
    provenance: dict[str, dict] = field(default_factory=dict)
    summaries: dict[str, DataFrame] = field(default_factory=dict)

    def boreholes(self, states, *, region=None, bbox=None) -> Bores:
        """Bores of one state, or several, in a region; the source filter prunes partitions."""
        footprint = Region.resolve(region, bbox)
        codes = [states] if isinstance(states, str) else list(states)
        tags = [f"NGIS:{c.strip().upper()}" for c in codes]
        asked = F.col("source").isin(*tags) if tags else F.lit(False)
        found = _headers_in(self.bores.where(asked), footprint, state_headers)
        logs = {}
        for kind, raw in self.logs.items():
            mine = raw.where(asked) if "source" in raw.columns else raw
            logs[kind] = state_logs(logs_near(mine, footprint.bounds), kind)
        kept = {kind: table.where(asked) for kind, table in self.summaries.items()}
        return Bores(found, logs, footprint, {t: self.provenance.get(t, {}) for t in tags}, kept)


@dataclass(frozen=True)
class AllBores:
    """One box, all sources: the national tables and every state whose extent meets the box."""

    national: NationalBores | None
    states: StateBores | None
    registry: tuple = STATE_SOURCES

    @classmethod
    def from_store(cls, store: SnapshotStore, registry: tuple = STATE_SOURCES) -> AllBores:
        """Whatever the store holds: the national tables and every state, each tagged with its source.

        A state counts once all its layers are stored. The manifest is read once.
        """
        keys = {source.state: state_keys(store.spark, source.state) for source in registry}
        wanted = [*NATIONAL_KEYS.values(), *(key for layers in keys.values() for key in layers.values())]
        entries = store.newest(wanted)
        tables = {key: store.spark.read.parquet(entry["path"]) for key, entry in entries.items()}
        held = {state: layers for state, layers in keys.items() if set(layers.values()) <= set(tables)}
        states = national = None
        if held:
            by_layer = {
                layer: union_all(tables[layers[layer]] for layers in held.values()) for layer in STATE_LAYERS
            }
            kept = {
                kind: [store.kept_summary(layers[kind], entries[layers[kind]]) for layers in held.values()] for kind in LOG_KINDS
            }
            states = StateBores(
                by_layer.pop("bores"), by_layer,
                {f"NGIS:{state}": entries[layers["bores"]] for state, layers in held.items()},
                {kind: union_all(parts) for kind, parts in kept.items() if None not in parts},
            )
        ga = {layer: key for layer, key in NATIONAL_KEYS.items() if key in tables}
        if "headers" in ga:
            logs = {layer: tables[key] for layer, key in ga.items() if layer in LOG_KINDS}
            hydro = tables.get(NATIONAL_KEYS["hydrogeology"])
            national = NationalBores(
                tables[ga["headers"]], logs, hydro, entries[ga["headers"]],
                entries.get(NATIONAL_KEYS["hydrogeology"], {}),
            )
        if states is None and national is None:
            raise ValueError(f"The store at {store.root} holds no bores yet; build a source first.")
        return cls(national, states, registry)

    def boreholes(self, *, region=None, bbox=None, sources=None) -> Bores:
        """Tagged bores of all wanted sources, in query order, never deduplicated.

        ``sources`` is a name or a list of names: ``GA``, ``NGIS``, ``NGIS:NSW`` or ``NSW``.
        """
        footprint = Region.resolve(region, bbox)
        tags = source_tags(sources, states_meeting(footprint.bounds, self.registry))
        parts, provenance = [], {}
        if "GA" in tags and self.national is not None:
            parts.append(self.national.boreholes(footprint))
        codes = [t.split(":")[1] for t in tags if t != "GA"]
        if codes and self.states is not None:
            parts.append(self.states.boreholes(codes, region=footprint))
        if not parts:
            return self._nothing(footprint)
        for part in parts:
            provenance.update(part.provenance)
        logs = {kind: self._logs(kind, parts) for kind in LOG_KINDS}
        order = F.array_position(F.array(*(F.lit(t) for t in tags)), F.col("source")) - 1
        headers = union_all(p.headers for p in parts).withColumn("source_ord", order.cast("int"))
        # National logs have no kept summary, so where they take part logs are counted.
        return Bores(headers, logs, footprint, provenance, {} if "GA" in provenance else parts[0].summaries)

    def log_tables_in(
        self, regions: DataFrame, region_key: str, kind: str = "stratigraphy", *, shape: str = "shape", sources=None
    ) -> DataFrame:
        """The interval table of every region of a table, all sources: ``region_key`` and the log's columns.

        Sources and scans are pruned by the envelope of all regions, which is read first.
        """
        bounds = regions.select(*(c.alias(n) for c, n in zip(bounds_of(F.col(shape)), _BOUNDS, strict=True)))
        box = bounds.agg(F.min("min_lon"), F.min("min_lat"), F.max("max_lon"), F.max("max_lat")).first()
        if None in tuple(box):
            raise ValueError("The table of regions holds no region.")
        wide = (box[0], box[1], max(box[2], box[0] + 1e-6), max(box[3], box[1] + 1e-6))
        found = self.boreholes(bbox=wide, sources=sources)
        return found.log_table_by_region(regions.select(region_key, F.col(shape).alias("shape")), region_key, kind)

    @staticmethod
    def _logs(kind: str, parts: list[Bores]) -> DataFrame:
        """Intervals of all parts; the national part has no construction records."""
        national = next((p.log_tables.get(kind) for p in parts if "GA" in p.provenance), None)
        states = next((p.log_tables.get(kind) for p in parts if "GA" not in p.provenance), None)
        if (national if kind != "construction" else None) is None and states is None:
            spark = parts[0].headers.sparkSession
            empty = spark.createDataFrame([], struct_of(export_columns(kind)))
            return empty.withColumn("bore_key", F.lit(None).cast("string"))
        return federated_logs(kind, national, states)

    def _nothing(self, footprint: Region) -> Bores:
        known = self.national or self.states
        if known is self.national:
            empty = known.boreholes(footprint)
        else:
            empty = known.boreholes([], region=footprint)
        return Bores(empty.headers.limit(0), empty.log_tables, footprint, {})


__all__ = ["AllBores", "Bores", "NationalBores", "StateBores"]
