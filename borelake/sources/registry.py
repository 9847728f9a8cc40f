"""The pinned state artifacts: what a landed core must be, and which boxes it can answer."""

from __future__ import annotations

from dataclasses import astuple, dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import boxes_overlap

LICENSE = "CC BY 4.0"
# Raised whenever the built tables change shape, which makes every older snapshot stale.
BUILD_VERSION = 1


@dataclass(frozen=True)
class StateSource:
    """One state core as published."""

    state: str
    vintage: str
    dataset_url: str
    zip_bytes: int
    zip_md5: str
    min_lon: float | None
    min_lat: float | None
    max_lon: float | None
    max_lat: float | None

    @property
    def description(self) -> str:
        return (
            "Bureau of Meteorology National Groundwater Information System (NGIS), "
            f"{self.state} core, {self.vintage} extract"
        )


_DATASETS = "https://data.gov.au/data/dataset/"

# Published size, checksum, page and extent of each state core.
STATE_SOURCES = (
    StateSource("NSW", "2014-11", _DATASETS + "b0f37930-a810-4819-8fb6-8008538fa53b",
                98390403, "8c5006f6e136eec8700464f8d1783373", 140.99, -37.70, 153.64, -28.10),
    StateSource("VIC", "2014-03", _DATASETS + "2eb2630f-313e-4542-9137-c6d7d82171b0",
                1105719595, "1138ee6a47e3c37cef174c20b9f6c76f", 140.95, -39.05, 149.90, -34.02),
    StateSource("QLD", "2014", _DATASETS + "d2c06543-7389-4ac2-86c0-74b077bcdaa5",
                48203959, "0e3b845c35c8e37a867ee5f9e7132a32", 137.90, -30.80, 153.57, -9.42),
)

# Attribution of the two national services.
NATIONAL_PROVENANCE = {
    "headers": {
        "citation": "Geoscience Australia Borehole Database, accessed via the GA Boreholes "
        "WFS (gsmlp:BoreholeView).",
        "license": LICENSE,
        "source_url": "https://services.ga.gov.au/gis/boreholes/wfs",
        "service_version": "WFS 2.0.0",
    },
    "hydrogeology": {
        "citation": "Hydrogeology of Australia, Geoscience Australia, accessed via the "
        "Hydrogeology_of_Australia ArcGIS MapServer (layer 0).",
        "license": LICENSE,
        "source_url": "https://services.ga.gov.au/gis/rest/services/"
        "Hydrogeology_of_Australia/MapServer",
        "service_version": "ArcGIS REST MapServer",
    },
}

STATE_EXTENTS = {
    s.state: (s.min_lon, s.min_lat, s.max_lon, s.max_lat) for s in STATE_SOURCES
}


def get_source(state: str, sources=STATE_SOURCES) -> StateSource:
    """The pinned source of a state, in any case, or ``ValueError``."""
    code = (state or "").strip().upper()
    for source in sources:
        if source.state == code:
            return source
    known = ", ".join(s.state for s in sources)
    raise ValueError(f"no state core for {state!r}; available: {known}")


def registry_table(spark: SparkSession, sources=STATE_SOURCES) -> DataFrame:
    """The registry as a table: one row per state, with its description and licence."""
    names = [f.name for f in fields(StateSource)]
    types = {"zip_bytes": "bigint", **dict.fromkeys(names[-4:], "double")}
    ddl = ", ".join(f"{n} {types.get(n, 'string')}" for n in names)
    rows = [(*astuple(s), s.description, LICENSE) for s in sources]
    return spark.createDataFrame(rows, ddl + ", description string, license string")


def states_meeting(bounds, sources=STATE_SOURCES) -> list[str]:
    """State codes whose extent meets a box, edges included; an unknown extent always does."""
    x0, y0, x1, y1 = bounds
    return [
        s.state
        for s in sources
        if s.min_lon is None
        or (s.min_lon <= x1 and x0 <= s.max_lon and s.min_lat <= y1 and y0 <= s.max_lat)
    ]


def route_to_states(boxes: DataFrame, bounds: tuple[str, str, str, str], sources=STATE_SOURCES) -> DataFrame:
    """One row per box and state core that can answer it.

    The registry is a fixed handful of constants, so routing is a projection and not a join.
    """
    asked = [F.col(b) for b in bounds]

    def possible(s: StateSource) -> Column:
        code = F.lit(s.state)
        if s.min_lon is None:
            return code
        extent = [F.lit(v) for v in (s.min_lon, s.min_lat, s.max_lon, s.max_lat)]
        return F.when(boxes_overlap(extent, asked), code)

    states = F.array_compact(F.array(*(possible(s) for s in sources)))
    return boxes.select("*", F.explode(states).alias("state"))
