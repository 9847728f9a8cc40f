"""Borehole-shaped views derived from the driver tables, one text for both engines.

The texts follow FIXTURES.md; names in braces are tables or earlier views. Every view covers its
whole input, so its size grows with the scale factor.
"""

from __future__ import annotations

import os
import re
from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession

from borelake.config import tuned

TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")

LOG_ROW_NO = """(((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey) * 100
         + CAST(l_quantity AS bigint)"""

# A number of these parts, or smaller ones, is a bigint; from order keys of about nine million on it may pass one.
SMALL_PARTS = {
    "l_orderkey": 9 * 10**6, "l_linenumber": 10**6, "l_partkey": 5 * 10**10, "l_suppkey": 5 * 10**14, "l_quantity": 10**16,
}
# The same number of up to 38 digits.
LONG_ROW_NO = LOG_ROW_NO.replace("l_orderkey", "CAST(l_orderkey AS decimal(38, 0))")

# Codes of no bore, so that their logs are orphans and their customers' bores have no logs.
LOG_CODE = """concat(CASE WHEN o_custkey % 17 = 0 THEN 'GX' ELSE 'GW' END, CAST(o_custkey AS varchar(20)))"""

VIEWS = {
    "fx_ngis_bore": """
SELECT c_custkey * 10 + pipe AS row_no,
       CASE WHEN c_custkey % 29 = 0 THEN NULL
            ELSE concat('GW', CAST(c_custkey AS varchar(20))) END AS "HydroCode",
       CASE WHEN c_custkey % 31 = 0 THEN NULL
            ELSE 140e0 + CAST((c_custkey * 7919) % 1500 AS double) / 100e0
                 + CAST(pipe - 1 AS double) / 1000e0 END AS "Longitude",
       -39e0 + CAST((c_custkey * 104729) % 1100 AS double) / 100e0 AS "Latitude",
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS "RefElev",
       'natural surface' AS "RefElevDesc",
       c_mktsegment AS "Status",
       'Water Bore' AS "FType",
       c_name AS "StateBoreID",
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey % 400 AS double) END AS "BoreDepth",
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey % 390 AS double) END AS "DrilledDepth",
       '1998-04-01' AS "DrilledDate",
       c_nationkey AS "StateTerritory",
       CASE c_nationkey % 3 WHEN 0 THEN 'NSW' WHEN 1 THEN 'VIC' ELSE 'QLD' END AS state_core
FROM (SELECT *, EACH(CASE WHEN c_custkey % 23 = 0 THEN LIST(1, 2) ELSE LIST(1) END) AS pipe FROM {customer}) bores
""",
    "fx_ngis_boreholelog": f"""
SELECT {LOG_ROW_NO} AS row_no,
       CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE {LOG_CODE} END AS "HydroCode",
       CASE WHEN l_linestatus = 'F' AND l_quantity > 45 THEN ' Unknown '
            WHEN l_quantity < 3 THEN NULL
            ELSE concat(l_returnflag, ' Formation') END AS "Description",
       CAST(l_linenumber * 10 AS double) AS "FromDepth",
       CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN NULL
            ELSE CAST(l_linenumber * 10 AS double) + l_quantity - 5e0 END AS "ToDepth",
       CASE WHEN l_orderkey % 2 = 0 THEN 100e0 - CAST(l_linenumber * 10 AS double) END AS "TopElev",
       CAST(NULL AS double) AS "BottomElev",
       CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE 100e0 END AS "RefElev",
       l_linestatus AS "Comment"
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
""",
    "fx_ngis_lithologylog": f"""
SELECT {LOG_ROW_NO} AS row_no,
       {LOG_CODE} AS "HydroCode",
       l_returnflag AS "MajorLithCode", l_linestatus AS "MinorLithCode",
       concat(l_returnflag, l_linestatus) AS "Description",
       CAST(l_linenumber AS double) AS "FromDepth",
       CAST(l_linenumber AS double) + l_discount * 10e0 AS "ToDepth",
       100e0 AS "RefElev"
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
""",
    "fx_ngis_constructionlog": f"""
SELECT o_orderkey AS row_no,
       {LOG_CODE} AS "HydroCode",
       CASE o_orderstatus WHEN 'F' THEN 'Screen' ELSE 'Casing' END AS "ConstructionType",
       'PVC' AS "Material", 100e0 AS "InnerDiameter", 110e0 AS "OuterDiameter",
       'Slotted' AS "Property", 0.5e0 AS "PropertySize", o_orderpriority AS "DrillMethod",
       CAST(o_orderkey % 50 AS double) AS "FromDepth",
       CAST(o_orderkey % 60 AS double) AS "ToDepth", 100e0 AS "RefElev"
FROM {{orders}}
""",
    "fx_ga_header": """
SELECT s_suppkey AS eno, s_name AS name,
       concat('http://pid.example/samplingFeature/au/BH', CAST(s_suppkey AS varchar(20))) AS identifier,
       CASE WHEN s_suppkey % 4 = 0 THEN NULL
            ELSE 140e0 + CAST((s_suppkey * 7919) % 1500 AS double) / 100e0 END AS geom_lon,
       CASE WHEN s_suppkey % 4 = 0 THEN NULL
            ELSE -39e0 + CAST((s_suppkey * 104729) % 1100 AS double) / 100e0 END AS geom_lat,
       140e0 + CAST((s_suppkey * 7919) % 1500 AS double) / 100e0 AS "GDA94_dlong",
       -39e0 + CAST((s_suppkey * 104729) % 1100 AS double) / 100e0 AS "GDA94_dlat",
       CASE s_suppkey % 6 WHEN 0 THEN ' None ' WHEN 1 THEN 'deep' WHEN 2 THEN ''
            WHEN 3 THEN '12d' ELSE concat(' ', CAST(s_suppkey AS varchar(20)), '.5') END AS elevation_m,
       CASE s_suppkey % 3 WHEN 0 THEN 'Diamond' ELSE 'Rotary' END AS "drillingMethod"
FROM {supplier}
""",
    "fx_ga_strat": f"""
SELECT {LOG_ROW_NO} AS row_no,
       CASE WHEN l_orderkey % 89 = 0 THEN 'null' ELSE CAST(l_suppkey AS varchar(20)) END AS "ENO",
       concat('BH', CAST(l_suppkey AS varchar(20))) AS "BOREHOLE_NAME",
       CAST(l_linenumber * 10 AS varchar(20)) AS "INTERVAL_BEGIN_M",
       CASE WHEN l_quantity > 48 THEN 'deep'
            ELSE CAST(CAST(l_linenumber * 10 + l_quantity - 5 AS int) AS varchar(20)) END AS "INTERVAL_END_M",
       CASE WHEN l_returnflag = 'N' THEN 'unknown' ELSE l_returnflag END AS "STRAT_UNIT_NAME",
       CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE '100' END AS "DEPTH_REF_POINT_ELEV_M_AHD"
FROM {{lineitem}}
""",
    "fx_ga_earth": f"""
SELECT {LOG_ROW_NO} AS row_no,
       CAST(l_suppkey AS varchar(20)) AS "ENO",
       CASE WHEN l_linenumber % 3 = 0 THEN ' NaN ' ELSE concat('BH', CAST(l_suppkey AS varchar(20))) END AS "BOREHOLE_NAME",
       CAST(l_linenumber AS double) AS "INTERVAL_BEGIN_M",
       CAST(l_linenumber AS double) + l_discount * 10e0 - 0.5e0 AS "INTERVAL_END_M",
       l_returnflag AS "LITHOLOGY", l_linestatus AS "LITHOLOGY_GROUP",
       CASE WHEN l_quantity > 25 THEN 'None' ELSE 'fine' END AS "LITHOLOGY_QUALIFIER",
       concat(l_returnflag, l_linestatus) AS "EARTH_MATERIAL_DESC",
       l_orderkey AS "EARTH_MATERIAL_ID"
FROM {{lineitem}}
""",
    "fx_hydro": """
SELECT n_nationkey AS ufi, n_name AS feature,
       CASE n_nationkey % 2 WHEN 0 THEN 'high' ELSE 'low' END AS prodty,
       140e0 + CAST(n_nationkey % 5 AS double) * 3e0 AS min_lon,
       -39e0 + CAST((n_nationkey - n_nationkey % 5) / 5 AS double) * 2.2e0 AS min_lat,
       143e0 + CAST(n_nationkey % 5 AS double) * 3e0 AS max_lon,
       -36.8e0 + CAST((n_nationkey - n_nationkey % 5) / 5 AS double) * 2.2e0 AS max_lat
FROM {nation}
""",
    "fx_region": """
SELECT r_regionkey AS region_id, r_name,
       141e0 + CAST(r_regionkey AS double) * 2e0 AS min_lon, -37e0 AS min_lat,
       144e0 + CAST(r_regionkey AS double) * 2e0 AS max_lon, -33e0 AS max_lat
FROM {region}
""",
    # a small box around each customer's bore; some reversed, some without width or height
    "fx_box": """
SELECT c_custkey AS box_id, lon - half AS min_lon, lat - half AS min_lat,
       CASE WHEN c_custkey % 41 = 0 THEN lon - 2e0 * half WHEN c_custkey % 5 = 0 THEN lon - half ELSE lon + half END AS max_lon,
       CASE WHEN c_custkey % 4 = 0 THEN lat - half ELSE lat + half END AS max_lat
FROM (SELECT c_custkey, CAST(1 + c_custkey % 3 AS double) / 64e0 AS half,
             140e0 + CAST((c_custkey * 7919) % 1500 AS double) / 100e0 AS lon,
             -39e0 + CAST((c_custkey * 104729) % 1100 AS double) / 100e0 AS lat FROM {customer}) boxes
""",
    # a region of several rings around each customer's bore; which holes and parts is told by its number
    "fx_parted": """
SELECT c_custkey AS region_id, c_custkey % 6 AS hole, c_custkey % 5 AS other, 1e0 / 64e0 AS u,
       140e0 + CAST((c_custkey * 7919) % 1500 AS double) / 100e0 - 3e0 / 64e0 AS x,
       -39e0 + CAST((c_custkey * 104729) % 1100 AS double) / 100e0 - 3e0 / 64e0 AS y
FROM {customer}
""",
    # one state per customer, and a manifest with repeats, gaps and stale stamps
    "fx_states": """
SELECT concat('S', CAST(c_custkey AS varchar(20))) AS state, md5(c_name) AS zip_md5 FROM {customer}
""",
    "fx_entries": """
SELECT concat('ngis-s', CAST(o_custkey AS varchar(20)), '-',
              CASE o_orderkey % 4 WHEN 0 THEN 'bores' WHEN 1 THEN 'stratigraphy'
                   WHEN 2 THEN 'earth_material' ELSE 'construction' END,
              CASE WHEN o_orderkey % 13 = 0 THEN '-opt0' ELSE '-opt1' END) AS "key",
       CAST(o_orderkey AS varchar(20)) AS entry,
       CASE WHEN o_orderkey % 11 = 0 THEN 'stale'
            ELSE concat('S', CAST(o_custkey AS varchar(20)), '|', md5(c_name), '|opt1') END AS server_fingerprint,
       CASE WHEN o_orderkey % 3 = 0 THEN concat('e', CAST(o_orderkey AS varchar(20))) END AS etag,
       1700000000e0 + CAST((o_orderkey * 7919) % 5000000 AS double) AS fetched_at,
       o_orderkey % 1000 AS feature_count,
       o_orderkey % 100000 AS size_bytes
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
""",
    "fx_asked": """
SELECT concat('ngis-s', CAST(c_custkey AS varchar(20)), '-bores-opt1') AS "key",
       c_custkey % 6 = 0 AS offline, c_custkey % 7 = 0 AS force,
       CASE c_custkey % 3 WHEN 0 THEN 'count' WHEN 1 THEN 'etag' ELSE 'none' END AS validator,
       CASE WHEN c_custkey % 4 = 0 THEN 'stale'
            ELSE concat('S', CAST(c_custkey AS varchar(20)), '|', md5(c_name), '|opt1') END AS current_fingerprint,
       CASE WHEN c_custkey % 5 = 0 THEN 'e1' END AS current_etag,
       c_custkey % 8 = 0 AS not_modified
FROM {customer}
""",
    "fx_provenance": """
SELECT o_custkey AS query, CAST(o_orderkey % 7 AS int) AS source_ord,
       CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('Source ', o_orderstatus, '.') END AS citation,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL
            ELSE 1600000000e0 + CAST(o_orderkey % 4 AS double) * 86400e0 + 0.5e0 END AS fetched_at,
       CASE WHEN o_orderkey % 2 = 0 THEN 'CC BY 4.0' END AS license,
       CASE WHEN o_orderkey % 3 = 0 THEN 'https://example.org/data' END AS source_url
FROM {orders}
""",
}


def _names(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", text)))


def duckdb_with() -> str:
    """All views as the WITH clause the oracle texts start with."""
    parts = [
        f"{name} AS ({text.format(**{n: n for n in _names(text)})})".replace("EACH(", "unnest(").replace("LIST(", "list_value(")
        for name, text in VIEWS.items()
    ]
    return "WITH " + ",\n".join(parts)


class Fixtures:
    """The views as DataFrames over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = tuned(spark), sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))

    @cached_property
    def long_numbers(self) -> bool:
        """Whether a log's number passes a bigint; where no part is so large, Parquet's footers tell it."""
        large = " OR ".join(f"{part} NOT BETWEEN -{most} AND {most}" for part, most in SMALL_PARTS.items())
        passes = f"{LONG_ROW_NO} NOT BETWEEN {-2**63} AND {2**63 - 1}"
        return self.table("lineitem").where(large).where(passes).limit(1).count() > 0

    def __getattr__(self, name: str) -> DataFrame:
        """A view; the numbers of its logs are exact beyond a bigint as well, where the text alone would fail."""
        if name not in VIEWS:
            raise AttributeError(name)
        text = VIEWS[name]
        if LOG_ROW_NO in text and self.long_numbers:
            text = text.replace(LOG_ROW_NO, LONG_ROW_NO)
        text = text.replace('"', "`").replace("EACH(", "explode(").replace("LIST(", "array(")
        used = {n: self.table(n) for n in _names(text)}
        return self.spark.sql(text, **used)


@cache
def oracle(text: str) -> str:
    """An oracle query: the views, then the query's own text."""
    body = text.strip()
    if body.upper().startswith("WITH "):
        return f"{duckdb_with()},\n{body[5:]}"
    return f"{duckdb_with()}\n{body}"
