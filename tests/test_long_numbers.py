"""Logs whose numbers pass a bigint, as those of order keys above nine million do."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.fixtures import LONG_ROW_NO, SMALL_PARTS, Fixtures

from .conftest import rows

# What a view takes from an order's key repeats after so many keys.
FAR = 97 * 89 * 600 * 10


@pytest.fixture(scope="module")
def near_and_far(spark, tmp_path_factory):
    """The same small tables with small order keys and with large ones."""
    folders = []
    for first in (0, FAR):
        folder = str(tmp_path_factory.mktemp("tables"))
        key = F.col("id") + F.lit(first).cast("bigint")
        spark.range(5).selectExpr("CAST(id AS int) AS r_regionkey", "concat('R', id) AS r_name").write.parquet(f"{folder}/region.parquet")
        spark.range(25).selectExpr("CAST(id AS int) AS n_nationkey", "concat('N', id) AS n_name").write.parquet(f"{folder}/nation.parquet")
        spark.range(90).selectExpr(
            "id AS c_custkey", "concat('C', id) AS c_name", "CAST(id % 25 AS int) AS c_nationkey", "id * 1.5e0 AS c_acctbal", "'M' AS c_mktsegment",
        ).write.parquet(f"{folder}/customer.parquet")
        spark.range(12).selectExpr("id AS s_suppkey", "concat('S', id) AS s_name").write.parquet(f"{folder}/supplier.parquet")
        spark.range(200).select(
            key.alias("o_orderkey"), (F.col("id") * 7 % 90).alias("o_custkey"), F.lit("F").alias("o_orderstatus"), F.lit("1").alias("o_orderpriority"),
        ).write.parquet(f"{folder}/orders.parquet")
        spark.range(200).select("id", F.explode(F.sequence(F.lit(1), F.col("id").cast("int") % 5 + 1)).alias("l_linenumber")).select(
            key.alias("l_orderkey"), (F.col("id") * 31 % 97).alias("l_partkey"), ((F.col("id") + F.col("l_linenumber")) % 12).alias("l_suppkey"),
            "l_linenumber", (F.col("id") % 50 + 1).cast("double").alias("l_quantity"), (F.col("l_linenumber") / 100).alias("l_discount"),
            F.substring(F.lit("ANR"), (F.col("id") % 3 + 1).cast("int"), F.lit(1)).alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
        ).write.parquet(f"{folder}/lineitem.parquet")
        folders.append(folder)
    return folders


def test_numbers_are_the_same_bigints_or_exact(spark, near_and_far):
    views = [Fixtures(spark, folder) for folder in near_and_far]
    assert [v.long_numbers for v in views] == [False, True]
    for view in ("fx_ngis_boreholelog", "fx_ngis_lithologylog", "fx_ga_strat", "fx_ga_earth"):
        near, far = (getattr(v, view).select("row_no") for v in views)
        assert [df.schema["row_no"].dataType.simpleString() for df in (near, far)] == ["bigint", "decimal(38,0)"]
        assert {int(r.row_no) + FAR * 10**12 for r in near.collect()} == {int(r.row_no) for r in far.collect()}


def test_no_number_of_small_parts_passes_a_bigint(spark):
    most = sum(n * weight for n, weight in zip(SMALL_PARTS.values(), (10**12, 10**11, 10**6, 100, 1), strict=True))
    assert most < 2**63
    parts = spark.createDataFrame([tuple(float(n) if p == "l_quantity" else n for p, n in SMALL_PARTS.items())], list(SMALL_PARTS))
    assert parts.selectExpr(f"{LONG_ROW_NO} AS n").first().n == Decimal(most)


@pytest.mark.parametrize("name", [
    "split_pages_scan", "earth_pages_scan", "units_csv", "log_pages_scan", "interval_lists", "store_interval_counts",
])
def test_query_answers_for_far_keys_as_for_near_ones(spark, near_and_far, name):
    near, far = (entry.queries()[name](spark, folder) for folder in near_and_far)
    if "earth_material_id" in near.columns:  # the order's key
        near = near.withColumn("earth_material_id", F.col("earth_material_id") + FAR)
    if name == "interval_lists":
        moved = F.transform(F.split("rows_in_order", ","), lambda n: (n.cast("decimal(38,0)") + F.lit(Decimal(FAR * 10**12))).cast("string"))
        near = near.withColumn("rows_in_order", F.array_join(moved, ","))
    found = rows(far)
    assert found and found == rows(near)
