"""Check of landed archives against the registry."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def check_artifacts(spark: SparkSession, root: str, registry: DataFrame, pattern: str = "*.zip") -> DataFrame:
    """``state, path, size_ok, md5_ok`` of each landed archive ``<root>/<state>/`` whose name fits ``pattern``.

    Sizes come from the file listing alone; only files of a size in the registry (a few rows, read
    on the driver) are opened. An archive must fit a task's memory, 2 GB at most.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern).load(root)
    )
    state = F.upper(F.element_at(F.split("path", "/"), -2))
    asked = F.broadcast(registry.select("state", "zip_bytes", "zip_md5"))
    sized = files.select("path", "length", state.alias("state")).join(asked, "state")
    sized = sized.withColumn("size_ok", F.col("length") == F.col("zip_bytes"))
    sizes = [r["zip_bytes"] for r in registry.select("zip_bytes").distinct().collect()]
    of_a_size = reduce(or_, (F.col("length") == size for size in sizes), F.lit(False))
    digests = files.where(of_a_size).select("path", F.md5("content").alias("md5"))
    return sized.join(digests, "path", "left").select(
        "state", "path", "size_ok",
        F.coalesce(F.col("size_ok") & (F.col("md5") == F.col("zip_md5")), F.lit(False)).alias("md5_ok"),
    )
