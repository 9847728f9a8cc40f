"""Features of landed pages, parsed once a page.

Parsed features are kept as Parquet below one root, a directory per reading, and an index tells which
reading holds a page of a given size and time. Only pages that the index does not know are opened;
pages that changed or went are left out by a join with the file listing. As with snapshots, index
rows are written after the data, so a reading that broke off is never seen, and of two readings of a
page one counts. What was replaced stays on disk.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import park
from ..operators.hot_keys import spread_join

_INDEX = "page string, stamp bigint, _entry string"


def listed_pages(spark: SparkSession, path: str) -> DataFrame:
    """``page, path, stamp`` of the files below a path, from their listing; no file is opened."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.col("_metadata.file_path").alias("page"), "path",
        F.xxhash64("length", F.unix_micros("modificationTime")).alias("stamp"),
    )


class KeptPages:
    """The parsed pages of one layer."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def index(self) -> DataFrame:
        """``page, stamp, _entry``: the reading that holds each page."""
        try:
            rows = self.spark.read.schema(_INDEX).parquet(f"{self.root}/index/*")
        except AnalysisException as error:
            if not (error.getCondition() or "").startswith("PATH_NOT_FOUND"):
                raise
            rows = self.spark.createDataFrame([], _INDEX)
        return rows.groupBy("page", "stamp").agg(F.max("_entry").alias("_entry"))

    def features(
        self, path: str, read: Callable[[list[str]], DataFrame], anew: bool = False
    ) -> DataFrame:
        """The features of the pages now below ``path``; ``read`` parses those not yet kept, or all ``anew``.

        ``read`` gets paths and returns a table with a column ``page``; its other columns are kept as
        they are. Without any page the table is that of a read of nothing, so ``path`` must hold a file.
        """
        listed = park(listed_pages(self.spark, path), "listed-pages")
        fresh = listed if anew else listed.join(self.index(), ["page", "stamp"], "left_anti")
        paths = [row["path"] for row in fresh.select("path").collect()]  # names alone, as a file listing has them
        entry = None
        if paths:
            entry = uuid.uuid4().hex
            read(paths).withColumn("_entry", F.lit(entry)).write.parquet(f"{self.root}/features/{entry}")
            fresh.select("page", "stamp", F.lit(entry).alias("_entry")).coalesce(1).write.parquet(f"{self.root}/index/{entry}")
        held = self.index()
        if anew:
            held = held.withColumn("_entry", F.lit(entry))
        valid = park(listed.join(held, ["page", "stamp"]).select("page", "_entry"), "valid-pages")
        kept = self.spark.read.parquet(f"{self.root}/features/*")
        return spread_join(kept, valid, ["page", "_entry"], "inner").select(
            *[F.col(f"`{c}`") for c in kept.columns if c != "_entry"]
        )
