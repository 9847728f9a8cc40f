"""Where shared intermediate tables go, and how large a side may be to be broadcast."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Largest proven size, in bytes, of a join side this library broadcasts by itself.
BROADCAST_LIMIT = 32 * 1024 * 1024


# Fixed value: the JVM does not compile a method with more bytecode than this.
JIT_METHOD_LIMIT = "8000"


def tuned(spark: SparkSession) -> SparkSession:
    """The session, set up for wide mappings.

    A mapping of many text columns can generate one method too large for the JVM to compile, which
    then runs several times slower. With this limit Spark runs such a stage from smaller pieces.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", JIT_METHOD_LIMIT)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share one machine, may go without the
    setting; it then gets one temporary folder per process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_dir()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="borelake-")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def park(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts lineage and fixes what a sampled shuffle decided, so that several readers agree on
    it even after executors are lost. Unlike a checkpoint, later reads take only the columns used.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
