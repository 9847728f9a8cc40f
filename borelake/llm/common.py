"""What the operators share: the columns they read, batches through Python, crc folds."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..config import park
from ..functions.coerce import quoted

# Bytes of text that a classifier learns from, at most.
SAMPLE_BYTES = 64 << 20
# Rows of one Arrow batch that Python holds as objects at a time.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` alone; a null text is empty. Other columns, whatever their names, go."""
    return df.select(
        quoted(id_col).alias("doc_id"), F.coalesce(quoted(text_col), F.lit("")).alias("text")
    )


def fold(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % parts


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut to ``rows`` rows, so that long texts never pile up as Python objects."""
    return chain.from_iterable(
        (b.slice(at, rows) for at in range(0, b.num_rows, rows)) for b in batches
    )


def by_slice(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """Rows through a Python function of small batches; ``make`` builds it once a task.

    Columns are numbered on the way, as ``mapInArrow`` takes no names with dots.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    numbered = StructType([StructField(f"_{i}", f.dataType) for i, f in enumerate(schema.fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for piece in slices(batches):
            yield pa.RecordBatch.from_arrays(work(piece).columns, names=numbered.names)

    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return plain.mapInArrow(run, numbered).toDF(*schema.names)


def bounded_rows(rows: DataFrame, most_rows: int, most_bytes: int = SAMPLE_BYTES, within: str | None = None) -> DataFrame:
    """At most so many rows, with at most so many bytes of ``text``, of each value of ``within``.

    ``rows``: ``doc_id, text`` and flat columns. Rows are taken by the least hash of id and text, so the
    choice depends on the rows alone; one that would pass the bytes is left out for later ones. Equal
    rows count and appear once. Texts do not move before they are chosen: hashes and sizes are written
    first, thinned by their count to about the bound, and ranked on the driver.
    """
    group = quoted(within) if within else F.lit(0)
    placed = rows.withColumns({"_place": F.xxhash64("doc_id", "text"), "_group": group})
    sizes = park(
        placed.groupBy("_group", "_place").agg(F.first(F.octet_length("text")).cast("bigint").alias("_size")), "sample"
    )
    totals = sizes.groupBy(F.col("_group").alias("_of")).agg((1.5 * most_rows / F.count(F.lit(1))).alias("_share"))
    thinned = sizes.join(F.broadcast(totals), F.col("_group").eqNullSafe(F.col("_of"))).where(
        F.pmod("_place", F.lit(1 << 30)) < F.col("_share") * (1 << 30)
    ).select("_group", "_place", "_size")
    chosen, taken = [], {}
    for group_value, place, size in sorted(map(tuple, thinned.collect()), key=lambda r: r[1]):
        n, held = taken.get(group_value, (0, 0))
        if n < most_rows and held + size <= most_bytes:
            taken[group_value] = (n + 1, held + size)
            chosen.append((group_value, place))
    kept = rows.sparkSession.createDataFrame(chosen, f"_in {sizes.schema['_group'].dataType.simpleString()}, _at bigint")
    mine = (F.col("_place") == F.col("_at")) & F.col("_group").eqNullSafe(F.col("_in"))
    return placed.join(F.broadcast(kept), mine, "left_semi").drop("_place", "_group").distinct()


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, parts: int, held: int, bound: int
) -> DataFrame:
    """``doc_id, text, label`` of at most ``bound`` labelled rows outside the held fold.

    The rows are of the ``bound`` labelled ids of least hash, which alone are broadcast; where ids
    repeat, rows and their bytes are bounded, too. A null label or id is no label; of several labels
    of one id the greatest counts.
    """
    usable = labels.where(F.col(label_col).isNotNull() & (fold(F.col("doc_id"), parts) != held))
    chosen = (
        usable.groupBy("doc_id").agg(F.max(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    )
    return bounded_rows(docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label"), bound)
