"""Dense positions and ordered interval lists, without a one-task window.

A window over a whole source, or over one bore that holds a third of all rows, is a single task.
Here the ordering is cut into ranges of about equal rows first, from a bounded sample of its keys, so
that even one bore is split between tasks. A row's position in its range and group, plus the rows of
that group in the ranges before, is its position. Only a group that a cut falls into has rows in
several ranges, so these offsets are no more than a few per range, whatever the number of groups.

Keys alone are written to the shared folder and counted; wide rows are shuffled once, by range.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import park

# Ranges per shuffle partition, and keys that the driver looks at per range to cut them.
RANGES, LOOKED_AT = 2, 40
# Cuts that are compared as constants; more go into a constant array.
IN_CODE = 31
# Rows that a task numbers, so that it sorts them in memory whatever the setting of shuffle partitions.
TASK_ROWS = 500_000
# Rows of a range that may be sorted in one task to find the row of a given rank.
SORTED_ROWS = 50_000


def _place(columns: Sequence[str]) -> Column:
    return F.struct(*(F.col(c).alias(f"_{i}") for i, c in enumerate(columns)))


class Cuts:
    """Places that cut an ordering into ranges of about equal rows."""

    def __init__(self, keys: DataFrame, columns: Sequence[str], ranges: int, n: int | None = None):
        n = keys.count() if n is None else n
        share = min(1.0, LOOKED_AT * ranges / max(1, n))
        some = keys if share == 1.0 else keys.sample(share, seed=1)
        place = some.select(_place(columns).alias("p"))
        # Sorted by Spark's own order of the types, nulls first; at most a few times the rows asked for.
        seen = [r["p"] for r in place.orderBy("p").collect()]
        self.places = []
        for i in range(1, ranges):
            at = seen[len(seen) * i // ranges] if seen else None
            if at is not None and (not self.places or self.places[-1] != at):
                self.places.append(at)
        self.columns = list(columns)
        self.schema = T.StructType([T.StructField(f"_{i}", keys.schema[c].dataType) for i, c in enumerate(columns)])

    def with_range(self, df: DataFrame, name: str = "_range") -> DataFrame:
        """``df`` with the number of cuts at or before each row's place.

        A few cuts are compared as constants. Many are halved step by step in an array, a column per step:
        Spark keeps a column that is used twice, so that no step is worked out again, and all of it is
        generated code. The array is a constant of the plan.
        """
        if len(self.places) <= IN_CODE:
            return df.withColumn(name, self._halved(0, len(self.places)))
        rows = [p.asDict() for p in self.places]
        table = F.from_json(F.lit(json.dumps(rows, default=str)), T.ArrayType(self.schema))
        passed = F.lit(0)
        placed = df.withColumn("_cut_place", _place(self.columns))
        step = 1 << (len(rows).bit_length() - 1)
        while step:
            reached = passed + F.lit(step)  # the cut of that number, if there are so many
            taken = (reached <= len(rows)) & (F.get(table, reached - 1) <= F.col("_cut_place"))
            placed = placed.withColumn(f"_cut_{step}", F.when(taken, reached).otherwise(passed))
            passed, step = F.col(f"_cut_{step}"), step // 2
        return placed.withColumn(name, passed).select(*[F.col(f"`{c}`") for c in df.columns if c != name], name)

    def in_range(self, number: int) -> Column:
        """Whether a row lies in the range of that number, told by its two cuts alone.

        A filter on the column of ``with_range`` would be moved below the steps that halve the cuts, and each step
        put in place of its name wherever it is used: three times as much of a plan for every step.
        """
        low = self._reached(self.places[number - 1]) if number else F.lit(True)
        return low & ~self._reached(self.places[number]) if number < len(self.places) else low

    def _halved(self, low: int, high: int) -> Column:
        """The number of cuts at or before a place that is known to be between ``low`` and ``high``."""
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        beyond = self._reached(self.places[middle])
        return F.when(beyond, self._halved(middle + 1, high)).otherwise(self._halved(low, middle))

    def _reached(self, cut) -> Column:
        """Whether a row's place is the cut or beyond it, column by column, nulls first."""
        reached = F.lit(True)
        for name, value in reversed(list(zip(self.columns, cut, strict=True))):
            column = F.col(name)
            if value is None:
                reached = column.isNotNull() | reached
            else:
                reached = F.coalesce((column > F.lit(value)) | (column == F.lit(value)) & reached, F.lit(False))
        return reached


def _ranges(df: DataFrame) -> int:
    return RANGES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_ordinal(
    df: DataFrame,
    order: Sequence[str],
    within: Sequence[str] = (),
    name: str = "ordinal",
    ends: str | None = None,
) -> DataFrame:
    """Adds the 1-based position of each row in ``order``, restarting for each ``within`` group.

    ``ends``, without ``within``, names a struct of a row's ``place`` in its range and whether it is the ``last`` one there.
    The rows of a range follow each other in one task, so that a writer may open and close there what it writes.

    Null ``within`` values are a group like any other; ``within + order`` must be unique for a
    repeatable result. The key columns are plain values (text, whole numbers, dates).
    """
    keys = [*within, *order]
    narrow = park(df.select(*keys), "ordinal-keys")
    n = narrow.count()
    tasks = n // TASK_ROWS
    cuts = Cuts(narrow, keys, max(_ranges(df), RANGES * tasks), n)
    ranged = cuts.with_range(narrow)
    group = F.struct(*(F.col(c).alias(f"_{i}") for i, c in enumerate(within))) if within else F.lit(0)
    if within:  # only groups that a cut falls into have rows in two ranges
        parted = T.StructType(cuts.schema.fields[: len(within)])
        groups = df.sparkSession.createDataFrame(
            [(p[: len(within)],) for p in cuts.places], T.StructType([T.StructField("_split", parted)])
        ).distinct()
        ranged = ranged.join(F.broadcast(groups), group.eqNullSafe(F.col("_split")), "left_semi")
    counted = ranged.groupBy(group.alias("_group"), "_range").agg(F.count(F.lit(1)).alias("_n"))
    # a few rows per range
    before = F.sum("_n").over(Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = park(counted.select("_group", "_range", F.coalesce(before, F.lit(0)).alias("_before"), "_n"), "ordinal-offsets")
    offsets = offsets.withColumnsRenamed({"_group": "_of_group", "_range": "_of_range", "_n": "_of_n"})
    place = F.row_number().over(Window.partitionBy(*within, "_range").orderBy(*order))
    wide = cuts.with_range(df)
    if RANGES * tasks > _ranges(df):
        wide = wide.repartition(tasks, "_range")
    found = wide.withColumn("_place", place).withColumn("_group", group).join(
        F.broadcast(offsets), F.col("_group").eqNullSafe(F.col("_of_group")) & (F.col("_range") == F.col("_of_range")), "left"
    )
    last = (F.col("_place") == F.col("_of_n")).alias("last")
    placed = [] if ends is None else [F.struct(F.col("_place").alias("place"), last).alias(ends)]
    return found.select(*df.columns, (F.coalesce("_before", F.lit(0)) + F.col("_place")).cast("bigint").alias(name), *placed)


def key_at(df: DataFrame, position: int, order: Sequence[str]) -> dict | None:
    """The ``order`` columns of the row at a position, from 0, or from the end where negative.

    Rows are counted by ranges of the ordering, and the range that holds the row is cut again, until
    one is small enough to be sorted in a task. None beyond either end.
    """
    rows = df.select(*order)
    n = rows.count()
    rank = position if position >= 0 else n + position
    if not 0 <= rank < n:
        return None
    while n > SORTED_ROWS:
        cuts = Cuts(rows, order, _ranges(df), n)
        counts = cuts.with_range(rows).groupBy("_range").count().collect()
        for r in sorted(counts, key=lambda r: r["_range"]):
            if rank < r["count"]:
                break
            rank -= r["count"]
        if r["count"] == n:  # equal places, which no cut parts
            break
        rows, n = rows.where(cuts.in_range(r["_range"])), r["count"]
    return rows.orderBy(*order).offset(rank).limit(1).first().asDict()


def equal_to(key: dict) -> Column:
    """Rows whose columns have just these values."""
    return reduce(and_, (F.col(c).eqNullSafe(F.lit(v)) for c, v in key.items()))


def interval_rows(
    logs: DataFrame, key: str = "bore_key", order: str = "row_no", columns: Sequence[str] | None = None
) -> DataFrame:
    """Each bore's intervals in row order, one per row: ``key, position, order, columns...``.

    Positions start at 1. Rows without a key belong to no bore and are left out. The plan is the
    same for logs of any length.
    """
    return with_ordinal(_keyed(logs, key, order, columns), [order], [key], "position")


def interval_lists(
    logs: DataFrame, limit: int, key: str = "bore_key", order: str = "row_no", columns: Sequence[str] | None = None
) -> DataFrame:
    """Each bore's intervals as arrays of up to ``limit``: ``key, part, n_parts, n, intervals``.

    A log of more than ``limit`` intervals has several parts, numbered from 0; none is truncated.
    """
    rows = interval_rows(logs, key, order, columns)
    item = F.struct(*(c for c in rows.columns if c not in (key, "position")))
    lists = rows.groupBy(key, F.floor((F.col("position") - 1) / limit).cast("bigint").alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(item)).alias("intervals")
    )
    n_parts = F.count(F.lit(1)).over(Window.partitionBy(key))
    return lists.withColumn("n_parts", n_parts).select(key, "part", "n_parts", "n", "intervals")


def _keyed(logs: DataFrame, key: str, order: str, columns: Sequence[str] | None) -> DataFrame:
    columns = [c for c in (columns or logs.columns) if c not in (key, order)]
    return logs.where(F.col(key).isNotNull()).select(key, order, *columns)
