"""Equi-joins that stay balanced when one key, or the null key, holds a large share of the rows.

The small side is measured first: when its bytes are within the broadcast limit it is broadcast,
and the big side, a hot key or not, is not shuffled at all.

Otherwise both sides shuffle. Adaptive execution splits a skewed partition only for some plan
shapes, so the heavy keys of the big side are measured by a count per key (partial sums, key
columns only) and each gets as many salts as it has blocks of ``HOT_ROWS`` rows; the other side
repeats its rows of those keys once per salt. Nothing is dropped, and without heavy keys the join
is the plain one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BROADCAST_LIMIT, park
from ..functions.coerce import quoted

# A key with more rows than this is spread over several tasks.
HOT_ROWS = 1_000_000
# Rows of much work that are left to one task.
DEALT_ROWS = 2_000
# Rows without a key can match nothing; where they are kept they are spread this wide.
NULL_SPREAD = 512
# Types whose values take a bounded number of bytes beside their text.
FLAT_TYPES = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType)
# Where the table of heavy keys is itself too large to broadcast, it is repeated so often to reach
# their rows, which are dealt to as many tasks meanwhile.
KEY_SPREAD = 64


def hot_keys(big: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and how many salts each needs: ``*keys, _salts``.

    At most one key per ``hot_rows`` rows can qualify.
    """
    counted = big.where(~_any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counted.where(F.col("_n") > hot_rows).select(
        *keys, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_salts")
    )


def flat_bytes(df: DataFrame) -> float:
    """Bytes of a table of plain columns: its text, and sixteen for every value; one pass.

    Infinite when a nested column makes that no bound.
    """
    text = []
    for field in df.schema:
        if not isinstance(field.dataType, FLAT_TYPES):
            return float("inf")
        if isinstance(field.dataType, T.StringType):
            text.append(F.coalesce(F.octet_length(quoted(field.name)), F.lit(0)))
    row = df.agg(
        F.count(F.lit(1)).alias("n"), F.sum(reduce(add, text, F.lit(0).cast("bigint"))).alias("text")
    ).first()
    return row["n"] * 16 * (len(df.columns) + 1) + (row["text"] or 0)


def side_bytes(df: DataFrame) -> float:
    """The same for a table that may also hold arrays of numbers, whose values count like others."""
    lists = [
        f.name for f in df.schema if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.NumericType)
    ]
    if not lists:
        return flat_bytes(df)
    sizes = {c: F.greatest(F.size(quoted(c)), F.lit(0)) for c in lists}
    values = df.agg(F.sum(reduce(add, sizes.values(), F.lit(0).cast("bigint")))).first()[0] or 0
    return flat_bytes(df.withColumns(sizes)) + 16 * values


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, (F.col(k).isNull() for k in keys))


def _row_number_like(df: DataFrame, keys: Sequence[str]) -> Column:
    """A value that differs between rows: of their landed number, else of their plain columns but the keys.

    It depends on the row alone, so a map task that is run again deals its rows as before. Only rows
    that hold nothing else plain are told apart by their place in the task.
    """
    for ordinal in ("row_no", "l_row_no"):
        if ordinal in df.columns:
            return F.xxhash64(ordinal)
    plain = [quoted(f.name) for f in df.schema if isinstance(f.dataType, FLAT_TYPES) and f.name not in keys]
    return F.xxhash64(*plain) if plain else F.monotonically_increasing_id()


def spread_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    hot_rows: int | None = None,
    condition: Column | None = None,
    limit: int = BROADCAST_LIMIT,
    hint: str | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """``big`` joined to ``small`` (inner, left, left_semi or left_anti) with heavy keys salted.

    The key columns appear once in the result; ``condition`` is tested on pairs of equal keys.
    ``hint`` is a join hint for ``small`` where it is not broadcast; it is put on the final join,
    since a join below would swallow it. ``tasks`` is for joins of few bytes and many pairs, which adaptive
    execution would leave to few tasks: without a broadcast both sides are dealt to so many.
    """
    keys = list(keys)
    if limit and side_bytes(small) <= limit:
        return key_join(big, F.broadcast(small), keys, how, condition)
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    hot = hot_keys(big, keys, hot_rows)
    n_hot = hot.count()
    keeps_nulls = how in ("left", "left_anti")
    if n_hot == 0 and not keeps_nulls:
        return key_join(dealt(big, tasks, keys), hinted(dealt(small, tasks, keys), hint), keys, how, condition)
    spot = _row_number_like(big, keys)
    salt = F.lit(0)
    if n_hot:
        hot = park(hot, "hot-keys")
        big = with_salts(big, hot, keys)
        small = with_salts(small, hot, keys).withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
        ).drop("_salts")
        salt = F.when(F.col("_salts").isNotNull(), F.pmod(spot, F.col("_salts"))).otherwise(salt)
    else:
        small = small.withColumn("_salt", F.lit(0))
    if keeps_nulls:
        salt = F.when(_any_null(keys), F.pmod(spot, F.lit(NULL_SPREAD))).otherwise(salt)
    big = big.withColumn("_salt", salt.cast("int")).drop("_salts")
    salted = [*keys, "_salt"]
    return key_join(dealt(big, tasks, salted), hinted(dealt(small, tasks, salted), hint), salted, how, condition).drop("_salt")


def with_salts(df: DataFrame, hot: DataFrame, keys: Sequence[str], limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``df`` with ``_salts`` of its heavy keys, null for others; never shuffled on the bare keys.

    The heavy keys are broadcast when their measured bytes allow it. Else they are repeated
    ``KEY_SPREAD`` times, and the rows of ``df`` meet one of the copies each.
    """
    if flat_bytes(hot) <= limit:
        return df.join(F.broadcast(hot), list(keys), "left")
    copies = hot.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(KEY_SPREAD - 1))))
    deal = F.pmod(_row_number_like(df, keys), F.lit(KEY_SPREAD)).cast("int")
    dealt = df.withColumn("_deal", deal).join(copies.hint("merge"), [*keys, "_deal"], "left")
    return dealt.drop("_deal")


def most_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def over_tasks(df: DataFrame) -> DataFrame:
    """A table whose rows cost much work for their bytes, such as polygons, dealt to as many tasks as may be.

    A scan would leave them to few. ``DEALT_ROWS`` or fewer stay as they are.
    """
    tasks = min(most_tasks(df), df.count() // DEALT_ROWS + 1)
    return df.repartition(tasks) if tasks > 1 else df


def dealt(df: DataFrame, tasks: int | None, keys: Sequence[str]) -> DataFrame:
    """``df`` partitioned by its keys into so many tasks, which adaptive execution does not merge."""
    return df.repartition(tasks, *keys) if tasks else df


def hinted(df: DataFrame, hint: str | None) -> DataFrame:
    return df.hint(hint) if hint else df


def key_join(big: DataFrame, small: DataFrame, keys: list[str], how: str, condition) -> DataFrame:
    """The plain join on equal key names, with an extra condition on pairs if there is one."""
    if condition is None:
        return big.join(small, keys, how)
    theirs = [f"_their_{k}" for k in keys]
    equal = reduce(and_, (F.col(k) == F.col(t) for k, t in zip(keys, theirs, strict=True)))
    renamed = small.withColumnsRenamed(dict(zip(keys, theirs, strict=True)))
    return big.join(renamed, equal & condition, how).drop(*theirs)
