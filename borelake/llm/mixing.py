"""Mixing sources to target weights by hierarchical budgeting.

The levels of a tree (domain, language, source) carry weights. From the root down, a node's token
budget is shared among its children in proportion to their weights; a child that cannot use its share
(its documents, repeated ``max_epochs`` times, hold fewer tokens) is given what it has, and the rest
goes to its siblings. Since a node never gets more than its leaves hold, a shortage reaches a node's
siblings only once all its own children are full. At one level this is water-filling: with children
in order of capacity over weight, the water level is the greatest of
(budget - capacity before) / (weight from here on).

A leaf with budget b over s tokens takes every document ``b div s`` times and, from one more epoch
with its own seeded order, the longest prefix of documents that fits the remaining tokens. That
prefix is found without sorting a leaf in one task: order keys are uniform, so tokens are first summed
in bins of about ``BIN_ROWS`` rows, and only the bin where the prefix ends is ordered. The tree has a
row per leaf; documents meet it in a join that broadcasts it behind a check of its size, and else
salts hot leaves. Texts never shuffle for it.

Defined results: a null level value counts as empty; a weight not given is 1 and a weight of 0 takes nothing; rows of one id and epoch
share an order key and are taken together or not at all; extra columns are carried; a column that is
named like an added one is replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import park
from ..functions.coerce import quoted
from ..operators.hot_keys import spread_join

# Documents of a bin of the order, about; at most 2 to the 20th bins a leaf.
BIN_ROWS, BIN_DIGITS = 4096, 5


def word_count(text: Column) -> Column:
    """The words between ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def _weight(column: Column, weights: Mapping[str, int]) -> Column:
    found = F.lit(1)
    for name, weight in weights.items():
        found = F.when(column == name, F.lit(weight)).otherwise(found)
    return found


def _fill(nodes: DataFrame, parents: Sequence[str], name: str) -> DataFrame:
    """``nodes`` (``supply``, ``weight``, the parent's ``given``) with their own share as ``budget``."""
    capacity = F.when(F.col("weight") > 0, F.col("supply")).otherwise(0)
    weight = F.when(F.col("weight") > 0, F.col("weight")).otherwise(1)
    nodes = nodes.withColumns({"capacity": capacity, "weight": weight})
    siblings = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = siblings.orderBy(F.col("capacity") / F.col("weight"), name)
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    onward = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    nodes = nodes.withColumn("water", (F.col("given") - before).cast("double") / onward.cast("double"))
    nodes = nodes.withColumn("water", F.max("water").over(siblings))
    share = F.floor(F.col("weight") * F.col("water") + F.lit(1e-6)).cast("bigint")
    return nodes.withColumn("budget", F.least("capacity", F.greatest(share, F.lit(0)))).drop("water", "weight", "capacity", "given")


def leaf_budgets(
    leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], share: float, max_epochs: int
) -> DataFrame:
    """``*levels, n_rows, tokens, budget`` per leaf of ``*levels, n_rows, tokens``.

    The root's budget is ``floor(share * all tokens)``.
    """
    leaves = leaves.withColumn("supply", F.col("tokens") * max_epochs)
    given = leaves.agg(F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * F.lit(share)).cast("bigint").alias("given"))
    root = given.first()["given"]
    above: DataFrame | None = None
    for depth, name in enumerate(levels, 1):
        path = list(levels[:depth])
        last = depth == len(levels)
        nodes = leaves if last else leaves.groupBy(*path).agg(F.sum("supply").alias("supply"))
        nodes = nodes.withColumn("weight", _weight(F.col(name), weights.get(name, {})))
        if above is None:
            nodes = nodes.withColumn("given", F.lit(root))
        else:
            nodes = nodes.join(above.select(*path[:-1], F.col("budget").alias("given")), path[:-1])
        above = _fill(nodes, path[:-1], name)
    return above.drop("supply")


def _order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    doc_id = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), doc_id).cast("binary"))


def _bin(key: Column, bits: Column) -> Column:
    head = F.conv(F.substring(key, 1, BIN_DIGITS), 16, 10).cast("bigint")
    return F.floor(head / F.pow(F.lit(2), F.lit(4 * BIN_DIGITS) - bits)).cast("bigint")


def mix(
    df: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], share: float,
    max_epochs: int = 1, seed: int = 0, tokens: Column | None = None, id_col: str = "doc_id",
) -> DataFrame:
    """All rows, with ``n_tokens`` and ``copies``: how many times the mixture holds each.

    ``tokens`` gives a row's token count; its words by default.
    """
    levels = list(levels)
    tokens = word_count(F.col("text")) if tokens is None else tokens
    keyed = df.withColumn("n_tokens", tokens.cast("bigint"))
    plain = {f"_level{i}": F.coalesce(quoted(c).cast("string"), F.lit("")) for i, c in enumerate(levels)}
    keyed, names = keyed.withColumns(plain), list(plain)
    narrow = park(keyed.select(quoted(id_col).alias("doc_id"), *names, "n_tokens"), "mix-rows")

    counted = narrow.groupBy(*names).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n_tokens").alias("tokens"))
    renamed = {name: weights.get(level, {}) for name, level in zip(names, levels, strict=True)}
    budgets = leaf_budgets(park(counted, "mix-leaves"), names, renamed, share, max_epochs)
    one = F.greatest("tokens", F.lit(1))
    bits = F.ceil(F.log2(F.greatest(F.col("n_rows") / F.lit(BIN_ROWS), F.lit(1.0))))
    leaves = park(budgets.select(
        *names, F.floor(F.col("budget") / one).alias("full"), (F.col("budget") % one).alias("rest"),
        F.least(bits, F.lit(4 * BIN_DIGITS)).cast("int").alias("bits"),
    ), "mix-budgets")

    key = _order_key(seed, F.col("full"), F.col("doc_id"))
    placed = spread_join(narrow, leaves, names).withColumn("key", key).withColumn("bin", _bin(F.col("key"), F.col("bits")))
    bins = placed.groupBy(*names, "bin").agg(F.sum("n_tokens").alias("held"), F.first("rest").alias("rest"))
    upto = F.sum("held").over(Window.partitionBy(*names).orderBy("bin"))
    # The first bin that does not fit whole; beyond the last one when all do.
    ends = bins.withColumn("upto", upto).withColumn("fits", F.col("upto") <= F.col("rest")).groupBy(*names).agg(
        F.coalesce(F.min(F.when(~F.col("fits"), F.col("bin"))), F.lit(1 << 4 * BIN_DIGITS)).alias("end"),
        F.coalesce(F.max(F.when(F.col("fits"), F.col("upto"))), F.lit(0)).alias("before"),
    )
    ends = park(leaves.join(ends, names), "mix-ends")
    edge = spread_join(narrow, ends, names).withColumn("key", key)
    edge = edge.where(_bin(F.col("key"), F.col("bits")) == F.col("end"))
    running = F.sum("n_tokens").over(Window.partitionBy(*names).orderBy("key"))  # equal keys count together
    last = edge.withColumn("running", running).where(F.col("before") + F.col("running") <= F.col("rest"))
    last = last.groupBy(*names).agg(F.max("key").alias("last"))
    cuts = park(ends.join(last, names, "left").select(
        *names, F.struct("full", "bits", "end", F.coalesce("last", F.lit("")).alias("last")).alias("_cut")
    ).select(*names, "_cut.*").withColumnsRenamed({c: f"_{c}" for c in ("full", "bits", "end", "last")}), "mix-cuts")

    own = _order_key(seed, F.col("_full"), quoted(id_col))
    place = _bin(own, F.col("_bits"))
    taken = (place < F.col("_end")) | ((place == F.col("_end")) & (own <= F.col("_last")))
    copies = (F.col("_full") + (taken & (F.col("_full") < max_epochs)).cast("bigint")).cast("bigint")
    mixed = spread_join(keyed, cuts, names).withColumn("copies", copies)
    return mixed.drop(*names, "_full", "_bits", "_end", "_last")


def mixture(df: DataFrame, *args, **kwargs) -> DataFrame:
    """The mixed rows themselves: each as often as ``mix`` says, with the columns of ``df``."""
    mixed = mix(df, *args, **kwargs).where("copies > 0")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        *[quoted(c) for c in df.columns]
    )
