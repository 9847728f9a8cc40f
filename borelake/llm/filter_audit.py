"""How the filters of a chain interact, from relations of failing ids.

1. Every row gets a key, and every filter its own table of the keys that fail it. Equal rows (one id,
   one text) share a key that counts them, so a row repeated without end is one entry.
2. Left-semi and left-anti joins with these tables, one pair a filter, part the keys into classes that
   fail the same filters; the classes are counted per part with the labels they hold. The tables are
   as narrow as a key, and no join knows of orders, so the work is two joins a filter whatever number
   of orders is asked for.
3. Classes are few (at most two to the number of filters, per part). For every order and step,
   left-anti joins with the failing relations of the filters before it give the survivors, a left-semi
   join with its own relation what it removes, a left-semi join with the earlier ones what was gone
   already, and a left-anti join with all others what fails it alone.

Defined results: a null text is empty and a null part an empty string; a null id is no smaller and no
larger than another, so its text repeats nobody and counts as nobody's original; a null label is none,
and of several labels of one id the greatest counts; repeated rows count each; other columns are
ignored; an empty table has no parts and so no rows.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import park
from ..functions.coerce import quoted
from ..operators.hot_keys import spread_join

# The largest number of filters, as every order and every set of failed filters gets rows.
MOST_FILTERS = 6
_SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The maximal runs of a text without ASCII white space."""
    return F.filter(F.split(text, _SPACE), lambda w: w != "")


def text_filters(text: Column, short: int = 100, distinct: int = 80, upper: int = 10) -> dict[str, Column]:
    """Conditions under which a text fails: too few words, too many repeated words, too many capitals
    (the last two in hundredths), a control sign."""
    said = words(text)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]", ""))
    return {
        "A": F.size(said) < short,
        "B": 100 * F.size(F.array_distinct(said)) < distinct * F.size(said),
        "C": 100 * capitals.cast("bigint") > upper * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def entries(
    df: DataFrame, labels: DataFrame, conditions: Mapping[str, Column], part_col: str = "lang",
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``key, doc_id, sha, part, n, good, toxic`` and ``fails_<filter>`` of every distinct row, written once.

    ``conditions`` are over the column ``text``, which is never null here. Texts do not shuffle.
    """
    plain = df.select(
        quoted(id_col).alias("doc_id"), F.coalesce(quoted(text_col), F.lit("")).alias("text"),
        F.coalesce(quoted(part_col), F.lit("")).alias("part"),
    )
    fails = [F.coalesce(c, F.lit(False)).alias(f"fails_{f}") for f, c in conditions.items()]
    read = plain.select("doc_id", "part", F.sha2("text", 256).alias("sha"), *fails)
    same = ["doc_id", "part", "sha", *[f"fails_{f}" for f in conditions]]
    rows = read.groupBy(*same).agg(F.count(F.lit(1)).alias("n"))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.max("quality") == 1).alias("good"), (F.max("toxic") == 1).alias("toxic")
    )
    marked = spread_join(rows, park(marks, "audit-labels"), ["doc_id"], "left")
    # 128 bits of the digest of all that tells a row from another.
    named = F.to_json(F.struct("doc_id", "part", "sha"), {"ignoreNullFields": "false"})
    return park(marked.select(
        F.substring(F.sha2(named, 256), 1, 32).alias("key"), *[F.col(c) for c in same], "n",
        *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")],
    ), "audit-entries")


def later_copies(rows: DataFrame) -> DataFrame:
    """Keys of rows whose text some smaller id has, in any part; removed rows are originals too."""
    firsts = rows.where(F.col("doc_id").isNotNull()).groupBy("sha").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
    )
    shared = park(firsts.where("last > first").drop("last"), "audit-shared")
    later = spread_join(
        rows.select("key", "doc_id", "sha"), shared, ["sha"], "left_semi", condition=F.col("doc_id") > F.col("first")
    )
    return later.select("key")


def failing(rows: DataFrame, names: Sequence[str], more: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """One written table of failing keys per filter: from its flag, or as given in ``more``."""
    return {
        f: park(more[f] if f in more else rows.where(f"fails_{f}").select("key"), f"failing-{f}") for f in names
    }


def classes(rows: DataFrame, fails: Mapping[str, DataFrame]) -> DataFrame:
    """``part, class, n, good, toxic``: rows per set of failed filters, ``class`` having a bit for each."""
    told = rows.select("key", "part", "n", "good", "toxic", F.lit(0).alias("class"))
    for bit, (name, relation) in enumerate(fails.items()):
        lost = spread_join(told, relation, ["key"], "left_semi")
        left = spread_join(told, relation, ["key"], "left_anti")
        # Written, as each branch of the next filter would else work out both of this one again.
        told = park(
            lost.withColumn("class", F.col("class").bitwiseOR(F.lit(1 << bit))).unionByName(left), f"told-{name}"
        )
    return told.groupBy("part", "class").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


_STEPS = "array<struct<filter_order:string,step:int,filter:string,before:array<string>,others:array<string>>>"


def _steps(names: Sequence[str], orders: Sequence[Sequence[str]]) -> Column:
    """All steps of all orders as one constant array."""
    return F.from_json(F.lit(json.dumps([
        {"filter_order": "".join(order), "step": step, "filter": order[step - 1], "before": order[: step - 1],
         "others": [f for f in names if f != order[step - 1]]}
        for order in orders for step in range(1, len(order) + 1)
    ])), _STEPS)


def order_steps(counted: DataFrame, names: Sequence[str], orders: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """One row per part, order and step, zeros included, from the rows per class of failed filters.

    ``shapley`` is the filter's ``removed`` summed over all orders given.
    """
    orders = list(permutations(names)) if orders is None else [tuple(o) for o in orders]
    kinds = counted.select("class").distinct()
    relation = kinds.select(
        F.explode(F.filter(
            F.array(*[F.when(F.col("class").bitwiseAND(F.lit(1 << i)) != 0, F.lit(f)) for i, f in enumerate(names)]),
            lambda f: f.isNotNull(),
        )).alias("failed"), "class",
    )
    # The failing relations over classes: which filters each class fails.
    relation = park(relation, "failing-classes")
    told = counted.withColumn("_at", F.explode(_steps(names, orders))).select(*counted.columns, "_at.*")
    told = park(told, "audit-steps")
    place = ["filter_order", "step", "class"]
    all_steps = told.select(*place, "filter", "before", "others").distinct()

    def meeting(column: str) -> DataFrame:
        """Places where the class fails one of the filters of ``column``."""
        each = all_steps.select(*place, F.explode(column).alias("failed"))
        return each.join(relation, ["failed", "class"], "left_semi").select(*place).distinct()

    own = relation.withColumnRenamed("failed", "filter")
    gone, elsewhere = park(meeting("before"), "audit-gone"), meeting("others")
    hit = told.join(own, ["filter", "class"], "left_semi")
    removed = hit.join(gone, place, "left_anti")
    survivors = told.join(gone, place, "left_anti").join(own, ["filter", "class"], "left_anti")
    redundant = hit.join(gone, place, "left_semi")
    alone = hit.join(elsewhere, place, "left_anti")

    by = ["part", "filter_order", "step", "filter"]
    zero = {c: F.lit(0).cast("bigint") for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")}

    def tally(rows: DataFrame, **columns: str) -> DataFrame:
        return rows.select(*by, *[(F.col(columns[c]) if c in columns else z).alias(c) for c, z in zero.items()])

    parts = [
        tally(told), tally(survivors, kept="n"), tally(removed, removed="n", good_lost="good", toxic_lost="toxic"),
        tally(redundant, redundant="n"), tally(alone, unique_fails="n"),
    ]
    steps = park(
        reduce(DataFrame.unionByName, parts).groupBy(*by).agg(*[F.sum(c).alias(c) for c in zero]), "audit-steps"
    )
    shapley = steps.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return steps.join(shapley, ["part", "filter"]).select("part", "filter_order", "step", *zero, "shapley")


def audit(
    df: DataFrame, labels: DataFrame, part_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
    conditions: Mapping[str, Column] | None = None, copies: str | None = "E", orders: Sequence[Sequence[str]] | None = None,
) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.

    ``conditions``: filter name to the condition over ``text`` under which a row fails, ``text_filters``
    by default; ``copies`` names one more filter, failed by texts that a smaller id has too; ``orders``:
    chains of all filters, every permutation by default. Names are one letter.
    """
    conditions = text_filters(F.col("text")) if conditions is None else dict(conditions)
    names = [*conditions, *([copies] if copies else [])]
    if len(names) > MOST_FILTERS or any(len(f) != 1 for f in names) or len(set(names)) < len(names):
        raise ValueError(f"filters need distinct one-letter names, at most {MOST_FILTERS} of them")
    rows = entries(df, labels, conditions, part_col, id_col, text_col)
    fails = failing(rows, names, {copies: later_copies(rows)} if copies else {})
    return order_steps(park(classes(rows, fails), "audit-classes"), names, orders)
