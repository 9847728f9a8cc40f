"""One table over all sources. Sources share no key, so nothing is ever deduplicated."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.citation import citation_text
from ..schema import check_kind


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    """Every row of every part, columns matched by name, absent ones null."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part, allowMissingColumns=True)
    return first


def federated_headers(parts: Iterable[DataFrame]) -> DataFrame:
    """Headers of all sources in query order: ``source_ord`` then ``row_no`` restores it."""
    return union_all(
        part.withColumn("source_ord", F.lit(i)) for i, part in enumerate(parts)
    )


def federated_logs(kind: str, national: DataFrame | None, states: DataFrame | None) -> DataFrame:
    """Intervals of one kind from all sources; national bores have no construction records."""
    check_kind(kind)
    parts = [states] if kind == "construction" else [national, states]
    present = [p for p in parts if p is not None]
    if present:
        return union_all(present)
    if national is None:
        raise ValueError(f"No source of this query has {kind} logs.")
    return national.limit(0)


def federated_citation(provenance: DataFrame, by: str, order: str = "source_ord") -> DataFrame:
    """Per query: its sources' citations, each once, in query order, as one text.

    Repeats are removed by an aggregate first, so what is collected is one short text per distinct
    source of a query, never its rows.
    """
    text = citation_text(
        F.col("citation"), F.col("fetched_at"), F.col("license"), F.col("source_url")
    )
    once = provenance.groupBy(by, text.alias("_text")).agg(F.min(order).alias("_ord"))
    ordered = F.sort_array(F.collect_list(F.struct("_ord", "_text")))
    return once.groupBy(by).agg(F.array_join(ordered["_text"], " ").alias("citation"))


def federated_provenance(parts: dict[str, DataFrame]) -> DataFrame:
    """Provenance rows of every source of a query, tagged and in query order."""
    return union_all(
        part.withColumn("source", F.lit(tag)).withColumn("source_ord", F.lit(i))
        for i, (tag, part) in enumerate(parts.items())
    )
