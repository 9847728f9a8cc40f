"""SimHash near-dedup through a hierarchical index over fingerprints in Gray order.

1. A text's fingerprint takes, bit by bit, the majority of its shingles' XXH64 values.
2. Distinct fingerprints (copies meet by partial aggregation) enter the index. Its upper nodes are
   shared masked bit patterns: of four 16-bit blocks at least two agree between fingerprints that
   differ in at most two bits, so each fingerprint enters six nodes, one per pair of blocks. A node
   with over ``NODE_LIMIT`` members is split below three finer patterns, of which close members
   again share one; after two splits at most 65,536 patterns can share a node. So no cap on members is needed.
3. In a node members are sorted by Gray rank, which puts those that share leading bits side by side.
   Runs form leaves, leaves form upper levels; each level keeps the bits its members agree on. Pairs
   of groups are followed from the top and dropped as soon as the differences accumulated in their
   common masked bits exceed the distance. A node yields a spanning forest of its links, not all pairs.
4. Links become components by alternating star contraction, written out after each round.

Defined results: a null or empty text has fingerprint zero and is linked like any other; the
component id is the least non-null id, null if there is none; repeated rows and ids give a row each;
other columns are ignored; an empty table gives no rows. ``keep_one`` carries all columns and keeps
exactly one row of each component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import park
from ..functions.coerce import quoted
from ..operators.hot_keys import spread_join
from .common import by_slice

NODE_LIMIT = 1 << 15
LEAF, FAN = 16, 8
# Pairs of groups followed at a time.
_CHUNK = 1 << 12
_ALL = (1 << 64) - 1
_SEED = 42


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


BLOCKS = [0xFFFF << (16 * i) for i in range(4)]
TOP_MASKS = [a | b for a, b in combinations(BLOCKS, 2)]


def finer(mask: int) -> list[int]:
    """The mask with one of three thirds of the remaining bits, none of them empty, added."""
    free = [bit for bit in range(64) if not mask >> bit & 1]
    cuts = [len(free) * i // 3 for i in range(4)]
    return [mask | sum(1 << bit for bit in free[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def fingerprint(text: str, size: int = 3) -> int:
    """The signed 64-bit fingerprint of a text's ``size``-word shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    shingles = map(b" ".join, zip(*[words[i:] for i in range(min(size, len(words)))], strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, _SEED) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id, fp bigint`` of every row, and the columns of ``keep``; no shuffle."""
    docs = df.select(quoted(id_col).alias("doc_id"), *[quoted(c) for c in keep], F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    schema = docs.drop("text").schema.add("fp", "long")

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [fingerprint(text, size) for text in batch.column(batch.num_columns - 1).to_pylist()]
            return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.int64())], names=schema.names)

        return work

    return by_slice(docs, make, schema)


def gray_rank(fp: Column) -> Column:
    """The place of a bit pattern in the reflected Gray sequence."""
    for shift in (32, 16, 8, 4, 2, 1):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


class Forest:
    """Which members of a node are linked so far."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            low, high = np.minimum(x, y)[apart], np.maximum(x, y)[apart]
            target = np.arange(len(self.label))
            np.minimum.at(target, high, low)
            while (target[target] != target).any():
                target = target[target]
            self.label = target[self.label]


def _levels(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """From the leaves up: for each group the bits all members share, and their values."""
    levels, ands, ors, step = [], fps, fps, LEAF
    while not levels or len(ands) > FAN:
        at = np.arange(0, len(ands), step)
        ands, ors = np.bitwise_and.reduceat(ands, at), np.bitwise_or.reduceat(ors, at)
        mask = ~(ands ^ ors)
        levels.append((mask, ands & mask))
        step = FAN
    return levels


def _below(a: np.ndarray, b: np.ndarray, fan: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of children, each once, of pairs of groups; which pair each comes from."""
    i, j = (x.ravel() for x in np.meshgrid(np.arange(fan), np.arange(fan), indexing="ij"))
    x, y = (a[:, None] * fan + i).ravel(), (b[:, None] * fan + j).ravel()
    kept = (x <= y) & (x < n) & (y < n)
    return x[kept], y[kept], np.repeat(np.arange(len(a)), fan * fan)[kept]


def link_node(fps: np.ndarray, distance: int) -> np.ndarray:
    """For each of a node's distinct fingerprints, in Gray order, the label of its linked set."""
    forest, levels = Forest(len(fps)), _levels(fps)
    top = len(levels) - 1
    a, b = np.triu_indices(len(levels[top][0]))
    none = np.zeros(len(a), np.uint64)
    # A pair of groups: its numbers, the masked bits compared so far, the differences found in them.
    stack = [(top, a, b, none, np.zeros(len(a), np.int64))]
    while stack:
        level, a, b, seen, so_far = stack.pop()
        if len(a) > _CHUNK:
            stack.append((level, a[_CHUNK:], b[_CHUNK:], seen[_CHUNK:], so_far[_CHUNK:]))
            a, b, seen, so_far = a[:_CHUNK], b[:_CHUNK], seen[:_CHUNK], so_far[:_CHUNK]
        mask, pattern = levels[level]
        both = mask[a] & mask[b]
        so_far = so_far + np.bitwise_count((pattern[a] ^ pattern[b]) & both & ~seen)
        near = so_far <= distance
        a, b, both, so_far = a[near], b[near], both[near], so_far[near]
        if not len(a):
            continue
        if level:
            x, y, origin = _below(a, b, FAN, len(levels[level - 1][0]))
            stack.append((level - 1, x, y, both[origin], so_far[origin]))
        else:
            x, y, _ = _below(a, b, LEAF, len(fps))
            linked = (x != y) & (np.bitwise_count(fps[x] ^ fps[y]) <= distance)
            forest.link(x[linked], y[linked])
    return forest.label


def _link_batch(mask: np.ndarray, pattern: np.ndarray, fps: np.ndarray, distance: int):
    """Links of whole nodes that follow each other: pairs of fingerprints."""
    fresh = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])])
    sizes = np.diff(np.r_[fresh, len(fps)])
    node = np.repeat(np.arange(len(fresh)), sizes)
    small = np.repeat(sizes <= LEAF, sizes)
    lefts, rights = [], []
    for gap in range(1, min(LEAF, int(sizes.max(initial=0)))):  # nodes of one leaf: member by member
        near = (node[gap:] == node[:-gap]) & small[gap:] & (np.bitwise_count(fps[gap:] ^ fps[:-gap]) <= distance)
        lefts.append(fps[:-gap][near])
        rights.append(fps[gap:][near])
    for at, size in zip(fresh[sizes > LEAF], sizes[sizes > LEAF], strict=True):
        members = fps[at : at + size]
        label = link_node(members, distance)
        other = np.flatnonzero(label != np.arange(size))
        lefts.append(members[label[other]])
        rights.append(members[other])
    if not lefts:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(lefts), np.concatenate(rights)


def index_nodes(distinct: DataFrame, limit: int = NODE_LIMIT) -> DataFrame:
    """``mask, pattern, fp``: each distinct fingerprint in every upper node it belongs to."""
    fp, masks = F.col("fp"), TOP_MASKS

    def enter(df: DataFrame, into: Column) -> DataFrame:
        held = df.select("fp", F.explode(into).alias("mask"))
        return held.select("mask", F.col("mask").bitwiseAND(fp).alias("pattern"), "fp")

    entered = enter(distinct, F.array(*[F.lit(_signed(m)) for m in masks]))
    settled = None
    while True:
        crowded = entered.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
        if min(64 - m.bit_count() for m in masks) < max(3, limit.bit_length()) or crowded.isEmpty():
            return entered if settled is None else settled.unionByName(entered)
        crowded = park(crowded.drop("n"), "crowded-nodes")
        calm = entered.join(crowded, ["mask", "pattern"], "left_anti")
        settled = calm if settled is None else settled.unionByName(calm)
        split = F.create_map(*[
            x for m in masks for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(f)) for f in finer(m)]))
        ])
        entered = enter(entered.join(crowded, ["mask", "pattern"]), split[F.col("mask")])
        entered, masks = park(entered, "finer-nodes"), sorted({f for m in masks for f in finer(m)})


def close_links(distinct: DataFrame, distance: int, limit: int = NODE_LIMIT) -> DataFrame:
    """``a, b``: links that join all of ``distinct`` column ``fp`` within ``distance`` (2 at most)."""
    if not 0 <= distance <= 2:
        raise ValueError("the upper nodes hold distances of 0, 1 and 2 bits")
    nodes = index_nodes(distinct, limit).repartition("mask", "pattern")
    nodes = nodes.sortWithinPartitions("mask", "pattern", gray_rank(F.col("fp")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3
        for batch in (*batches, None):
            if batch is not None:
                held = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns, strict=True)]
                if not len(held[0]):
                    continue
                last = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
                stop = int(np.argmax(last))  # where the last node, maybe not whole yet, begins
            else:
                stop = len(held[0])
            if stop:
                mask, pattern, fps = (h[:stop] for h in held)
                left, right = _link_batch(mask, pattern, fps.view(np.uint64), distance)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(left.view(np.int64)), pa.array(right.view(np.int64))], names=["a", "b"]
                )
                held = [h[stop:] for h in held]

    return nodes.mapInArrow(run, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node that a link ``a, b`` names; the root is the least node.

    Alternates the large star (neighbours above a node move to its least neighbour) and the small
    star (those below it do) until the links stay as they are.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs, before = park(pairs, "links"), None
    while True:
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = park(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
    roots = pairs.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _classes(docs: DataFrame, distance: int, limit: int) -> DataFrame:
    """``fp, root, component_id`` of every distinct fingerprint of ``doc_id, fp``; written once."""
    distinct = docs.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(close_links(distinct.select("fp"), distance, limit)).withColumnRenamed("node", "fp")
    joined = found.join(distinct, "fp")
    lowest = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = found.join(lowest, "root").select("fp", "root", "component_id")
    return park(distinct.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "least").alias("component_id")
    ), "near-classes")


def near_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, distance: int = 2,
    limit: int = NODE_LIMIT,
) -> DataFrame:
    """``doc_id, fingerprint (16 hex digits), component_id`` of every row."""
    docs = park(fingerprints(df, id_col, text_col, size), "fingerprints")
    return spread_join(docs, _classes(docs, distance, limit), ["fp"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, distance: int = 2
) -> DataFrame:
    """One row of each component, with all its columns: that of the least id, null ids counting as the
    largest; of several texts with that id the one of least digest, of equal rows any one.

    A row is told from others by its id and text together, so no text goes because another one shares
    its id. Rows alone in their component, and all others' whole texts, do not shuffle while the keys
    to remove fit a broadcast.
    """
    name = F.concat(F.coalesce(quoted(id_col).cast("string"), F.lit("none")), F.lit(":"), F.coalesce(quoted(text_col), F.lit("")))
    keyed = df.select(
        quoted(id_col).alias("doc_id"), quoted(text_col).alias("text"), F.sha2(name, 256).alias("key"),
        F.struct(*[quoted(c) for c in df.columns]).alias("row"),
    )
    docs = park(fingerprints(keyed, size=size, keep=("key",)), "fingerprints")
    rooted = spread_join(docs, _classes(docs, distance, NODE_LIMIT).select("fp", "root"), ["fp"]).drop("fp")
    several = rooted.groupBy("root").agg(F.count(F.lit(1)).alias("_n"), F.min("doc_id").alias("_least")).where("_n > 1")
    contested = park(spread_join(rooted, park(several, "several"), ["root"]), "contested")
    firsts = contested.where(F.col("doc_id").eqNullSafe(F.col("_least"))).groupBy("root").agg(F.min("key").alias("_first"))
    judged = spread_join(contested.select("root", "key"), park(firsts, "firsts"), ["root"])
    gone = park(judged.where("key <> _first").select("key").distinct(), "near-copies")
    repeated = judged.where("key = _first").groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    repeated = park(repeated.select("key"), "repeated-rows")
    left = spread_join(keyed.select("key", "row"), gone, ["key"], "left_anti")
    if repeated.isEmpty():
        return left.select("row.*")
    once = spread_join(left, repeated, ["key"], "left_semi").groupBy("key").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return spread_join(left, repeated, ["key"], "left_anti").select("row").unionByName(once.select("row")).select("row.*")
