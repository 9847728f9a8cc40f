"""Document fingerprints from closed syncmers.

A k-mer of code points is kept when the least of its inner s-mers (by hash) stands first or last in
it. That depends on the k-mer alone, so an unchanged passage keeps its anchors whatever is edited
around it. At least one of any ``k - s`` neighbouring k-mers is kept, so passages of ``2k - s - 1``
code points or more always hold an anchor. ``anchors`` gives them all with their positions.

A fingerprint is the ``SKETCH`` least anchor hashes of the whole text, in the order in which they first
occur. Two texts are matched by position: of the anchors common to both, the longest run that both
hold in the same order counts, as a share of all anchors of either.

Defined results: a text with no anchor (shorter than about two k-mers) has one, the hash of the whole
text; a null or empty text has none; two empty fingerprints are alike (1.0), an empty and another one
are not (0.0). Equal texts have equal fingerprints. Repeated rows and ids, and null ids, give a row
each; ids may lie anywhere in the range of their type; other columns, whatever their names, are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import park
from .common import by_slice, slices, texts

K, S = 14, 6
# Anchor hashes a fingerprint holds, each of 32 bits.
SKETCH = 128
# Parts of the id order per shuffle partition, and rows that the driver looks at per part to cut it.
PARTS, LOOKED_AT = 4, 40

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _powers(size: int) -> list[np.uint64]:
    """The base to the powers 1, 2, 4, ... up to ``size``, modulo 2 to the 64th."""
    found, power = [], _BASE
    while 1 << len(found) <= size:
        found.append(power)
        with np.errstate(over="ignore"):
            power = power * power
    return found


def _rolling(codes: np.ndarray, size: int) -> np.ndarray:
    """A polynomial hash of every window of ``size`` code points, joined from doubled windows."""
    powers, level, joined, done = _powers(size), codes, None, 0
    for bit in range(size.bit_length()):
        width = 1 << bit
        if size & width:
            if joined is None:
                joined, done = level, width
            else:
                n = len(codes) - done - width + 1
                joined = joined[:n] * powers[bit] + level[done : done + n]
                done += width
        if 2 * width <= size:
            level = level[: len(level) - width] * powers[bit] + level[width:]
    return joined


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every window of ``width`` values."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[: len(values) - done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def syncmers(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Positions and 64-bit hashes of the closed syncmers of a text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    codes = _mixed(codes + np.uint64(1))
    if len(codes) == 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    if len(codes) >= k:
        inner = _mixed(_rolling(codes, s))
        span = k - s + 1
        least = _least(inner, span)
        kept = np.flatnonzero((inner[: len(least)] == least) | (inner[span - 1 :] == least))
        if len(kept):
            return kept, _mixed(_rolling(codes, k)[kept])
    whole = int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
    return np.zeros(1, np.int64), np.array([whole], np.uint64)


def sketch(hashes: np.ndarray, size: int = SKETCH) -> np.ndarray:
    """The ``size`` least distinct 32-bit hashes, in the order in which they first occur."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    at, take = np.arange(len(short)), 2 * size
    while take < len(short):  # repeats may hide behind equal values, so widen until enough differ
        at = np.flatnonzero(short <= np.partition(short, take)[take])
        if len(np.unique(short[at])) >= size:
            break
        at, take = np.arange(len(short)), take * 4
    least, first = np.unique(short[at], return_index=True)
    return least[:size][np.argsort(first[:size])]


def alike(a: np.ndarray, b: np.ndarray, size: int = SKETCH) -> float:
    """The estimated share of anchors that two texts hold in the same order, 0 to 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:size]
    places = {h: i for i, h in enumerate(b.tolist())}
    last = union[-1]
    tails: list[int] = []  # of increasing runs, by length, the least last place
    for h in a[a <= last].tolist():
        place = places.get(h)
        if place is not None:
            at = bisect_left(tails, place)
            tails[at : at + 1] = [place]
    return len(tails) / len(union)


def _hex(found: np.ndarray) -> str:
    return found.astype(">u4").tobytes().hex()


def anchors(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S) -> DataFrame:
    """``doc_id, positions array<bigint>, hashes array<bigint>``: every anchor of every text."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [syncmers(text, k, s) for text in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p for p, _ in found], pa.list_(pa.int64())),
                 pa.array([h.view(np.int64) for _, h in found], pa.list_(pa.int64()))],
                names=["doc_id", "positions", "hashes"],
            )

        return work

    return by_slice(
        texts(df, id_col, text_col), make, "doc_id bigint, positions array<bigint>, hashes array<bigint>"
    )


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint string, n_anchors bigint`` of every text; no shuffle."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [syncmers(text)[1] for text in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([_hex(sketch(h)) for h in found]),
                 pa.array([len(h) for h in found], pa.int64())],
                names=["doc_id", "fingerprint", "n_anchors"],
            )

        return work

    return by_slice(texts(df, id_col, text_col), make, "doc_id bigint, fingerprint string, n_anchors bigint")


def _place() -> Column:
    """Where a row stands: ids descending, nulls last, equal ids by a hash of the text."""
    doc_id = F.col("doc_id")
    return F.struct(
        doc_id.isNull().cast("int").alias("n"), F.coalesce(F.bitwise_not(doc_id), F.lit(0)).alias("r"), F.xxhash64("text").alias("h")
    )


_PLACES = "array<array<struct<n:int,r:bigint,h:bigint>>>"


def _part(place: Column, cuts: list[tuple[int, int, int]]) -> Column:
    """The number of sorted ``cuts`` that are not beyond a place, found in two steps."""
    width = max(1, round(len(cuts) ** 0.5))
    rows = [cuts[at : at + width] for at in range(0, len(cuts), width)]
    table = F.from_json(F.lit(json.dumps([[dict(zip("nrh", c, strict=True)) for c in row] for row in rows])), _PLACES)

    def within(row: Column) -> Column:
        return F.size(F.filter(row, lambda c: c <= place))

    row = F.size(F.filter(F.transform(table, lambda row: row[0]), lambda c: c <= place))
    return F.when(row == 0, 0).otherwise((row - 1) * width + within(F.get(table, F.greatest(row - 1, F.lit(0)))))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with each row in a part of the descending id order: ``part, extra`` added.

    Places in the order (a hash and an id each) are written first. The driver cuts them into parts of
    about equal rows by a sample of ``LOOKED_AT`` places a part, and one row a part, its first, is sent
    behind the part before it as ``extra``, the very first behind the last. A part so holds every row's
    successor. Rows of one id are split between parts unless their texts are equal, too.
    """
    spark = docs.sparkSession
    placed = docs.withColumn("place", _place())
    places = park(placed.select("place.*"), "places")
    wanted = PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = min(1.0, LOOKED_AT * wanted / max(1, places.count()))
    seen = sorted(tuple(r) for r in (places if share == 1.0 else places.sample(share, seed=1)).collect())
    cuts = sorted({seen[len(seen) * i // wanted] for i in range(1, wanted)}) if seen else []
    part = _part(F.col("place"), cuts).alias("part")
    firsts = places.select(F.struct("n", "r", "h").alias("place")).select("place", part).groupBy("part").agg(F.min("place").alias("place"))
    heads = sorted((r["part"], tuple(r["place"])) for r in firsts.collect())
    behind = spark.createDataFrame(
        [(heads[i - 1][0], *place) for i, (_, place) in enumerate(heads)], "part int, n int, r bigint, h bigint"
    ).select("part", F.struct("n", "r", "h").alias("place"))
    extra = placed.join(F.broadcast(behind), "place").groupBy("part", "doc_id", "place").agg(F.min("text").alias("text"))
    rows = placed.select("doc_id", "text", "place", part, F.lit(False).alias("extra"))
    sent = rows.unionByName(extra.select("doc_id", "text", "place", "part", F.lit(True).alias("extra")))
    return sent.repartition("part").sortWithinPartitions("part", "extra", "place", "text")


EDITED = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
    "near_edited double, near_next double, n_anchors bigint"


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of the text whose second half the next document replaces.

    The last ``floor(n_chars / 2)`` code points give way to the first as many of the next document
    in descending id order (after the last: the first), equal ids being ordered by a hash of their text.
    One row per row. Texts shuffle once, by ranges of ids. A table of one row is its own successor.
    """
    docs = texts(df, id_col, text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in EDITED.split(", ")]
        last = None  # part, doc_id, text, sketch, anchors of the row that waits for its successor
        for batch in slices(batches):
            out: list[tuple] = []
            ids, whole, parts, extras = (batch.column(i).to_pylist() for i in range(4))
            for doc_id, text, part, extra in zip(ids, whole, parts, extras, strict=True):
                if extra and last is None:
                    continue
                hashes = syncmers(text)[1]
                found = sketch(hashes)
                if last is not None:
                    out.append(_edited(*last[1:], text, found))
                last = None if extra else (part, doc_id, text, found, len(hashes))
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=_ARROW)

    return with_next(docs).select("doc_id", "text", "part", "extra").mapInArrow(run, EDITED)


def _edited(doc_id, text: str, found: np.ndarray, count: int, following: str, next_found: np.ndarray) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    again = sketch(syncmers(edited)[1])
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return (doc_id, len(text), digest, _hex(found), _hex(again), alike(found, again), alike(found, next_found), count)


_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ("n_anchors", pa.int64()),
])
