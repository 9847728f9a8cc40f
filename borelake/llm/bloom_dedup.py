"""Exact dedup in two passes of a Bloom filter, by DataFrame functions alone.

Texts are equal when identical after every run of ASCII white space is one space; their SHA-256
stands for them. Pass one sets, for each row, one position in each of two filter slices, and keeps
the positions that were set twice or more as bitmaps of 32,768 bits. Pass two tests every row: where
a slice has no such bit the text is surely alone, and the row goes straight through. Only the others
shuffle, on the digest, with partial aggregation and adaptive skew splitting against large groups.

The bitmaps hold 16 bits a row, up to ``MAX_BITS`` in all (32 MB), so their broadcast has a
fixed bound. Beyond it more lone rows shuffle; the result is the same.

Defined results: a null text is empty; of equal texts the smallest id stays, null ids counting as
the largest; of repeated rows with that id exactly one stays; extra columns are carried by
``deduplicate`` and ignored by ``duplicate_groups``; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import park
from ..functions.coerce import quoted
from .common import texts

MAX_BITS = 1 << 28
_BLOCK = 1 << 15  # fixed value: bits of one bitmap of bitmap_construct_agg
_SLICES = 2


def digest(text: Column) -> Column:
    """SHA-256, in hex, of the text with single spaces."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "), 256)


def _position(sha: Column, piece: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(sha, F.lit(piece)), F.lit(bits)) + F.lit(piece * bits)


def repeated_bits(signed: DataFrame) -> tuple[DataFrame, int]:
    """Pass one over a column ``text_sha256``: bitmaps of positions set twice, bits of a slice."""
    bits = _BLOCK
    wanted = min(16 * signed.count(), MAX_BITS) // _SLICES
    while bits < wanted:
        bits *= 2
    sha = F.col("text_sha256")
    places = signed.select(F.explode(F.array(*[_position(sha, i, bits) for i in range(_SLICES)])).alias("at"))
    twice = places.groupBy("at").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    block = F.floor(F.col("at") / F.lit(_BLOCK)).cast("int")
    maps = twice.groupBy(block.alias("block")).agg(
        F.bitmap_construct_agg(F.pmod("at", F.lit(_BLOCK))).alias("bitmap")
    )
    return park(maps, "bloom"), bits


def maybe_repeated(signed: DataFrame, maps: DataFrame, bits: int) -> DataFrame:
    """Pass two: ``signed`` with ``_maybe``, false only where the digest occurs once."""
    maybe = F.lit(True)
    for i in range(_SLICES):
        at = _position(F.col("text_sha256"), i, bits)
        side = F.broadcast(maps.withColumnsRenamed({"block": f"_block{i}", "bitmap": f"_bitmap{i}"}))
        signed = signed.join(side, F.floor(at / F.lit(_BLOCK)).cast("int") == F.col(f"_block{i}"), "left")
        inside = F.pmod(at, F.lit(_BLOCK)).cast("int")
        byte = F.conv(F.hex(F.substring(F.col(f"_bitmap{i}"), F.floor(inside / 8).cast("int") + 1, F.lit(1))), 16, 10)
        bit = F.getbit(byte.cast("int"), F.pmod(inside, F.lit(8)))
        maybe = maybe & (F.coalesce(bit, F.lit(0)) == 1)
    return signed.withColumn("_maybe", maybe).drop(*[f"_{w}{i}" for w in ("block", "bitmap") for i in range(_SLICES)])


def duplicate_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row, dropped ones too."""
    signed = park(texts(df, id_col, text_col).select("doc_id", digest(F.col("text")).alias("text_sha256")), "digests")
    maps, bits = repeated_bits(signed)
    tested = maybe_repeated(signed, maps, bits)
    alone = tested.where(~F.col("_maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    counted = tested.where("_maybe").groupBy("text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    groups = counted.groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
    several = counted.join(groups, "text_sha256").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    return alone.unionByName(several.select(
        "doc_id", "keep_id", "group_size",
        ((F.col("copy") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "text_sha256",
    ))


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; rows that are surely alone do not shuffle."""
    packed = df.select(
        F.struct(*[quoted(c) for c in df.columns]).alias("row"), digest(quoted(text_col)).alias("text_sha256")
    )
    maps, bits = repeated_bits(packed.select("text_sha256"))
    tested = maybe_repeated(packed, maps, bits)
    doc_id, text = F.col("row")[id_col], F.col("row")[text_col]
    firsts = tested.where("_maybe").groupBy("text_sha256").agg(
        F.min_by("row", F.struct(doc_id.isNull(), doc_id, text)).alias("row")
    )
    return tested.where(~F.col("_maybe")).select("row").unionByName(firsts.select("row")).select("row.*")
