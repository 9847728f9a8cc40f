"""Byte-level BPE encoding and decoding with a given rank file.

Two tiers. A minimal perfect hash (hash and displace) answers in one probe whether a whole
pre-token is in the vocabulary. A pre-token that is not is merged by rank with a heap over linked
byte spans, in O(n log n) for any length. What a task has encoded it remembers, up to a bound.

The rank file (under a megabyte) is read once on the driver, which also builds the perfect hash; both
are broadcast, and documents never shuffle. ``encode_checked`` encodes, decodes and compares in one
pass, so that neither a text nor its decoded bytes travel back.

Defined results: a null or empty text has no ids; repeated rows and ids, and null ids, are encoded
row by row; further columns are dropped unless named in ``keep``; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
from array import array
from collections.abc import Sequence
from functools import lru_cache

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import quoted
from .common import by_slice

# Pre-tokens a task remembers, of at most so many characters (about 60 MB); the half not met lately goes.
MEMO_SIZE, MEMO_CHARS = 1 << 18, 32
_KEYS_PER_BUCKET = 4
_EMPTY = -1


class PerfectHash:
    """A minimal perfect hash over byte strings: as many slots as keys, one probe a lookup."""

    def __init__(self, keys: Sequence[bytes], built: tuple[bytes, bytes] | None = None):
        """``keys``: distinct; the slot of a key holds its index in ``keys``.

        ``built``: the tables of an equal one, as ``tables`` gives them.
        """
        self.n = len(keys)
        self.buckets = max(1, -(-self.n // _KEYS_PER_BUCKET))
        self.keys = list(keys)
        self.shift, self.slots = array("q"), array("q")
        if built:
            self.shift.frombytes(built[0])
            self.slots.frombytes(built[1])
        else:
            self._build()

    @property
    def tables(self) -> tuple[bytes, bytes]:
        return self.shift.tobytes(), self.slots.tobytes()

    def _build(self) -> None:
        self.shift.extend([0] * self.buckets)
        self.slots.extend([_EMPTY] * self.n)
        groups: list[list[tuple[int, int, int]]] = [[] for _ in range(self.buckets)]
        for index, key in enumerate(self.keys):
            bucket, base, step = self._hashes(key)
            groups[bucket].append((base, step, index))
        free = self.n - 1
        for bucket in sorted(range(self.buckets), key=lambda b: -len(groups[b])):
            members = groups[bucket]
            if len(members) == 1:  # any free slot will do: it is named by a negative shift
                while self.slots[free] != _EMPTY:
                    free -= 1
                self.slots[free] = members[0][2]
                self.shift[bucket] = -free - 1
            elif members:
                self._settle(bucket, members)

    def _hashes(self, key: bytes) -> tuple[int, int, int]:
        h = xxhash.xxh3_64_intdigest(key)
        return h % self.buckets, (h >> 20) % self.n, 1 + (h >> 41) % max(1, self.n - 1)

    def _settle(self, bucket: int, members: list[tuple[int, int, int]]) -> None:
        for shift in range(self.n * 64):
            turn = shift // self.n
            places = {(base + shift * step + turn) % self.n for base, step, _ in members}
            if len(places) == len(members) and all(self.slots[p] == _EMPTY for p in places):
                self.shift[bucket] = shift
                for base, step, index in members:
                    self.slots[(base + shift * step + turn) % self.n] = index
                return
        raise ValueError("keys collide in every hash: are they distinct?")

    def get(self, key: bytes) -> int:
        """The key's index, or -1."""
        if not self.n:
            return _EMPTY
        bucket, base, step = self._hashes(key)
        shift = self.shift[bucket]
        slot = -shift - 1 if shift < 0 else (base + shift * step + shift // self.n) % self.n
        index = self.slots[slot]
        return index if index != _EMPTY and self.keys[index] == key else _EMPTY


def merge_spans(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a pre-token outside the vocabulary: lowest rank first, then leftmost."""
    size = len(piece)
    end = list(range(1, size + 1))  # of the span that starts here; 0 once it is part of another
    before = list(range(-1, size - 1))
    heap = [
        (rank, at, at + 2) for at in range(size - 1) if (rank := ranks.get(piece[at : at + 2])) is not None
    ]
    heapq.heapify(heap)
    while heap:
        _, left, stop = heapq.heappop(heap)
        right = end[left]
        if not right or right >= size or end[right] != stop:
            continue
        end[left], end[right] = stop, 0
        if stop < size:
            before[stop] = left
            if (rank := ranks.get(piece[left : end[stop]])) is not None:
                heapq.heappush(heap, (rank, left, end[stop]))
        if (first := before[left]) >= 0 and (rank := ranks.get(piece[first:stop])) is not None:
            heapq.heappush(heap, (rank, first, stop))
    ids, at = [], 0
    while at < size:
        ids.append(ranks[piece[at : end[at]]])
        at = end[at]
    return ids


def _pairs(lines: bytes) -> dict[bytes, int]:
    """Token to rank."""
    pairs = (line.split() for line in lines.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Decoder:
    """Ids to bytes: a list of tokens by rank, no more."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def decode(self, ids: bytes) -> bytes:
        """The bytes that little-endian unsigned 32-bit ids stand for; ``KeyError`` for an unknown id."""
        numbers = memoryview(ids).cast("I").tolist()
        try:
            return b"".join(map(self.tokens.__getitem__, numbers))
        except (IndexError, TypeError):
            strange = next(n for n in numbers if n >= len(self.tokens) or self.tokens[n] is None)
            raise KeyError(strange) from None


class Encoder(dict):
    """Pre-token to its ids as little-endian unsigned 32-bit bytes; works out what it lacks."""

    def __init__(self, lines: bytes, pattern: str, built: tuple[bytes, bytes] | None = None):
        super().__init__()
        self.ranks = _pairs(lines)
        self.vocabulary = PerfectHash(list(self.ranks), built)
        self.rank_of = array("I", self.ranks.values())
        self.decoder = Decoder(self.ranks)
        self.tokens = self.decoder.tokens
        self.split = regex.compile(pattern).findall
        self.older: dict[str, bytes] = {}

    def __missing__(self, token: str) -> bytes:
        ids = self.older.get(token) or self._ids(token.encode())
        if len(token) <= MEMO_CHARS:
            if len(self) >= MEMO_SIZE // 2:
                self.older = dict(self)
                self.clear()
            self[token] = ids
        return ids

    def _ids(self, piece: bytes) -> bytes:
        index = self.vocabulary.get(piece)
        if index != _EMPTY:
            return struct.pack("<I", self.rank_of[index])
        merged = merge_spans(piece, self.ranks)
        return struct.pack(f"<{len(merged)}I", *merged)

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return self.decoder.decode(ids)


@lru_cache(maxsize=2)
def _built(lines: bytes) -> tuple[bytes, bytes]:
    return PerfectHash(list(_pairs(lines))).tables


@lru_cache(maxsize=2)
def _encoder(lines: bytes, pattern: str, built: tuple[bytes, bytes]) -> Encoder:
    return Encoder(lines, pattern, built)


@lru_cache(maxsize=2)
def _decoder(lines: bytes) -> Decoder:
    return Decoder(_pairs(lines))


def _lines(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _kept(df: DataFrame, keep: Sequence[str], value: Column) -> DataFrame:
    return df.select(*[quoted(c) for c in keep], value.alias("_value"))


def encode_checked(
    df: DataFrame, path: str, pattern: str, text_col: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """``keep`` columns and ``n_tokens long, ids binary, decoded_sha256 string, round_trip boolean`` per row.

    The ids are decoded where they were made: ``decoded_sha256`` is of the bytes they stand for, and
    ``round_trip`` tells whether those are the text's.
    """
    lines = _lines(path)
    shared = df.sparkSession.sparkContext.broadcast((lines, _built(lines)))
    source = _kept(df, keep, F.coalesce(quoted(text_col), F.lit("")))
    schema = source.drop("_value").schema
    for name, kind in (("n_tokens", "long"), ("ids", "binary"), ("decoded_sha256", "string"), ("round_trip", "boolean")):
        schema = schema.add(name, kind)

    def make():
        lines, built = shared.value
        encoder = _encoder(lines, pattern, built)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found, digests, same = [], [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                ids = encoder.encode(text)
                back = encoder.decode(ids)
                found.append(ids)
                digests.append(hashlib.sha256(back).hexdigest())
                same.append(back == text.encode())
            columns = [*batch.columns[:-1], pa.array([len(x) // 4 for x in found], pa.int64()), pa.array(found, pa.binary()),
                       pa.array(digests, pa.string()), pa.array(same, pa.bool_())]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        return work

    return by_slice(source, make, schema)


def encode_texts(
    df: DataFrame, path: str, pattern: str, text_col: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """``keep`` columns and ``n_tokens long, ids binary`` (little-endian unsigned 32-bit) per row.

    ``path``: a rank file of base64 tokens, readable by the driver; ``pattern``: the expression
    whose matches are encoded one by one. No text is an added or special token.
    """
    lines = _lines(path)
    shared = df.sparkSession.sparkContext.broadcast((lines, _built(lines)))
    source = _kept(df, keep, F.coalesce(quoted(text_col), F.lit("")))
    schema = source.drop("_value").schema.add("n_tokens", "long").add("ids", "binary")

    def make():
        lines, built = shared.value
        encoder = _encoder(lines, pattern, built)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [encoder.encode(text) for text in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [*batch.columns[:-1], pa.array([len(x) // 4 for x in ids], pa.int64()),
                       pa.array(ids, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        return work

    return by_slice(source, make, schema)


def decode_ids(df: DataFrame, path: str, ids_col: str = "ids", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``decoded binary``: the bytes that the ids of each row stand for.

    Null ids give no bytes; an id that the file lacks raises ``KeyError``.
    """
    shared = df.sparkSession.sparkContext.broadcast(_lines(path))
    source = _kept(df, keep, F.coalesce(quoted(ids_col), F.lit(b"")))
    schema = source.drop("_value").schema.add("decoded", "binary")

    def make():
        decoder = _decoder(shared.value)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = [decoder.decode(ids) for ids in batch.column(batch.num_columns - 1).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(out, pa.binary())], names=schema.names
            )

        return work

    return by_slice(source, make, schema)
