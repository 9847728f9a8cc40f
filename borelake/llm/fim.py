"""Fill-in-middle transformation by secondary-sort assembly.

A text is cut at two of its line ends into prefix, middle and suffix, chosen by a hash of its id.
Nobody ever holds a whole output text:

1. Each row is cut into pieces of at most ``PIECE_BYTES``, keyed by the row and their place in the
   *output* (psm: prefix, suffix, middle; spm: suffix, prefix, middle), each segment led by its mark.
2. One exchange on the row key, sorted by key and place within partitions (the DataFrame form of
   ``repartitionAndSortWithinPartitions``), streams the pieces of a row, in order, into a digest.
3. The restorer reads that same stream: it finds the marks in it, so it knows where each segment of
   the source lies, and names every piece by its place in the *source*. Sorting the same partitions
   again, without another exchange, streams the source text into a second digest.

A row's key is the number of its input partition and a 128-bit digest of its id and text. Equal rows
of one partition so share a key and travel as repeats of the same pieces, of which the first counts:
a third of all rows may be one row without filling a task, and a recomputed task sends the same keys
in whatever order its rows come. A text of any length is streamed; a mapper holds one text at a time.

Defined results: a null text is empty, an empty one plain; a null id hashes as an empty string;
repeated rows give a row each; equal texts of different ids are cut apart from each other; other
columns are ignored by ``fim_digests`` and carried by ``fim_texts``; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import quoted
from .common import slices, texts

# Bytes of text that a piece holds, at most.
PIECE_BYTES = 1 << 16
# What leads each segment in an output, and the segments' order in each form.
PREFIX, MIDDLE, SUFFIX = 0, 1, 2
MARKS = (b"<P>", b"<M>", b"<S>")
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
SEED, RATE, SPM_SHARE = 7, 100, 50

_MARK = re.compile(b"|".join(MARKS))
_SEGMENT = {mark: segment for segment, mark in enumerate(MARKS)}
# Places of one segment lie below the next one's.
_SEGMENT_SPAN = 1 << 40


@dataclass(frozen=True)
class Cut:
    """Where a text is cut: its form, its number of units, and the two byte positions."""

    form: str
    n: int
    first: int
    second: int


def cut_text(doc_id: int | None, data: bytes, seed: int = SEED, rate: int = RATE, spm: int = SPM_SHARE) -> Cut:
    """The cut of a text given as UTF-8; ``rate`` and ``spm`` are hundredths."""
    named = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    h1, h2, h3, h4 = struct.unpack(">4I", hashlib.sha256(named).digest()[:16])
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    if len(data) and (not len(ends) or ends[-1] != len(data)):
        ends = np.append(ends, len(data))
    n = len(ends)
    if not n or h3 % 100 >= rate or _MARK.search(data):
        return Cut("plain", n, 0, 0)
    units = sorted((h1 % (n + 1), h2 % (n + 1)))
    first, second = (int(ends[u - 1]) if u else 0 for u in units)
    return Cut("spm" if h4 % 100 < spm else "psm", n, first, second)


def chars(data: bytes) -> int:
    """Code points of valid UTF-8."""
    return int(np.count_nonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80))


def output_pieces(data: bytes, cut: Cut, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """The output text in pieces; at least one, which may be empty."""
    if cut.form == "plain":
        yield data[:size]
        for at in range(size, len(data), size):
            yield data[at : at + size]
        return
    bounds = {PREFIX: (0, cut.first), MIDDLE: (cut.first, cut.second), SUFFIX: (cut.second, len(data))}
    for segment in ORDERS[cut.form]:
        start, stop = bounds[segment]
        yield MARKS[segment] + data[start : min(stop, start + size)]
        for at in range(start + size, stop, size):
            yield data[at : min(stop, at + size)]


class Reader:
    """Reads an output stream back: which segment each of its bytes belongs to."""

    def __init__(self, form: str):
        self.plain, self.segment, self.held, self.sent = form == "plain", PREFIX, b"", 0

    def feed(self, piece: bytes, last: bool = False) -> Iterator[tuple[int, bytes]]:
        """Places in the source, ascending within a segment, and the bytes that belong there."""
        if self.plain:
            yield self._placed(piece)
            return
        data, at = self.held + piece, 0
        for mark in _MARK.finditer(data):
            if mark.start() > at:
                yield self._placed(data[at : mark.start()])
            self.segment, at = _SEGMENT[mark[0]], mark.end()
        # A mark may begin at the end of this piece and go on in the next one.
        rest = len(data) if last else max(at, len(data) - 2)
        if rest > at:
            yield self._placed(data[at:rest])
        self.held = data[rest:]

    def _placed(self, data: bytes) -> tuple[int, bytes]:
        self.sent += 1
        return self.segment * _SEGMENT_SPAN + self.sent, data


def restore(output: str, form: str) -> str:
    """The source text of one output."""
    found = sorted(Reader(form).feed(output.encode("utf-8", "surrogatepass"), last=True))
    return b"".join(data for _, data in found).decode("utf-8", "surrogatepass")


def transform(doc_id: int | None, text: str | None, seed: int = SEED, rate: int = RATE, spm: int = SPM_SHARE) -> tuple[str, str]:
    """The form and the output text of one text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    cut = cut_text(doc_id, data, seed, rate, spm)
    return cut.form, b"".join(output_pieces(data, cut)).decode("utf-8", "surrogatepass")


_PIECES = "key binary, place bigint, data binary, doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint"
_PIECES_ARROW = pa.schema([
    ("key", pa.binary()), ("place", pa.int64()), ("data", pa.binary()), ("doc_id", pa.int64()), ("n", pa.int64()),
    ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
])
_NO_FACTS = (None,) * 5


def _batches(rows: Iterable[tuple], schema: pa.Schema, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about ``most`` bytes; the third field of a row is its bytes."""
    held, size = [], 0

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        size += 128 + len(row[2])
        if size >= most:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE, spm: int = SPM_SHARE) -> DataFrame:
    """The output of every row in pieces: ``key, place, data``, and at place 0 what is known of the row."""
    docs = texts(df, id_col, text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary"))

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        part = struct.pack(">I", TaskContext.get().partitionId())
        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = text.as_py()
                key = hashlib.blake2b(data, digest_size=16, key=repr(doc_id).encode()).digest()
                cut = cut_text(doc_id, data, seed, rate, spm)
                counted = cut.form != "plain"
                facts = (
                    doc_id, cut.n, cut.form, chars(data[: cut.first]) if counted else None,
                    chars(data[cut.first : cut.second]) if counted else None,
                )
                for place, piece in enumerate(output_pieces(data, cut)):
                    yield part + key, place, piece, *(facts if place == 0 else _NO_FACTS)

    return docs.mapInArrow(lambda batches: _batches(cut_up(batches), _PIECES_ARROW), _PIECES)


def _ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The distinct pieces of sorted batches, each with the number of its repeats: ``(row, copies)``.

    Equal rows of one input partition sent the same pieces, which are now neighbours. ``copies`` counts
    the repeats seen so far of a row's first piece.
    """
    key = place = None
    copies, waiting = 0, None
    for batch in slices(batches):
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (row[0], row[1]) == (key, place):
                if waiting is not None:
                    copies += 1
                continue
            if waiting is not None:
                yield waiting, copies
                waiting = None
            fresh, (key, place) = row[0] != key, row[:2]
            if fresh:
                waiting, copies = row, 1
            else:
                yield row, copies
    if waiting is not None:
        yield waiting, copies


_READ = "key binary, place bigint, data binary, doc_id bigint, n bigint, form string, prefix_chars bigint, " \
    "middle_chars bigint, output_sha256 string, copies bigint"
_READ_ARROW = pa.schema([*_PIECES_ARROW, ("output_sha256", pa.string()), ("copies", pa.int64())])


def assembled(cut: DataFrame) -> DataFrame:
    """Pieces in output order, streamed into digests and named by their place in the source.

    At place -1 stands what is known of a row, with ``output_sha256`` and the number of equal rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        head = digest = reader = None

        def closing():
            yield from ((head[0], at, data, *_NO_FACTS, None, None) for at, data in reader.feed(b"", last=True))
            yield head[0], -1, b"", *head[3:], digest.hexdigest(), copies

        for row, seen in _ordered(batches):
            if head is None or row[0] != head[0]:
                if head is not None:
                    yield from closing()
                head, digest, reader, copies = row, hashlib.sha256(), Reader(row[5]), seen
            digest.update(row[2])
            yield from ((row[0], at, data, *_NO_FACTS, None, None) for at, data in reader.feed(row[2]))
        if head is not None:
            yield from closing()

    sorted_pieces = cut.repartition("key").sortWithinPartitions("key", "place")
    return sorted_pieces.mapInArrow(lambda batches: _batches(read(batches), _READ_ARROW), _READ)


_RESULT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string"
_RESULT_ARROW = pa.schema([*list(_READ_ARROW)[3:9], ("restored_sha256", pa.string())])


def restored(read: DataFrame) -> DataFrame:
    """The rows' facts, the digest of the output and that of the text restored from it."""

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, digest, out = None, None, []

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _RESULT_ARROW, strict=True)], schema=_RESULT_ARROW
            )

        for batch in slices(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[1] == -1:
                    if head is not None:
                        out += [(*head[3:9], digest.hexdigest())] * head[9]
                    head, digest = row, hashlib.sha256()
                else:
                    digest.update(row[2])
            if len(out) >= 1 << 10:
                yield flush()
                out = []
        if head is not None:
            out += [(*head[3:9], digest.hexdigest())] * head[9]
        if out:
            yield flush()

    # The pieces of a row still lie in one partition, so a sort of each is enough.
    return read.sortWithinPartitions("key", "place").mapInArrow(finish, _RESULT)


def fim_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE, spm: int = SPM_SHARE) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` of every row."""
    return restored(assembled(pieces(df, id_col, text_col, seed, rate, spm)))


def fim_texts(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE, spm: int = SPM_SHARE,
) -> DataFrame:
    """The output texts themselves: all columns of ``df``, then ``fim_form string, fim_text string``.

    For use as training data; a text must fit a task here, as it does in ``df``. No shuffle.
    """

    @F.pandas_udf("fim_form string, fim_text string")
    def apply(ids, whole):
        import pandas as pd

        made = [transform(i or None, t, seed, rate, spm) for i, t in zip(ids, whole, strict=True)]
        return pd.DataFrame(made, columns=["fim_form", "fim_text"])

    doc_id: Column = F.coalesce(quoted(id_col).cast("string"), F.lit(""))
    made = apply(doc_id, F.coalesce(quoted(text_col), F.lit(""))).alias("_fim")
    columns = [quoted(c) for c in df.columns]
    return df.select(*columns, made).select(*columns, "_fim.fim_form", "_fim.fim_text")
