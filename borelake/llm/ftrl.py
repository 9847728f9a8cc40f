"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its words and their beginnings, its 2- and 3-grams and
its pairs with one word between. Each coordinate has a learning rate of its own, and an L1 penalty
keeps the weights of uninformative features at exactly zero. A bounded sample of labelled rows is
learned; the model is at most ``2**BITS`` floats (4 MB), broadcast.

Defined results: a null or empty text scores by the bias alone; equal texts score alike; repeated
rows and ids, and null ids (never held out), give a row each; other columns are ignored; without any
usable label every score is 0.5; an empty table gives no rows.
"""

from __future__ import annotations

import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import park
from .common import by_slice, fold, labelled_sample, texts

BITS = 20
# Labelled documents learned from, at most; letters of a word's beginnings that are features, too.
SAMPLE_DOCS, EPOCHS = 12_000, 3
ALPHA, BETA, L1, L2 = 3.0, 1.0, 3.0, 1.0
STEMS = (4, 5)
FOLDS, HELD = 3, 1
THRESHOLD = 0.7
# Distinct words a task remembers the hash of before it starts afresh.
MEMO_SIZE = 1 << 18

_WORD = re.compile(r"\w+")
_SHIFT = np.uint64(64 - BITS)
# Odd multipliers that tell the places of a gram apart.
_PLACES = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class WordHashes(dict):
    """Word to its row in a table of hashes: of the word, and of its first four and five letters."""

    def __init__(self):
        super().__init__()
        self.values = array("Q")

    def __missing__(self, word: str) -> int:
        row = self[word] = len(self)
        starts = (xxhash.xxh64_intdigest(word[:n], n) if len(word) > n else 0 for n in STEMS)
        self.values.extend((xxhash.xxh64_intdigest(word), *starts))
        return row

    def table(self) -> np.ndarray:
        return np.array(self.values, np.uint64).reshape(-1, 1 + len(STEMS))


def features(docs: list[str], memo: WordHashes, active: np.ndarray | None = None) -> list[np.ndarray]:
    """The distinct feature numbers of each text; 0 is the bias, which every text has.

    ``active``, one flag per feature number, leaves out features that are not asked for.
    """
    if len(memo) > MEMO_SIZE:
        memo.clear()
        memo.values = array("Q")
    rows = [list(map(memo.__getitem__, _WORD.findall(text.lower()))) for text in docs]
    place = np.fromiter(chain.from_iterable(rows), np.int64)
    owner = np.repeat(np.arange(len(docs)), [len(r) for r in rows])
    hashes = memo.table()[place]
    h, (a, b, c, d) = hashes[:, 0], _PLACES
    found = []

    def keep(grams: np.ndarray, whole: np.ndarray, owners: np.ndarray) -> None:
        at = (grams >> _SHIFT).astype(np.int64)
        kept = whole & (at > 0)
        if active is not None:
            kept &= active[at]
        found.append(owners[kept] << BITS | at[kept])

    keep(h * a, np.ones(len(h), bool), owner)
    for column in range(1, 1 + len(STEMS)):
        keep(hashes[:, column] * _PLACES[column], hashes[:, column] > 0, owner)
    keep(h[:-1] * b + h[1:] * a, owner[1:] == owner[:-1], owner[1:])
    same = owner[2:] == owner[:-2]
    keep(h[:-2] * c + h[1:-1] * b + h[2:] * a, same, owner[2:])
    keep(h[:-2] * d + h[2:] * a, same, owner[2:])
    found.append(np.arange(len(docs)) << BITS)
    marked = np.unique(np.concatenate(found))
    cuts = np.searchsorted(marked, np.arange(1, len(docs)) << BITS)
    return [(x & ((1 << BITS) - 1)).astype(np.int32) for x in np.split(marked, cuts)]


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def learn(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> np.ndarray:
    """FTRL-proximal weights after passes over (features, label) in the given order."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bound = np.full(1 << BITS, L1)
    bound[0] = 0.0

    def weights(at) -> np.ndarray:
        shrunk = z[at] - np.sign(z[at]) * np.minimum(np.abs(z[at]), bound[at])
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(epochs):
        for at, label in rows:
            w = weights(at)
            g = _sigmoid(w.sum()) - label
            rate = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - rate * w
            n[at] += g * g
    return weights(slice(None))


def train(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """The weights, one per feature number; all zero without a labelled document.

    The sample is bounded, so one task learns it, in the order of its ids' hashes.
    """
    sample = labelled_sample(docs, labels, "toxic", FOLDS, HELD, SAMPLE_DOCS)

    def make():
        memo = WordHashes()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, whole, marks = (c.to_pylist() for c in batch.columns)
            found = [f.tobytes() for f in features(whole, memo)]
            order = [xxhash.xxh64_intdigest(str(i)) >> 1 for i in ids]
            return pa.RecordBatch.from_arrays(
                [pa.array(order, pa.int64()), pa.array(found, pa.binary()), pa.array(marks, pa.int32())],
                names=["place", "found", "label"],
            )

        return work

    schema = "place bigint, found binary, label int"
    drawn = park(by_slice(sample.select("doc_id", "text", "label"), make, schema), "toxic-sample")

    def weights_of(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        found = [np.frombuffer(b, np.int32) for b in rows.column("found").to_pylist()]
        w = learn(list(zip(found, rows.column("label").to_pylist(), strict=True)))
        at = np.flatnonzero(w)
        return pa.table({"feature": pa.array(at, pa.int32()), "weight": pa.array(w[at], pa.float64())})

    found = drawn.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(weights_of, "feature int, weight double").toArrow()
    model = np.zeros(1 << BITS, np.float32)
    model[found.column("feature").to_numpy()] = found.column("weight").to_numpy()
    return model


def score(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, by a model of the rows not held out."""
    docs = texts(df, id_col, text_col)
    model = df.sparkSession.sparkContext.broadcast(train(docs, labels))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def make():
        weights, memo = model.value, WordHashes()
        active = weights != 0

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [
                _sigmoid(float(weights[f].sum())) for f in features(batch.column(1).to_pylist(), memo, active)
            ]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

        return work

    return by_slice(docs, make, f"doc_id {id_type}, score double").select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
