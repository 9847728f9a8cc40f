"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own features and those of the lines before and after it,
and from the labels of its neighbours. Forward-backward gives each line's probability of being good;
their mean, weighted by line length, is the document's score. The field is learned from documents
whose lines all carry the document's label: shards of a bounded sample are fitted in parallel and
the few dozen parameters averaged and broadcast.

Defined results: a null or empty text is one empty line; equal texts score alike; repeated rows and
ids, and null ids (never held out), give a row each; other columns are ignored; without any usable
label every score is 0.5; an empty table gives no rows.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import park
from .common import by_slice, fold, labelled_sample, texts

# Labelled documents learned from, at most, and the shards they are dealt to.
SAMPLE_DOCS, SHARDS = 8_000, 4
STEPS, RATE, DECAY = 150, 0.1, 1e-4
FOLDS, HELD = 5, 0
THRESHOLD = 0.3
GRAM = 4  # words of the grams whose repeats are counted

# Character classes: letters without upper case, upper case, digits, white space, sentence marks,
# exclamation marks, bars, all else.
_LOWER, _UPPER, _DIGIT, _SPACE, _MARK, _SHOUT, _BAR, _OTHER = range(8)
_SENTENCE = ".,;:?'\"()-–’¿¡«»"


def _class(char: str) -> int:
    if char == "!":
        return _SHOUT
    if char == "|":
        return _BAR
    if char in _SENTENCE:
        return _MARK
    if char.isspace():
        return _SPACE
    if char.isdigit():
        return _DIGIT
    if char.isalpha():
        return _UPPER if char.isupper() else _LOWER
    return _OTHER


_CLASSES = np.array([_class(chr(c)) if not 0xD800 <= c < 0xE000 else _OTHER for c in range(1 << 16)], np.uint8)
OWN = 19


def line_features(docs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line of all documents, line lengths, and lines per document."""
    big = "\n".join(docs)
    counts = np.array([text.count("\n") + 1 for text in docs])
    codes = np.frombuffer((big + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _CLASSES[np.minimum(codes, 0xFFFF)]
    ends = np.flatnonzero(codes == 10)
    starts = np.r_[0, ends[:-1] + 1]
    length = (ends - starts).astype(np.float64)
    share = np.empty((len(starts), 8))
    for kind in range(8):
        share[:, kind] = np.add.reduceat(kinds == kind, starts, dtype=np.int32)
    share[:, _SPACE] -= 1  # the line end
    letters = share[:, _LOWER] + share[:, _UPPER]
    size = np.maximum(length, 1)
    own = np.zeros((len(starts), OWN))
    own[:, 0] = 1
    own[:, 1:8] = np.sqrt(share[:, 1:] / size[:, None])  # a few marks tell more than their share
    own[:, 8] = share[:, _UPPER] / np.maximum(letters, 1)
    own[:, 9] = np.log1p(length)
    own[:, 10] = kinds[np.maximum(ends - 1, starts)] == _MARK
    own[:, 11] = kinds[starts] == _UPPER
    lines, at = big.split("\n"), 0
    for n in counts:
        seen, grams = set(), set()
        for k in range(at, at + n):
            line = lines[k]
            words = line.split()
            own[k, 12] = line in seen
            own[k, 13] = np.log1p(len(words))
            if words:
                seen.add(line)
                own[k, 14] = len(set(words)) / len(words)
                own[k, 15] = (length[k] - share[k, _SPACE]) / len(words) / 10
                own[k, 16] = len(words) <= 3
                own[k, 18] = sum(map(eq, words, words[1:])) / len(words)
                if len(words) >= GRAM:
                    before = len(grams)
                    grams.update(map(hash, zip(*[words[i:] for i in range(GRAM)], strict=False)))
                    own[k, 17] = 1 - (len(grams) - before) / (len(words) - GRAM + 1)
        at += n
    return own, size, counts


def with_neighbours(own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each line's features, then those of the line before and of the line after (zero if none)."""
    first = np.r_[0, np.cumsum(counts)[:-1]]
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first], after[np.cumsum(counts) - 1] = 0, 0
    return np.hstack([own, before, after])


def marginals(energy: np.ndarray, counts: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability that each line is good, and of each neighbouring pair of labels per document.

    ``energy``: log-odds of good per line; ``links``: two by two scores of neighbouring labels.
    All documents advance together, the longest first in order.
    """
    order = np.argsort(-counts, kind="stable")
    first = (np.r_[0, np.cumsum(counts)[:-1]])[order]
    sizes = counts[order]
    longest = int(sizes[0]) if len(sizes) else 0
    live = np.searchsorted(-sizes, -np.arange(longest), side="left")  # documents longer than t lines
    state = np.zeros((len(energy), 2))
    state[:, 1] = energy
    ahead, back = np.zeros_like(state), np.zeros_like(state)
    for t in range(longest):
        rows = first[: live[t]] + t
        if t:
            ahead[rows] = np.logaddexp(*np.moveaxis(ahead[rows - 1][:, :, None] + links, 1, 0))
        ahead[rows] += state[rows]
    for t in range(longest - 2, -1, -1):
        rows = first[: live[t + 1]] + t
        back[rows] = np.logaddexp(*np.moveaxis(links + (back[rows + 1] + state[rows + 1])[:, None, :], 2, 0))
    both = ahead + back
    total = np.logaddexp(both[:, 0], both[:, 1])
    good = np.exp(both[:, 1] - total)
    inner = np.ones(len(energy), bool)
    inner[np.cumsum(counts) - 1] = False
    left = np.flatnonzero(inner)
    pair = ahead[left][:, :, None] + links + (state[left + 1] + back[left + 1])[:, None, :] - total[left][:, None, None]
    return good, (left, np.exp(pair))


def fit(x: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and links by gradient ascent on the mean log-likelihood of each document's lines."""
    y = np.repeat(labels, counts).astype(np.float64)
    part = np.repeat(1.0 / counts, counts) / len(counts)
    theta = np.zeros(x.shape[1] + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        good, (left, pair) = marginals(x @ theta[:-4], counts, theta[-4:].reshape(2, 2))
        truth = np.zeros((len(left), 2, 2))
        same = y[left].astype(int)
        truth[np.arange(len(left)), same, same] = 1
        slope = np.r_[x.T @ ((y - good) * part), ((truth - pair) * part[left][:, None, None]).sum(0).ravel()] - DECAY * theta
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        theta = theta + RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return theta[:-4], theta[-4:].reshape(2, 2)


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The averaged weights and links of all shards; zeros without a labelled document."""
    sample = labelled_sample(docs, labels, "quality", FOLDS, HELD, SAMPLE_DOCS)

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, whole, marks = (c.to_pylist() for c in batch.columns)
            own, _, counts = line_features(whole)
            cuts = np.split(own.astype(np.float32), np.cumsum(counts)[:-1])
            order = [xxhash.xxh64_intdigest(str(i)) for i in ids]
            return pa.RecordBatch.from_arrays(
                [pa.array([o % SHARDS for o in order], pa.int32()), pa.array([o >> 1 for o in order], pa.int64()),
                 pa.array([c.tobytes() for c in cuts], pa.binary()), pa.array(marks, pa.int32())],
                names=["shard", "place", "lines", "label"],
            )

        return work

    schema = "shard int, place bigint, lines binary, label int"
    drawn = park(by_slice(sample.select("doc_id", "text", "label"), make, schema), "quality-sample")

    def shard_fit(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        each = [np.frombuffer(b, np.float32).reshape(-1, OWN) for b in rows.column("lines").to_pylist()]
        counts = np.array([len(e) for e in each])
        x = with_neighbours(np.concatenate(each).astype(np.float64), counts)
        weights, links = fit(x, counts, np.array(rows.column("label").to_pylist()))
        return pa.table({"theta": pa.array([np.r_[weights, links.ravel()].tolist()], pa.list_(pa.float64()))})

    fitted = drawn.groupBy("shard").applyInArrow(shard_fit, "theta array<double>").collect()
    if not fitted:
        return np.zeros(3 * OWN), np.zeros((2, 2))
    theta = np.mean([r["theta"] for r in sorted(fitted)], axis=0)
    return theta[:-4], theta[-4:].reshape(2, 2)


def document_scores(docs: list[str], weights: np.ndarray, links: np.ndarray) -> np.ndarray:
    """The length-weighted mean of the lines' probabilities of being good."""
    own, size, counts = line_features(docs)
    good, _ = marginals(with_neighbours(own, counts) @ weights, counts, links)
    first = np.r_[0, np.cumsum(counts)[:-1]]
    return np.clip(np.add.reduceat(good * size, first) / np.add.reduceat(size, first), 0.0, 1.0)


def score(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, by a field of the rows not held out."""
    docs = texts(df, id_col, text_col)
    model = df.sparkSession.sparkContext.broadcast(train(docs, labels))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def make():
        weights, links = model.value

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = document_scores(batch.column(1).to_pylist(), weights, links)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

        return work

    return by_slice(docs, make, f"doc_id {id_type}, score double").select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def good_documents(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows whose text reaches the threshold, with all their columns; no shuffle of texts."""
    docs = texts(df, id_col, text_col)
    model = df.sparkSession.sparkContext.broadcast(train(docs, labels))

    at = df.columns.index(text_col)

    def make():
        weights, links = model.value

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            whole = [t or "" for t in batch.column(at).to_pylist()]
            return batch.filter(pa.array(document_scores(whole, weights, links) >= threshold))

        return work

    return by_slice(df, make, df.schema)
