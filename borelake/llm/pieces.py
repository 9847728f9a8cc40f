"""Token counts of whole texts under a piece model, without ever holding ids.

No piece of the model has a space mark after another character, so a text splits before each run of
spaces into pre-tokens that the model encodes independently. Each distinct pre-token is counted
once, and a document's count is the sum over its pre-token frequencies.

* Frequent pre-tokens (up to ``HEAD`` of them, found in a bounded sample) are counted first and
  broadcast, so their occurrences are summed where the text is read. The sample decides only which
  way a pre-token takes, never a count.
* All others leave the scan as (row, pre-token, frequency), are made distinct by a shuffle, counted
  once, joined back and summed per row. Adaptive execution splits a skewed pre-token.

Defined results: a null or empty text has 0 tokens and bytes; null and repeated ids, repeated rows
and equal texts are counted row by row; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import park
from .common import by_slice, slices, texts

# Broadcast pre-tokens: at most so many, of at most so many characters each (about 16 MB).
HEAD, HEAD_CHARS = 1 << 18, 32
# Rows whose pre-tokens are candidates for the broadcast.
SAMPLE_ROWS = 20_000

_PRE_TOKEN = re.compile(r" +[^ ]*")


def pre_tokens(text: str) -> list[str]:
    """The text's independent parts, each with the spaces before it; the model adds the first one."""
    return _PRE_TOKEN.findall(" " + text.replace("▁", " ")) if text else []


@lru_cache(maxsize=2)
def _model(content: bytes):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=content)
    marked = (model.id_to_piece(i).lstrip("▁") for i in range(model.get_piece_size()))
    if any("▁" in piece for piece in marked):
        raise ValueError("this model has pieces that span words; its texts do not split at spaces")
    return model


def _count_pieces(tokens: DataFrame, model) -> DataFrame:
    """``token, pieces`` for a table of distinct ``token``."""

    def make():
        encode = _model(model.value).encode

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            words = batch.column(0).to_pylist()
            # The model puts the first space itself; of a lone space nothing would be left.
            sizes = [len(ids) or 1 for ids in encode([w[1:] for w in words], num_threads=1)]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32())], names=["token", "pieces"])

        return work

    return by_slice(tokens.select("token"), make, "token string, pieces int")


def _frequent(docs: DataFrame, model) -> dict[str, int]:
    """Piece counts of the commonest pre-tokens of some rows; at most ``HEAD`` entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                counts.update(t for t in pre_tokens(text) if len(t) <= HEAD_CHARS)
        rows = counts.most_common(2 * HEAD)
        yield pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], names=["token", "n"]
        )

    n = docs.count()
    share = min(1.0, SAMPLE_ROWS / max(n, 1))
    some = docs if share == 1.0 else docs.sample(share, seed=1)
    counted = some.select("text").mapInArrow(run, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    head = counted.where("n > 1").orderBy(F.desc("n"), "token").limit(HEAD)
    found = _count_pieces(head, model).toArrow()
    return dict(zip(found.column(0).to_pylist(), found.column(1).to_pylist(), strict=True))


def token_counts(df: DataFrame, model_path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row; over when more than ``limit`` tokens.

    ``model_path``: a model file that the driver reads (under a megabyte) and broadcasts.
    """
    spark = df.sparkSession
    docs = texts(df, id_col, text_col)
    with open(model_path, "rb") as file:
        model = spark.sparkContext.broadcast(file.read())
    head = spark.sparkContext.broadcast(_frequent(docs, model))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row string, doc_id {id_type}, n_bytes bigint, known bigint, tokens array<string>, times array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_size = head.value.get
        for batch in slices(batches):
            sums, rest, times = [], [], []
            for text in batch.column(2).to_pylist():
                total, others, often = 0, [], []
                for token, n in Counter(pre_tokens(text)).items():
                    pieces = known_size(token)
                    if pieces is None:
                        others.append(token)
                        often.append(n)
                    else:
                        total += pieces * n
                sums.append(total)
                rest.append(others)
                times.append(often)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(sums, pa.int64()),
                 pa.array(rest, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int32()))],
                names=["row", "doc_id", "n_bytes", "known", "tokens", "times"],
            )

    # A row is named once and then kept: its name must outlive a lost executor.
    named = docs.select(
        F.monotonically_increasing_id().cast("string").alias("row"), "doc_id", "text",
        F.octet_length("text").cast("bigint").alias("n_bytes"),
    )
    rows = park(named.mapInArrow(run, schema), "pre-tokens").withColumn("row", F.col("row").cast("bigint"))
    others = rows.select("row", F.inline(F.arrays_zip(F.col("tokens").alias("token"), F.col("times").alias("n"))))
    distinct = _count_pieces(others.select("token").distinct(), model)
    more = others.join(distinct, "token").groupBy("row").agg(F.sum(F.col("n") * F.col("pieces")).alias("more"))
    n_tokens = F.col("known") + F.coalesce("more", F.lit(0))
    return rows.select("row", "doc_id", "n_bytes", "known").join(more, "row", "left").select(
        "doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit")
    )
