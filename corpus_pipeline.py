"""The corpus pipeline: from raw documents to encoded ones.

Each stage works on all rows that the one before kept, and is written before the next begins. All
but the last return the columns they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from borelake.config import park
from borelake.functions.coerce import quoted
from borelake.llm import bloom_dedup, bpe, line_crf, mixing, simhash_gray
from borelake.llm.common import table
from borelake.llm.queries import LEVELS, MAX_BITS_APART, MIX_SEED, RANKS, SHINGLE_WORDS, WEIGHTS, with_domain

# Of the tokens that reach the mixture, the share it keeps; no document is repeated.
MIX_SHARE = 0.9


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier does not reject."""
    return line_crf.good_documents(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document of the smallest id."""
    return bloom_dedup.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash_gray.keep_one(docs, size=SHINGLE_WORDS, distance=MAX_BITS_APART)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fill the budgets of their domain, language and source."""
    mixed = mixing.mixture(with_domain(docs), LEVELS, WEIGHTS, MIX_SHARE, max_epochs=1, seed=MIX_SEED)
    return mixed.select(*[quoted(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids`` and whether the ids decode to the very text."""
    encoded = bpe.encode_checked(docs, RANKS, public_tokenizers.PATTERN, keep=("doc_id", "lang", "source"))
    return encoded.drop("decoded_sha256")


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("encode", encode),
]

# The classifier of the first stage has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = park(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
