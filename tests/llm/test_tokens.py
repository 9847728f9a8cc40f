import base64
import hashlib
import struct

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from borelake.llm.bpe import Decoder, Encoder, PerfectHash, decode_ids, encode_checked, encode_texts, merge_spans
from borelake.llm.pieces import pre_tokens, token_counts
from borelake.llm.queries import PIECES, QUERIES, RANKS
from tests.llm.conftest import ROWS

LINES = open(RANKS, "rb").read()
ENCODER = Encoder(LINES, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
    mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, LINES.splitlines())},
)
MODEL = sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_perfect_hash_is_minimal_and_rejects_strangers():
    keys = [str(i).encode() for i in range(5000)]
    table = PerfectHash(keys)
    assert sorted(table.slots) == list(range(5000))
    sent = PerfectHash(keys, table.tables)
    assert (sent.slots, sent.shift) == (table.slots, table.shift)
    assert [table.get(k) for k in keys] == list(range(5000))
    assert table.get(b"stranger") == table.get(b"") == -1
    assert PerfectHash([]).get(b"a") == -1 and PerfectHash([b"a"]).get(b"a") == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=80))
def test_ids_are_the_librarys(text):
    ids = struct.pack(f"<{len(LIBRARY.encode_ordinary(text))}I", *LIBRARY.encode_ordinary(text))
    assert ENCODER.encode(text) == ids
    assert ENCODER.decode(ids) == text.encode()


def test_heap_merges_a_very_long_piece():
    piece = ("ab" * 30_000).encode()
    ids = merge_spans(piece, ENCODER.ranks)
    assert b"".join(ENCODER.tokens[i] for i in ids) == piece
    assert ids == LIBRARY.encode_ordinary(piece.decode())


def test_odd_documents_round_trip(odd):
    encoded = encode_texts(odd, RANKS, public_tokenizers.PATTERN, keep=("doc_id", "text", "a.b"))
    for row in decode_ids(encoded, RANKS, keep=("text", "n_tokens", "ids")).collect():
        text = row.text or ""
        assert bytes(row.decoded) == text.encode()
        assert row.n_tokens == len(LIBRARY.encode_ordinary(text)) == len(row.ids) // 4
    assert encode_texts(odd.where("false"), RANKS, public_tokenizers.PATTERN).collect() == []
    checked = encode_checked(odd, RANKS, public_tokenizers.PATTERN, keep=("doc_id", "text", "a.b"))
    assert checked.columns == ["doc_id", "text", "a.b", "n_tokens", "ids", "decoded_sha256", "round_trip"]
    want = sorted((str(r.doc_id), r.n_tokens, bytes(r.ids)) for r in encoded.select("doc_id", "n_tokens", "ids").collect())
    rows = checked.collect()
    assert sorted((str(r.doc_id), r.n_tokens, bytes(r.ids)) for r in rows) == want
    assert all(r.round_trip and r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest() for r in rows)


def test_memory_of_a_task_is_bounded(monkeypatch):
    monkeypatch.setattr("borelake.llm.bpe.MEMO_SIZE", 100)
    encoder = Encoder(LINES, public_tokenizers.PATTERN)
    text = " ".join(f"word{i}" for i in range(500)) + " " + "x" * 5000
    assert encoder.decode(encoder.encode(text)) == text.encode()
    assert len(encoder) <= 100 and all(len(t) <= 32 for t in encoder)
    assert Decoder({b"a": 0, b"b": 2}).decode(struct.pack("<3I", 2, 0, 2)) == b"bab"
    for strange in (1, 3):
        with pytest.raises(KeyError):
            Decoder({b"a": 0, b"b": 2}).decode(struct.pack("<I", strange))


def test_op2_over_whole_table(spark):
    texts = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op2_byte_bpe"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = LIBRARY.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" ▁\n\tab<s>"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_pre_tokens_are_independent(text):
    assert sum(len(MODEL.encode(t[1:])) or 1 for t in pre_tokens(text)) == len(MODEL.encode(text))


@pytest.mark.parametrize("head", [0, 1 << 18])
def test_piece_counts_of_odd_documents(odd, monkeypatch, head):
    monkeypatch.setattr("borelake.llm.pieces.HEAD", head)  # all by the join, or the common ones broadcast
    want = sorted((str(i), len((t or "").encode()), len(MODEL.encode(t or ""))) for i, t, *_ in ROWS)
    got = token_counts(odd, PIECES, 100).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)
    assert token_counts(odd.where("false"), PIECES, 100).collect() == []
