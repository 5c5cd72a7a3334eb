"""Encoding, token index and packing."""

import zlib

import numpy as np
import pytest
from llm_helpers import collect
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tideline.llm import packing, token_index
from tideline.llm.common import new_folder
from tideline.llm.encode import ChunkEncoder, tokenizer_path

NAMES = ("byte_bpe_50k.json", "word_bpe_49k.json")
ENCODERS = {n: ChunkEncoder(tokenizer_path(n)) for n in NAMES}
TRICKY = st.lists(st.sampled_from(list("ab'sZé漢́İΣ \n\t\r\x0b\x1c\x85\xa0 .,!0") + ["<|endoftext|>", "  ", "don't"]), max_size=40).map("".join)


def ids_of(tokenizer: Tokenizer, text: str, end: int) -> np.ndarray:
    return np.asarray([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


@settings(max_examples=300, deadline=None)
@given(st.lists(TRICKY | st.text(max_size=30), max_size=5))
def test_chunks_encode_like_whole_texts(texts):
    for enc in ENCODERS.values():
        assert enc.encode_all(texts) == [np.asarray(enc.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_small_cache_gives_the_same_ids(monkeypatch):
    from tideline.llm import encode

    monkeypatch.setattr(encode, "CACHED_CHUNKS", 3)
    enc = ChunkEncoder(tokenizer_path(NAMES[0]))
    texts = ["one two three four five", "five four\nthree", "x" * 100 + " y"] * 3
    assert enc.encode_all(texts) == ENCODERS[NAMES[0]].encode_all(texts) and len(enc.ids) <= 3


@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(-2**63, 2**63 - 1), max_size=400))
def test_perfect_hash_is_minimal(keys):
    keys = np.asarray(sorted(keys), np.int64).view(np.uint64)
    assert sorted(token_index.PerfectHash.build(keys).slots(keys).tolist()) == list(range(len(keys)))


def test_index_round_trip(spark, odd, odd_rows, empty):
    tok = Tokenizer.from_file(tokenizer_path(NAMES[1]))
    folder = new_folder(spark, "ids")
    manifest = token_index.write_ids(odd, folder, tokenizer_path(NAMES[1]), 2, shard_bytes=500)
    assert manifest.count() > 3
    got = sorted(collect(token_index.read_ids(odd, manifest, folder), "start", "doc_id", "ids"))
    want, start = [], 0
    for doc, text in sorted(((r[0], r[1] or "") for r in odd_rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode())):
        ids = ids_of(tok, text, 2)
        want.append((start, doc, ids.tobytes()))
        start += len(ids)
    assert got == want
    shard = token_index.Shard(folder, manifest.orderBy("shard").collect()[-1]["shard"])
    assert shard.records([99_999]) == [range(0)]
    none = new_folder(spark, "ids")
    assert token_index.read_ids(empty, token_index.write_ids(empty, none, tokenizer_path(NAMES[1]), 2), none).count() == 0


@given(st.integers(0, 100_000))
def test_cuts_cover_a_document(n):
    parts = packing.cut(n)
    assert sum(length for length, _ in parts) == n
    assert all(0 < length <= packing.CAPACITY // k for length, k in parts)


def check_packed(rows, ids):
    """rows: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces, sequences = {}, {}
    for doc, start, length, crc, n, seq, offset in rows:
        pieces.setdefault(doc, []).append((start, length, crc, n))
        sequences.setdefault(seq, []).append((offset, length))
    for doc, texts in ids.items():
        got = sorted(pieces.get(doc, []))
        assert sorted((s, length, c) for s, length, c, n in got) == sorted((s, length, zlib.crc32(t[s:s + length].tobytes())) for t, s, length in matched(texts, got))
        assert sum(length for _, length, _, _ in got) == sum(len(t) for t in texts)
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return sequences


def matched(texts, got):
    by_size = {len(t): t for t in texts}
    return [(by_size[n], s, length) for s, length, _, n in got]


def test_pack_of_odd_rows(odd, odd_rows, empty):
    tok = Tokenizer.from_file(tokenizer_path(NAMES[0]))
    ids = {}
    for r in odd_rows:
        ids.setdefault(r[0], []).append(ids_of(tok, r[1], 1))
    packed = packing.pack(odd.repartition(3), tokenizer_path(NAMES[0]), 1)
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    sequences = check_packed(collect(packed.placed, *columns), ids)
    full = sum(len(t) for texts in ids.values() for t in texts)
    assert len(sequences) <= -(-full // packing.CAPACITY) + 2
    for r in packed.sequences().collect():
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    assert packing.pack(empty, tokenizer_path(NAMES[0]), 1).placed.count() == 0


@pytest.mark.parametrize("parts", [1, 5])
def test_padding_is_small(spark, parts):
    from tideline.llm.common import documents

    docs = documents(spark, "/root/testdata/sf0.01").repartition(parts)
    placed = packing.pack(docs, tokenizer_path(NAMES[0]), 1).placed.groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert 1 - sum(r[1] for r in placed) / (packing.CAPACITY * len(placed)) < 0.02


def test_tiny_documents_fill_their_sequences(spark):
    """Documents of one to a few tokens, empty ones among them."""
    docs = spark.range(20_000).selectExpr("id as doc_id", "case id % 4 when 0 then '' when 1 then 'a' when 2 then 'a b c d' else null end as text")
    placed = packing.pack(docs.repartition(3), tokenizer_path(NAMES[0]), 1).placed
    seen = placed.groupBy("sequence_id").agg({"length": "sum", "doc_id": "count"}).collect()
    tokens = sum(r["sum(length)"] for r in seen)
    assert tokens >= 30_000 and 1 - tokens / (packing.CAPACITY * len(seen)) < 0.05
    assert placed.select("doc_id").distinct().count() == 20_000
