import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from appendlake.llm import packing, token_counts

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a", "the", " ", "  ", "\n", "▁", "é", "日本", "　", "😀", "x" * 30, "\t", "\0", "\x85", "<s>", "<|endoftext|>", ".", " \n", "\n ", "'s", "123", "\r\n", "\xa0", "​", "İ", "<0x41>", ",!!", "ing"]


@pytest.fixture(scope="module")
def tools():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES), token_counts.Counter(PIECES), Tokenizer.from_file(BYTE_BPE), packing.ChunkTokens(BYTE_BPE)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ODD), max_size=25).map("".join) | st.text(max_size=40))
def test_same_as_the_libraries(tools, text):
    pieces, counter, tokenizer, chunks = tools
    assert counter.of(pa.array([text], pa.string())).tolist() == [len(pieces.encode(text))]
    ids, ends = chunks.of(pa.array(["x", text], pa.string()))
    assert ids[ends[0] :].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_new_chunks_are_encoded_together():
    chunks = packing.ChunkTokens(BYTE_BPE)
    library, given_ = chunks.tokenizer, []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            given_.extend(texts)
            return library.encode_batch_fast(texts, **options)

    chunks.tokenizer = Counted()
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["wo", "rd", "<|endoftext|>", "é", "'s", "."]) + str(rng.randrange(10**6)) for _ in range(200)) + "\nend" for _ in range(20)]
    ids, ends = chunks.of(pa.array(texts))
    for text, own in zip(texts, np.split(ids, ends[:-1])):
        assert own.tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(given_) < 4000 // 20


def test_counts(odd_docs, no_docs, tools):
    got = {(r.doc_id, r.n_bytes): (r.n_tokens, r.over_limit) for r in token_counts.counted(odd_docs, PIECES).collect()}
    for r in odd_docs.collect():
        n = len(tools[0].encode(r.text or ""))
        assert got[r.doc_id, len((r.text or "").encode())] == (n, n > 4096)
    assert token_counts.counted(no_docs, PIECES).count() == 0


def test_sum_of_squares_fills_bins():
    rng = random.Random(2)
    sizes = np.array([rng.choice([rng.randrange(1, 300), rng.randrange(1, 2049)]) for _ in range(3000)] + [2048, 2048])
    bins, offsets = packing.sum_of_squares(sizes, 2048)
    inside = defaultdict(list)
    for b, o, s in zip(bins.tolist(), offsets.tolist(), sizes.tolist()):
        inside[b].append((o, s))
    for rows in inside.values():
        at = 0
        for o, s in sorted(rows):
            assert o == at
            at += s
        assert at <= 2048
    assert len(inside) <= -(-sizes.sum() // 2048) * 1.005 + 1


@pytest.mark.parametrize("group", [8_000_000, 20_000])
def test_packed(odd_docs, no_docs, tools, monkeypatch, group):
    monkeypatch.setattr(packing, "GROUP_TOKENS", group)
    rows = packing.packed(packing.pieces(odd_docs, BYTE_BPE)).collect()
    texts = {(r.doc_id, r.text) for r in odd_docs.collect()}
    for doc_id, text in texts:
        ids = [*tools[2].encode(text or "", add_special_tokens=False).ids, 0]
        mine = sorted({(r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in rows if r.doc_id == doc_id})
        assert [x for m in mine for x in m[4]] == ids
        assert all(m[2] == 2048 for m in mine[1:]) and mine[0][1] == 0
        for _, start, length, crc, own in mine:
            assert list(own) == ids[start : start + length]
            assert crc == zlib.crc32(np.array(own, "<u4").tobytes())
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert packing.packed(packing.pieces(no_docs, BYTE_BPE)).count() == 0
