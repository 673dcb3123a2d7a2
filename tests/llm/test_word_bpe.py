import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from appendlake.llm.word_bpe import WordCoder, coded, decoded

FILES = [public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")]
ODD = ["a", "The", " ", "\n", "é", "é", "日本", "　", "😀", "x" * 30, "\t", "\0", "\x85", "<|startoftext|>", "<|endoftext|>", "<|ENDOFTEXT|>", ".", "'s", "'LL", "123", "\xa0", "İ", "Σ", "ing", "</w>", "***", "ß", "ǅ", "ﬁ"]


@pytest.fixture(scope="module", params=FILES, ids=["words", "bytes"])
def tools(request):
    return WordCoder(request.param), Tokenizer.from_file(request.param)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ODD), max_size=12).map("".join) | st.text(max_size=30), min_size=1, max_size=3))
def test_same_as_the_library(tools, texts):
    coder, tokenizer = tools
    ids, shown = coder.of(pa.array(texts, pa.string()))
    for text, own, back in zip(texts, ids, shown):
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own, "<u4").tolist() == expected
        assert back.decode() == tokenizer.decode(expected, skip_special_tokens=False) == coder.decode(expected)


def test_pairs_that_fit_are_those_that_merging_leaves(tools):
    merges = tools[0].merges
    rng = np.random.default_rng(4)
    ends = set(np.flatnonzero(merges.token >= 0).tolist())
    tokens = np.array(sorted({int(merges.token[i]) for i in ends}))
    spelled = {}

    def symbols(t):
        if t not in spelled:
            spelled[t] = [t] if merges.rank[t] < 0 else symbols(int(merges.left[t])) + symbols(int(merges.right[t]))
        return spelled[t]

    # Pairs cut out of words that merge, and random ones.
    made = [t for t in tokens.tolist() if merges.rank[t] >= 0]
    pairs = [(int(merges.left[t]), int(merges.right[t])) for t in made[::40]]
    pairs += [tuple(p) for p in rng.choice(tokens, (3000, 2)).tolist()]
    for i in range(1500):
        whole = symbols(int(rng.choice(made)))
        cut = int(rng.integers(1, len(whole)))
        left, right = merges.merged(whole[:cut]), merges.merged(whole[cut:])
        pairs.append((left[-1], right[0]))
    fits = merges.compatible(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    expected = [merges.merged(symbols(a) + symbols(b)) == [a, b] for a, b in pairs]
    assert fits.tolist() == expected and 0 < sum(expected) < len(expected)


def test_words_fail_and_stand(tools):
    coder = tools[0]
    before = coder.words, coder.failed
    coder.of(pa.array(["Several ordinary words and thshenen oredre zzxqj unrecognisableness"], pa.string()))
    assert 0 < coder.failed - before[1] < coder.words - before[0]


def test_one_long_word(tools):
    coder, tokenizer = tools
    text = "abcdefghij" * 20_000
    ids, _ = coder.of(pa.array([text], pa.string()))
    assert np.frombuffer(ids[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_rows(odd_docs, no_docs):
    tokenizer = Tokenizer.from_file(FILES[0])
    rows = coded(odd_docs, FILES[0], text_at_once=1000)
    expected = []
    for r in odd_docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        expected.append((r.doc_id, len(ids), np.array(ids, "<u4").tobytes(), tokenizer.decode(ids, skip_special_tokens=False)))
    assert sorted((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in rows.where("doc_id is not null").collect()) == sorted(e for e in expected if e[0] is not None)
    assert coded(no_docs, FILES[0]).count() == 0
    assert sorted((r.decoded for r in decoded(rows, FILES[0]).collect())) == sorted(e[3] for e in expected)


def test_query(spark, docs_of, tmp_path):
    from appendlake.llm.queries import op13_word_bpe

    docs_of(["A small Text", None]).drop("a.b").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in op13_word_bpe(spark, str(tmp_path)).collect()}
    ids = Tokenizer.from_file(FILES[0]).encode("A small Text", add_special_tokens=False).ids
    assert (rows[0].n_tokens, rows[0].ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
    assert rows[0].decoded_sha256 == hashlib.sha256(b"a</w> small</w> text</w>").hexdigest()
    assert (rows[1].n_tokens, rows[1].ids_sha256) == (0, hashlib.sha256(b"").hexdigest())
