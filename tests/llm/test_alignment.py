import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from appendlake.llm import alignment
from appendlake.llm.alignment import Aligner, aligned, common_ends, counted

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a", "the", " ", "  ", "\n", "▁", "é", "日本", "　", "😀", "x" * 30, "\t", "\0", "\x85", "<s>", "<|endoftext|>", ".", " \n", "\x1c", "'s", "123", "\xa0", "<0x41>", "ing"]


@pytest.fixture(scope="module")
def both():
    return Aligner(A, B)


def plain(both, text):
    """(ids of A, ids of B, common ends, one list of links) by sets of offsets, nothing cut or remembered."""
    a, b = (both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)) if text else ([], [])
    spelled = [[own[i] for i in ids] for own, ids in ((both.bytes_a, a), (both.bytes_b, b))]
    if not text or any(b"".join(s) != (" " + text).encode() for s in spelled):
        return [], [], []
    ends = []
    for s in spelled:
        at, own = 0, {}
        for i, part in enumerate(s):
            at += len(part)
            own[at] = i
        ends.append(own)
    return a, b, [(ends[0][e], ends[1][e]) for e in sorted(ends[0].keys() & ends[1].keys())]


def shown(a, b, ends):
    cuts = zip([(-1, -1), *ends], ends)
    return ";".join(",".join(map(str, a[i + 1 : x + 1])) + "|" + ",".join(map(str, b[j + 1 : y + 1])) for (i, j), (x, y) in cuts)


@given(st.sets(st.integers(0, 60)), st.sets(st.integers(0, 60)))
def test_common_ends(a, b):
    x, y = sorted(a), sorted(b)
    places = common_ends(np.array(x, np.int64), np.array(y, np.int64), np.zeros(len(y), np.int64), np.zeros(len(x), np.int64))
    assert list(zip(*(p.tolist() for p in places))) == [(x.index(v), y.index(v)) for v in sorted(a & b)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ODD), max_size=12).map("".join) | st.text(max_size=30), min_size=1, max_size=3))
def test_chunks_give_what_whole_texts_give(both, texts):
    sizes, groups_shown, links, ends = both.of(pa.array(texts, pa.string()))
    start = 0
    for text, size, own, end in zip(texts, sizes.tolist(), groups_shown, ends.tolist()):
        a, b, common = plain(both, text)
        assert (size, own) == ([len(a), len(b), len(common)], shown(a, b, common))
        assert links[start:end].tolist() == [a[i] << alignment.LOW | b[j] for i, j in common]
        start = end


def test_forgetting_changes_nothing():
    small = Aligner(A, B, kept_bytes=0)
    texts = pa.array(["one two", "two three  four", ""], pa.string())
    first = [x.tolist() if hasattr(x, "tolist") else x for x in small.of(texts)]
    assert [x.tolist() if hasattr(x, "tolist") else x for x in small.of(texts)] == first


@pytest.mark.parametrize("broadcast_pairs", [200_000, 40, 0])
def test_counts(odd_docs, both, broadcast_pairs):
    rows = counted(aligned(odd_docs, A, B), broadcast_pairs).collect()
    texts = [(r.doc_id, r.text or "") for r in odd_docs.collect()]
    found = [(doc_id, *plain(both, text)) for doc_id, text in texts]
    count = Counter((a[i], b[j]) for _, a, b, ends in found for i, j in ends)
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    expected = []
    for doc_id, a, b, ends in found:
        links = [(a[i], b[j]) for i, j in ends]
        best = sum(count[x] == most[x[1]] for x in links)
        expected.append((doc_id, len(a), len(b), len(ends), len(ends), shown(a, b, ends), best, sum(count[x] for x in links)))
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum")
    assert sorted((tuple(r[n] for n in names) for r in rows), key=repr) == sorted(expected, key=repr)


def test_no_rows_and_no_links(no_docs, docs_of):
    assert counted(aligned(no_docs, A, B)).count() == 0
    row = counted(aligned(docs_of(["▁ x"]), A, B)).first()
    assert (row.n_a, row.n_b, row.n_groups, row.n_links, row.groups, row.n_best, row.count_sum) == (0, 0, 0, 0, "", 0, 0)


def test_query(spark, docs_of, both, tmp_path):
    from appendlake.llm.queries import op11_alignment

    docs_of(["A small text.", None]).drop("a.b").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in op11_alignment(spark, str(tmp_path)).collect()}
    a, b, ends = plain(both, "A small text.")
    assert rows[0].groups_sha256 == hashlib.sha256(shown(a, b, ends).encode()).hexdigest()
    assert rows[1].groups_sha256 == "" and rows[1].n_links == 0
