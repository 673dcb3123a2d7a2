from collections import Counter

import numpy as np
import pytest

from appendlake.llm import mixing, sharding


def test_targets():
    assert mixing.targets([]) == []
    assert mixing.targets([0, 0]) == [0.0, 0.0]
    got = mixing.targets([10, 1000, 1000, 1000])
    assert got[0] == 30 and abs(sum(got) - 3010) < 1e-6
    assert all(t <= 3 * s for t, s in zip(got, [10, 1000, 1000, 1000]))
    assert got[1] / got[2] == pytest.approx(2) and got[3] == pytest.approx(5 * got[2])


def test_split_is_exact():
    blocks = np.array([0, 1, 255, 769])
    split = mixing.split_quotas(blocks, 16, 5)
    assert (split.sum(axis=0) == blocks).all() and (split >= 0).all()
    assert np.ptp(split.sum(axis=1)) <= 4
    assert (split == mixing.split_quotas(blocks, 16, 5)).all()
    assert mixing.split_quotas(np.zeros(0, int), 3, 5).shape == (3, 0)


@pytest.mark.parametrize("edge_rows", [64, 3])
def test_words_taken(spark, docs_of, monkeypatch, edge_rows):
    monkeypatch.setattr(mixing, "EDGE_ROWS", edge_rows)
    texts = [" ".join(["w"] * (1 + i * 7 % 50)) for i in range(900)]
    docs = docs_of(texts, sources=["hot" if i % 3 == 0 else f"s{i % 7}" if i % 5 else None for i in range(900)])
    rows = mixing.placed(docs).collect()
    again = {(r.doc_id, tuple(r.copies)) for r in mixing.placed(docs.repartition(3)).collect()}
    assert again == {(r.doc_id, tuple(r.copies)) for r in rows}
    names = sorted({r.source for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(r["size"] for r in rows if r.source == s) for s in names]
    for s, size, target in zip(names, sizes, mixing.targets(sizes)):
        mine = [r for r in rows if r.source == s]
        assert {r.source_size for r in mine} == {size}
        assert all(r.target == pytest.approx(target) for r in mine)
        assert abs(sum(r["size"] * len(r.copies) for r in mine) - target) <= 25
        assert all(len(r.copies) <= 3 for r in mine)
    mixed = mixing.mixed(docs)
    assert mixed.count() == sum(len(r.copies) for r in rows)
    assert {"text", "mix_shard", "a.b"} <= set(mixed.columns)


def test_odd_documents_mix(odd_docs, no_docs):
    rows = mixing.placed(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["size"] == len((r.text or "").encode().split()) for r in rows)
    assert mixing.placed(no_docs).count() == 0 and mixing.mixed(no_docs).count() == 0


@pytest.mark.parametrize("total", [1, 2, 3, 16, 17, 1000, 4097])
def test_permutation(total):
    at = np.arange(total)
    places = sharding.permuted(at, total, 9)
    assert sorted(places.tolist()) == at.tolist()
    assert (sharding.original(places, total, 9) == at).all()
    assert total < 100 or (places != at).mean() > 0.9


def test_shards(odd_docs, no_docs):
    order = ["doc_id", "text"]
    rows = sharding.sharded(odd_docs, order, 4).collect()
    assert len(rows) == odd_docs.count()
    slots = [sorted(r.slot for r in rows if r.shard == s) for s in range(4)]
    assert all(x == list(range(len(x))) for x in slots)
    assert max(map(len, slots)) - min(map(len, slots)) <= 1
    pair = lambda r: (str(r.doc_id), r.text or "", r.shard, r.slot)
    again = sharding.sharded(odd_docs.repartition(5), order, 4).collect()
    assert sorted(map(pair, again)) == sorted(map(pair, rows))
    assert sharding.sharded(no_docs, order).count() == 0


def test_few_python_workers(spark, docs_of, monkeypatch):
    """A task of the mix calls ``place`` once, and the descent starts no Python of its own."""

    def refused(*_, **__):
        raise AssertionError("rows of a list go through Python workers")

    monkeypatch.setattr(mixing, "EDGE_ROWS", 3)
    docs = docs_of(["w " * (1 + i % 9) for i in range(300)], sources=[["a", "b", None][i % 3] for i in range(300)])
    with monkeypatch.context() as m:
        m.setattr(type(spark.sparkContext), "parallelize", refused)
        mix = mixing.mixed(docs)
    assert mix._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    copies = {r.doc_id: len(r.copies) for r in mixing.placed(docs).select("doc_id", "copies").collect()}
    assert 0 in copies.values()
    assert Counter(r.doc_id for r in mix.select("doc_id").collect()) == {i: n for i, n in copies.items() if n}
