import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from appendlake.llm import topk, toxicity


@pytest.fixture(scope="module")
def marked(spark, docs_of):
    rng = random.Random(4)
    texts, labels = [], []
    for i in range(400):
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "river", "stone"]) + rng.choice("abc") for _ in range(40)]
        if i % 8 == 0:
            words.insert(rng.randrange(40), rng.choice(["Nastyword", "uglyterm"]))
        texts.append(" ".join(words))
        labels.append((i, 1, int(i % 8 == 0)))
    labels += [(8, 1, 0), (None, 1, 1), (9999, 0, 1), (5, 1, None)]
    return docs_of(texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows(marked):
    docs, labels = marked
    model = toxicity.trained(toxicity.labelled(docs, labels, F.col("doc_id") % 5 != 0))
    rows = toxicity.scored(docs, model).collect()
    held_out = [r for r in rows if r.doc_id % 5 == 0]
    assert all(0 <= r.score <= 1 for r in rows)
    wrong = [r.doc_id for r in held_out if (r.score >= 0.5) != (r.doc_id % 8 == 0)]
    assert not wrong


def test_shuffled_labels_agree_with_broadcast_ones(marked):
    docs, labels = marked
    few = toxicity.labelled(docs, labels, F.lit(True)).collect()
    many = toxicity.labelled(docs, labels, F.lit(True), broadcast_rows=0).collect()
    assert sorted(few) == sorted(many) and len(few) == 400
    assert {r.doc_id: r.label for r in few}[8] == 1


def test_odd_rows_and_one_class(spark, marked, odd_docs, no_docs):
    docs, labels = marked
    model = toxicity.trained(toxicity.labelled(docs, labels, F.lit(True)))
    rows = toxicity.scored(odd_docs, model)
    assert rows.columns == [*[c for c in odd_docs.columns if c != "score"], "score"]
    scores = {r.doc_id: r.score for r in rows.collect()}
    assert scores[2] == scores[3] == scores[6] and len(scores) == len({r.doc_id for r in odd_docs.collect()})
    assert toxicity.scored(no_docs, model).count() == 0
    for share, value in ((0, 0.0), (1, 1.0)):
        one = toxicity.trained(toxicity.labelled(docs, labels.filter(F.col("toxic") == share), F.lit(True)))
        assert [r.score for r in toxicity.scored(odd_docs, one).collect()] == pytest.approx([value] * odd_docs.count(), abs=1e-12)
    none = toxicity.trained(toxicity.labelled(no_docs, labels, F.lit(True)))
    assert max(r.score for r in toxicity.scored(odd_docs, none).collect()) < 1e-12


def test_grams_of_stretches_are_those_of_the_whole(monkeypatch):
    text = "".join(random.Random(5).choices("abcde é", k=1000))
    whole = set(np.concatenate(list(toxicity.grams(text))).tolist())
    monkeypatch.setattr(toxicity, "CHARS_AT_ONCE", 37)
    assert set(np.concatenate(list(toxicity.grams(text))).tolist()) == whole
    assert len(whole) == sum(len({text[i : i + n] for i in range(len(text) - n + 1)}) for n in toxicity.LENGTHS)


def test_features_and_weights_against_plain_python(marked):
    """All features by support and significance, and weights that solve the ridge problem."""
    docs, labels = marked
    rows = toxicity.labelled(docs, labels, F.lit(True))
    model = toxicity.trained(rows)
    texts = [({int(h) >> (64 - toxicity.BIN_BITS) for part in toxicity.grams(r.text) for h in part}, r.label) for r in rows.collect()]
    n_pos = sum(label for _, label in texts)
    n_neg = len(texts) - n_pos
    ratio = {}
    for b in set().union(*(own for own, _ in texts)):
        pos = sum(label for own, label in texts if b in own)
        neg = sum(1 - label for own, label in texts if b in own)
        p = (pos + neg + 1) / (n_pos + n_neg + 2)
        apart = abs(pos / n_pos - neg / n_neg) / np.sqrt(p * (1 - p) * (1 / n_pos + 1 / n_neg))
        if pos + neg >= toxicity.MIN_DOCS and apart >= toxicity.MIN_ERRORS:
            ratio[b] = np.log((pos + 1) / (n_pos + 2)) - np.log((neg + 1) / (n_neg + 2))
    assert set(np.flatnonzero(model.weights).tolist()) == set(ratio)
    bins = sorted(ratio)
    scale = np.array([ratio[b] for b in bins])
    x = np.array([[b in own for b in bins] for own, _ in texts]) * scale
    w = model.weights[bins] / scale
    y = np.array([label for _, label in texts], float)
    slope = x.T @ (y - 1 / (1 + np.exp(-(x @ w + model.bias)))) - w
    assert np.abs(slope).max() < 1e-2


def test_five_thousand_toxic_terms(spark, docs_of):
    """No limit of features: terms that eight texts each have are known again in texts of their own."""
    rng = random.Random(8)
    terms = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=10)) for _ in range(5000)]
    plain = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(2000)]

    def text(*own):
        return " ".join(rng.sample([*own, *rng.choices(plain, k=10 - len(own))], k=10))

    texts = [text(term) for term in terms for _ in range(8)] + [text() for _ in range(40_000)]
    labels = spark.createDataFrame([(i, int(i < 40_000)) for i in range(80_000)], "doc_id long, toxic int")
    model = toxicity.trained(toxicity.labelled(docs_of(texts).repartition(8), labels, F.lit(True)))
    tests = [text(t) for t in rng.sample(terms, k=1000)] + [text() for _ in range(1000)]
    toxic = {r.doc_id: r.score >= 0.5 for r in toxicity.scored(docs_of(tests), model).collect()}
    assert sum(toxic[i] for i in range(1000)) >= 900
    assert sum(toxic[i] for i in range(1000, 2000)) <= 50


def test_bounded_fit(marked):
    """Few entries for the fit: the features stay the same, only their weights come from fewer rows."""
    docs, labels = marked
    rows = toxicity.labelled(docs, labels, F.lit(True))
    all_, few, one = toxicity.trained(rows), toxicity.trained(rows, fit_entries=2000), toxicity.trained(rows, fit_entries=0)
    assert (np.flatnonzero(all_.weights) == np.flatnonzero(few.weights)).all()
    scores = {r.doc_id: r.score for r in toxicity.scored(docs, few).collect()}
    assert sum((scores[i] >= 0.5) == (i % 8 == 0) for i in range(400)) >= 390
    assert np.isfinite(one.weights).all()


@pytest.mark.parametrize(("block", "scale", "k"), [(16_384, 1.0, 20), (50, 1.0, 5), (50, 400.0, 5), (50, 0.01, 7)])
def test_top_k(spark, monkeypatch, block, scale, k):
    monkeypatch.setattr(topk, "CANDIDATES_PER_BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", 7)
    rng = np.random.default_rng(6)
    rows = [(int(i), [float(x) for x in rng.normal(size=8).astype(np.float32) * np.float32(scale)]) for i in rng.permutation(300)]
    rows += [(400, rows[0][1]), (401, rows[0][1]), (420, rows[5][1])]  # ties and equal vectors
    odd = [(500, None), (501, [1.0, None] + [0.0] * 6), (502, [float("nan")] * 8), (503, [float("inf")] * 8), (None, rows[1][1]), (504, []), (520, [1.0, 2.0]), (521, [2.0, 1.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = {}
    for r in topk.top_k(topk.usable(df), F.col("vec_id") % 20 == 0, k).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    ints = {i: np.floor(64 * np.array(v, np.float32).astype(np.float64)).astype(np.int64) for i, v in [*rows, odd[-2], odd[-1]]}
    for q in [i for i in ints if i % 20 == 0]:
        scores = sorted((-int(ints[q] @ v), i) for i, v in ints.items() if i != q and len(v) == len(ints[q]))
        assert sorted(got.pop(q)) == [(n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    assert not got
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(topk.usable(empty), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("dim", [1024, 4096])
def test_top_k_of_many_dimensions(spark, dim):
    """Sums of products beyond what single precision holds, with scores that lie close together."""
    rng = np.random.default_rng(7)
    ints = {i: (rng.normal(3, 1, dim) if i % 20 else rng.normal(15, 2, dim)).round().astype(np.int64) for i in range(120)}
    df = spark.createDataFrame([(i, [float(x) / 64 for x in v]) for i, v in ints.items()], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(topk.usable(df), F.col("vec_id") % 20 == 0).collect()}
    for q in range(0, 120, 20):
        scores = sorted((-int(ints[q] @ v), i) for i, v in ints.items() if i != q)
        assert [got[q, n + 1] for n in range(20)] == [(i, -s) for s, i in scores[:20]]
