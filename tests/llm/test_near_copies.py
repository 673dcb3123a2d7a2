import random

import numpy as np
import pytest
import xxhash

from appendlake.llm import simhash
from appendlake.llm.components import components


def plain_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(60)] + [(200, 200 + i) for i in range(1, 40)]
    pairs += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(7, 7)]
    rng.shuffle(pairs)
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    expected = roots(pairs, {x for p in pairs for x in p})
    assert got == {n: r for n, r in expected.items() if n != r}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest():
    a, b = np.array([5, 3, 9, 1]), np.array([4, 4, 8, 3])
    got = simhash.forest(a, b)
    assert dict(zip(*map(list, got))) is not None
    assert sorted(zip(got[0].tolist(), got[1].tolist())) == [(3, 1), (4, 1), (5, 1), (9, 8)]


def test_odd_documents(spark, odd_docs, no_docs):
    rows = simhash.groups(simhash.fingerprints(odd_docs), simhash.Index()).collect()
    assert len(rows) == odd_docs.count()
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted((str(r.doc_id), r.fp0 % (1 << 64)) for r in rows) == sorted((str(i), plain_fingerprint(t)) for i, t in texts)
    by_id = {r.doc_id: r.component_id for r in rows}
    assert by_id[0] == by_id[1] == 0
    assert by_id[2] == by_id[3] == by_id[6] == 2  # without words: zero, and linked
    assert by_id[None] is None
    assert simhash.groups(simhash.fingerprints(no_docs), simhash.Index()).count() == 0


@pytest.mark.parametrize(("block", "words", "bits", "distance"), [(2048, 1, 32, 3), (16, 1, 32, 3), (16, 2, 16, 15)])
def test_groups_find_every_link(spark, monkeypatch, block, words, bits, distance):
    """Dense clusters and single fingerprints; small blocks split the hot buckets."""
    monkeypatch.setattr(simhash, "ROWS_PER_BLOCK", block)
    rng = random.Random(block)
    width = 64 * words
    prints = []
    for _ in range(6):
        center = rng.getrandbits(width)
        for _ in range(90):
            x = center
            for b in rng.sample(range(width), rng.randrange(0, distance + 2)):
                x ^= 1 << b
            prints.append(x)
    prints += [rng.getrandbits(width) for _ in range(60)] + [0, 0, 7, (1 << 64) - 1]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(i, *[signed(x >> 64 * w & (1 << 64) - 1) for w in range(words)]) for i, x in enumerate(prints)]
    names = [f"fp{w}" for w in range(words)]
    df = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{n} long" for n in names))
    index = simhash.Index(words, bits, 1, distance)
    got = {r.doc_id: r.component_id for r in simhash.groups(df, index).collect()}
    pairs = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= distance]
    assert got == roots(pairs, range(len(prints)))
