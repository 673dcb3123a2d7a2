"""SimHash fingerprints, and near-duplicate groups by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appendlake.llm.components import components
from appendlake.llm.inputs import memory_returned, named
from appendlake.session import persist_table

SHINGLES_AT_ONCE = 1 << 16
ROWS_PER_BLOCK = 2048


@dataclass(frozen=True)
class Index:
    """Which fingerprints are looked for among which.

    A fingerprint has ``words`` words of 64 bits, cut into segments of ``segment_bits``.
    A pair is found if some segment differs in at most ``radius`` bits, and kept if the
    whole differs in at most ``distance``. With s segments every pair of distance up to
    s * (radius + 1) - 1 is found.
    """

    words: int = 1
    segment_bits: int = 32
    radius: int = 1
    distance: int = 3

    @property
    def columns(self) -> list[str]:
        return [f"fp{i}" for i in range(self.words)]

    def masks(self) -> list[int]:
        """The bits to flip for every other value in the ball around a segment."""
        bits = [1 << i for i in range(self.segment_bits)]
        return [sum(c) for n in range(1, self.radius + 1) for c in combinations(bits, n)]

    def keys(self) -> list[Column]:
        """One key per segment: the segment's number above its value."""
        cut = (1 << self.segment_bits) - 1
        per_word = 64 // self.segment_bits
        return [
            F.shiftrightunsigned(c, i * self.segment_bits).bitwiseAND(F.lit(cut)).bitwiseOR(F.lit((w * per_word + i) << self.segment_bits))
            for w, c in enumerate(self.columns)
            for i in range(per_word)
        ]


def fingerprint(text: bytes | None, width: int, words: int, seed: int) -> list[int]:
    """SimHash words, as signed 64-bit numbers; 0 for a text without words.

    The first word's features are the XXH64 of each shingle of ``width`` lower-cased
    words, repeats included; further words take a mix of that hash.
    """
    parts = (text or b"").lower().split()
    if not parts:
        return [0] * words
    n = max(1, len(parts) - width + 1)
    ones = np.zeros((words, 64), np.int64)
    for start in range(0, n, SHINGLES_AT_ONCE):
        piece = parts[start : start + SHINGLES_AT_ONCE + width - 1]
        shingles = map(b" ".join, zip(*(piece[i:] for i in range(width)))) if len(parts) >= width else [b" ".join(parts)]
        h = np.frombuffer(b"".join(map(xxhash.xxh64_digest, shingles, repeat(seed))), ">u8").astype(np.uint64)
        for w in range(words):
            bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            ones[w] += bits.sum(axis=0, dtype=np.int32)
            h = _mixed(h)
    packed = np.packbits(ones * 2 > n, axis=1)
    return np.frombuffer(packed.tobytes(), ">i8").tolist()


def _mixed(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    with np.errstate(over="ignore"):
        z = h + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def fingerprints(docs: DataFrame, width: int = 3, words: int = 1, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``doc_id``, ``fp0``, ...) of every row; a null text counts as empty."""
    names = [f"fp{i}" for i in range(words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with memory_returned():
            for batch in batches:
                found = np.array([fingerprint(t.as_py(), width, words, seed) for t in batch.column(1)], np.int64).reshape(-1, words)
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[:, i]) for i in range(words))], ["doc_id", *names])

    rows = docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{n} long" for n in names))


def groups(prints: DataFrame, index: Index) -> DataFrame:
    """The rows of ``fingerprints`` with ``component_id``, the smallest doc_id reachable over links.

    Equal fingerprints are one entry of the tables from the start, so any number of
    copies costs one look-up. Rows with a null doc_id get a null component_id and link
    nothing; rows that share a doc_id are one document. An empty input gives no rows.
    """
    fp = index.columns
    prints = persist_table(prints, "fingerprints")
    classes = persist_table(prints.filter("doc_id is not null").groupBy(*fp).agg(F.min("doc_id").alias("class_id")), "classes")
    stars = components(links(classes, index))
    roots = classes.join(stars, classes["class_id"] == stars["node"], "left")
    roots = persist_table(roots.select(*fp, F.coalesce("root", "class_id").alias("component_id")), "roots")
    same = reduce(lambda x, y: x & y, [prints[c] == roots[c] for c in fp])
    shown = F.when(prints["doc_id"].isNotNull(), roots["component_id"]).alias("component_id")
    return prints.join(roots, same, "left").select(prints["doc_id"], *[prints[c] for c in fp], shown)


def links(classes: DataFrame, index: Index) -> DataFrame:
    """Links (``a``, ``b``) that connect what lies within the distance, a forest per bucket.

    Every class enters one bucket per segment. It also looks into each smaller value in
    the ball around its segment (the larger value of a pair looks, once). Looks at empty
    buckets end in a semi join. What is left meets per bucket, and whole distances are
    compared there. A bucket of more than ``ROWS_PER_BLOCK`` rows is cut into blocks and
    each pair of blocks meets in a group of its own, so no task holds a whole hot bucket,
    and no pair is left out.
    """
    fp = index.columns
    table = classes.select(F.explode(F.array(*index.keys())).alias("key"), F.lit(False).alias("looks"), "class_id", *fp)
    flips = F.explode(F.array(*[F.lit(m).cast("long") for m in index.masks()])).alias("flip")
    looks = table.select("key", flips, "class_id", *fp).withColumn("to", F.col("key").bitwiseXOR(F.col("flip")))
    looks = looks.filter("to < key").select(F.col("to").alias("key"), F.lit(True).alias("looks"), "class_id", *fp)
    met = looks.join(table.select("key").distinct(), "key", "left_semi")
    met = persist_table(table.unionByName(met), "buckets")
    sizes = met.groupBy("key").count().filter("count > 1")
    sizes = persist_table(sizes.select("key", F.ceil(F.col("count") / ROWS_PER_BLOCK).cast("int").alias("blocks")), "sizes")
    own = F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")
    met = met.join(sizes, "key").withColumn("own", own)
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "looks", "class_id", *fp)
    met = met.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "looks")
    words, distance = index.words, index.distance

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with memory_returned():
            for part in whole_groups(batches):
                a, b = _compared(part, words, distance)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return met.mapInArrow(run, "a long, b long")


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Batches of sorted rows, cut between groups instead of anywhere."""
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        part = {n: np.asarray(c) for n, c in zip(batch.schema.names, batch.columns)}
        if held is not None:
            part = {n: np.concatenate([held[n], c]) for n, c in part.items()}
        starts = group_starts(part)
        cut = starts[-1] if len(starts) else 0
        held = {n: c[cut:] for n, c in part.items()}
        if cut:
            yield {n: c[:cut] for n, c in part.items()}
    if held is not None and len(held["key"]):
        yield held


def group_starts(part: dict[str, np.ndarray]) -> np.ndarray:
    if not len(part["key"]):
        return np.zeros(0, np.int64)
    new = np.ones(len(part["key"]), bool)
    new[1:] = reduce(np.logical_or, [part[n][1:] != part[n][:-1] for n in ("key", "lo", "hi")])
    return np.flatnonzero(new)


def _compared(part: dict[str, np.ndarray], words: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest of the pairs within the distance in each group; entries come before looks."""
    fps = np.stack([part[f"fp{i}"].view(np.uint64) for i in range(words)])
    ids, looks = part["class_id"], part["looks"]
    starts = group_starts(part)
    sizes = np.diff(np.append(starts, len(ids)))
    group = np.repeat(np.arange(len(starts)), sizes)
    small = np.flatnonzero(np.repeat(sizes <= 64, sizes))
    found_a, found_b = [], []

    def keep(a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            a, b = forest(ids[a], ids[b])
            found_a.append(a)
            found_b.append(b)

    for shift in range(1, 64):
        a, b = small[:-shift], small[shift:]
        same = (group[a] == group[b]) & ~looks[a]
        if not same.any():
            break
        a, b = a[same], b[same]
        near = np.bitwise_count(fps[:, a] ^ fps[:, b]).sum(axis=0, dtype=np.int32) <= distance
        keep(a[near], b[near])
    for start, size in zip(starts[sizes > 64], sizes[sizes > 64]):
        rows = np.arange(start, start + size)
        entries = rows[~looks[rows]]
        for at in range(0, len(entries), 128):
            some = entries[at : at + 128]
            apart = np.bitwise_count(fps[:, some, None] ^ fps[:, None, rows]).sum(axis=0, dtype=np.int32)
            a, b = np.nonzero(apart <= distance)
            keep(some[a], rows[b])
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return forest(np.concatenate(found_a), np.concatenate(found_b))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links (a, b) with the smallest node of its component, itself left out."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    out = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[out], nodes[label[out]]
