"""Mixing sources to target weights, with exact quotas per source and output shard."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appendlake.llm.inputs import named
from appendlake.llm.sharding import permuted
from appendlake.session import persist_table

WEIGHTS = (5.0, 2.0, 1.0)
BINS = 256
EDGE_ROWS = 64
MAX_SOURCES = 100_000
WORD = "[^\\x20\\x09-\\x0D]++"


@dataclass
class Quota:
    """What the mix takes of a source: every document ``whole`` times, and once more
    those whose hash is below ``edge`` or in ``picked``."""

    number: int
    size: int
    target: float
    whole: int
    edge: int = 0
    picked: list[int] = field(default_factory=list)

    @property
    def rest(self) -> float:
        return max(0.0, self.target - self.whole * self.size)

    @property
    def blocks(self) -> int:
        """Blocks of the source's stream: its bins in each pass, as far as the stream goes."""
        full = (self.edge + (1 << 56) - 1) >> 56
        last = max((_unsigned(h) >> 56 for h in self.picked), default=-1) + 1
        return self.whole * BINS + max(full, last)


def _unsigned(h: int) -> int:
    return int(h) & (1 << 64) - 1


def targets(sizes: list[int], weights: tuple[float, ...] = WEIGHTS, cap: float = 3.0) -> list[float]:
    """Shares of the sum of all sizes by repeating weights, each at most ``cap`` times its size.

    What a capped source can't take is shared again by weight among the others.
    """
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    out = [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), float(sum(sizes))
    while open_:
        total = sum(weight[i] for i in open_)
        over = {i for i in open_ if weight[i] / total * left > cap * sizes[i]}
        for i in over or open_:
            out[i] = cap * sizes[i] if over else weight[i] / total * left
        if not over:
            break
        left -= sum(out[i] for i in over)
        open_ -= over
    return out


def split_quotas(blocks: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """(shard, source) numbers of blocks, which add up to ``blocks`` exactly.

    A binary tree over the shards: each node hands its first half of the shards a
    multivariate-hypergeometric draw of its blocks, as large as that half's share.
    """
    out = np.zeros((shards, len(blocks)), np.int64)

    def split(first: int, last: int, have: np.ndarray, node: int) -> None:
        if last - first == 1:
            out[first] = have
            return
        middle = (first + last) // 2
        draw = int(have.sum()) * (middle - first) // (last - first)
        rng = np.random.default_rng([seed, node])
        one = rng.multivariate_hypergeometric(have, draw, method="marginals") if len(have) else have
        split(first, middle, one, 2 * node)
        split(middle, last, have - one, 2 * node + 1)

    split(0, shards, np.asarray(blocks, np.int64), 1)
    return out


def _hash(seed: int, ident: Column) -> Column:
    return F.xxhash64(F.lit(seed), ident)


def _top(h: Column, bits: int) -> Column:
    return F.shiftrightunsigned(h, 64 - bits) if bits else F.lit(0).cast("long")


def quotas(docs: DataFrame, seed: int, weights: tuple[float, ...] = WEIGHTS, cap: float = 3.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> dict[str | None, Quota]:
    """The quota of every source, by sums that are exact.

    A source's documents have an order by a hash of their ids. The place where its quota
    ends is found by descent: a level sums the sizes of 256 bins of hashes and the next
    looks into the one bin in which the quota ends, until that holds few documents; of
    these the largest that fit are picked. The driver sees 256 sums a source and level,
    and no more than ``EDGE_ROWS`` documents a source; more than ``MAX_SOURCES`` sources
    are an error.
    """
    small = docs.select(named(source_col).alias("source"), words(named(text_col)).alias("size"), _hash(seed, named(id_col)).alias("h"))
    small = persist_table(small, "sizes")
    per = small.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    found = per.limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found = sorted(found, key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    goals = targets([r["size"] for r in found], weights, cap)
    plan = {r["source"]: Quota(i, r["size"], t, min(int(cap), int(t / r["size"] + 1e-9)) if r["size"] else 0) for i, (r, t) in enumerate(zip(found, goals))}
    # Sources still open: how many leading bits are known, those bits, and what is left to take.
    open_ = {s: (0, q.rest, found[q.number]["n"]) for s, q in plan.items() if q.rest >= 1}
    spark = docs.sparkSession
    bits = 0
    while open_:
        # From Arrow: a list of rows would start further Python workers on the executors.
        prefixes = pa.array([prefix for prefix, _, _ in open_.values()], pa.int64())
        edges = spark.createDataFrame(pa.table({"edge_source": pa.array(list(open_), pa.string()), "prefix": prefixes}))
        inside = small.join(F.broadcast(edges), small["source"].eqNullSafe(edges["edge_source"]) & (_top(F.col("h"), bits) == edges["prefix"]))
        last = {s for s, (_, _, n) in open_.items() if n <= EDGE_ROWS or bits == 64}
        if last:
            for s, mine in _by_source(_only(inside, last).groupBy("source", "h").agg(F.sum("size").alias("size"))).items():
                left = open_[s][1]
                plan[s].edge = _unsigned(open_[s][0] << (64 - bits))
                over = None
                for h, size in sorted(mine, key=lambda x: (-x[1], _unsigned(x[0]))):
                    if size and size <= left:
                        plan[s].picked.append(h)
                        left -= size
                    elif size:
                        over = (h, size)
                if over and over[1] < 2 * left:  # the smallest that is too large comes nearer
                    plan[s].picked.append(over[0])
            open_ = {s: v for s, v in open_.items() if s not in last}
            continue
        bins = inside.groupBy("source", _top(F.col("h"), bits + 8).alias("bin")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        sums: dict = {}
        for r in bins.collect():
            sums.setdefault(r["source"], []).append((r["bin"], r["size"], r["n"]))
        bits += 8
        for s, (_, left, _) in list(open_.items()):
            for at, size, n in sorted(sums.get(s, []), key=lambda x: _unsigned(x[0])):
                if size > left:
                    open_[s] = (at, left, n)
                    break
                left -= size
            else:  # rounding: all of it fits
                plan[s].edge = (1 << 64) - 1
                del open_[s]
    return plan


def _only(df: DataFrame, sources: set) -> DataFrame:
    names = [s for s in sources if s is not None]
    null = F.col("source").isNull()
    return df.filter(F.coalesce(F.col("source").isin(names), F.lit(False)) | null if None in sources else F.col("source").isin(names))


def _by_source(df: DataFrame) -> dict:
    out: dict = {}
    for r in df.collect():
        out.setdefault(r["source"], []).append((r["h"], r["size"]))
    return out


def words(text: Column) -> Column:
    """Number of words of a text; none for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def placed(docs: DataFrame, shards: int = 16, seed: int = 3, weights: tuple[float, ...] = WEIGHTS, cap: float = 3.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies``, the shard and order of each copy.

    A document's own hash and its source's quota decide its copies, so texts are read
    once and not shuffled. A copy lies in a block: a bin of its source's hashes in one
    pass over the source. ``split_quotas`` gives each shard its number of blocks of each
    source, and a permutation of the source's blocks says which; no block is in two
    shards. ``order`` shuffles the copies within a shard. Rows that repeat a doc_id are
    taken alike. Null ids, texts and sources are values like others. Columns of ``docs``
    with the new names are replaced. An empty table gives no rows.
    """
    plan = quotas(docs, seed, weights, cap, id_col, text_col, source_col)
    by_number = sorted(plan.items(), key=lambda x: x[1].number)
    ends = np.cumsum(split_quotas(np.array([q.blocks for _, q in by_number], np.int64), shards, seed), axis=0)

    @F.pandas_udf("source_size long, target double, copies array<struct<shard: int, order: long>>")
    def place(source: pd.Series, h: pd.Series) -> pd.DataFrame:
        out, shard_of = [], {}
        for s, x in zip(source, h):
            q = plan[None if pd.isna(s) else s]
            if q.number not in shard_of:
                at = permuted(np.arange(q.blocks), q.blocks, seed + q.number)
                shard_of[q.number] = np.searchsorted(ends[:, q.number], at, side="right").tolist()
            unsigned = _unsigned(x)
            once_more = unsigned < q.edge or x in q.picked
            copies = []
            for turn in range(q.whole + once_more):
                shard = shard_of[q.number][turn * BINS + (unsigned >> 56)]
                order = (unsigned * 0x9E3779B97F4A7C15 + turn * 0xD1B54A32D192ED03 + seed) % (1 << 63)
                copies.append({"shard": shard, "order": order})
            out.append((q.size, q.target, copies))
        return pd.DataFrame(out, columns=["source_size", "target", "copies"])

    new = ("size", "source_size", "target", "copies")
    kept = [named(c) for c in docs.columns if c.lower() not in new]
    took = place(named(source_col), _hash(seed, named(id_col)))
    rows = docs.select(*kept, words(named(text_col)).alias("size"), took.alias("copies"))
    return rows.select(*kept, "size", *[F.col("copies").getField(n).alias(n) for n in new[1:]])


def mixed(docs: DataFrame, shards: int = 16, seed: int = 3, **options) -> DataFrame:
    """The mix itself: a row per copy, with ``mix_shard``, sorted within shards by the local shuffle."""
    rows = placed(docs, shards, seed, **options)
    kept = [named(c) for c in rows.columns if c not in ("size", "source_size", "target", "copies", "mix_shard", "mix_order")]
    # After a plain explode Spark filters for non-empty copies ahead, which calls place twice, with two workers a task.
    copies = rows.select(*kept, F.explode_outer("copies").alias("copies")).filter(F.col("copies").isNotNull())
    copies = copies.select(*kept, F.col("copies.shard").alias("mix_shard"), F.col("copies.order").alias("mix_order"))
    # Ranges of (shard, order): as many tasks as the data needs, and the order within a shard holds.
    return copies.repartitionByRange("mix_shard", "mix_order").sortWithinPartitions("mix_shard", "mix_order")
