"""Reproducible shuffle and sharding by a permutation of row numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from appendlake.session import persist_table

ROUNDS = 6


def numbered(df: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """(``row`` struct of ``df``'s columns, ``at`` from 0 in ``order``) and the number of rows.

    One range shuffle sorts the rows. Each partition numbers its own; the partitions'
    sizes, one row per partition, give each partition its offset. Rows that are equal in
    ``order`` get neighbouring numbers in any order, so order by enough columns.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id holds the partition above 33 bits of the row's place in the partition.
    local = persist_table(ordered.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("id")), "numbered")
    part = F.shiftright("id", 33)
    sizes = local.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset"), "n")
    offsets = persist_table(offsets, "offsets")
    total = offsets.agg(F.sum("n")).first()[0] or 0
    joined = local.join(F.broadcast(offsets), part == offsets["part"])  # a row per partition
    return joined.select("row", (F.col("offset") + F.col("id").bitwiseAND(F.lit((1 << 33) - 1))).alias("at")), total


def permuted(at: np.ndarray, total: int, seed: int) -> np.ndarray:
    """Where a Feistel network over [0, total) sends each number.

    The network permutes the next power of four; what falls outside walks on along its
    cycle until it is inside, which takes fewer than four steps on average.
    """
    return _walk(at, total, seed, range(ROUNDS), _forward)


def original(place: np.ndarray, total: int, seed: int) -> np.ndarray:
    """The number that ``permuted`` sends to each place."""
    return _walk(place, total, seed, range(ROUNDS - 1, -1, -1), _backward)


def _walk(x: np.ndarray, total: int, seed: int, rounds: range, step) -> np.ndarray:
    x = np.array(x, np.uint64)
    if total <= 1:
        return x.astype(np.int64)
    half = np.uint64((int(total - 1).bit_length() + 1) // 2)
    left = np.arange(len(x))
    while len(left):
        a, b = x[left] >> half, x[left] & np.uint64((1 << int(half)) - 1)
        for i in rounds:
            a, b = step(a, b, _scrambled(seed, i, half))
        x[left] = (a << half) | b
        left = left[x[left] >= total]
    return x.astype(np.int64)


def _forward(a, b, f):
    return b, a ^ f(b)


def _backward(a, b, f):
    return b ^ f(a), a


def _scrambled(seed: int, i: int, half: np.uint64):
    key = np.uint64((seed * 0x9E3779B97F4A7C15 + (i + 1) * 0xD1B54A32D192ED03) % (1 << 64))

    def f(x: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            z = (x ^ key) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            return (z ^ (z >> np.uint64(32))) & np.uint64((1 << int(half)) - 1)

    return f


def sharded(df: DataFrame, order: list[str], shards: int = 16, seed: int = 20) -> DataFrame:
    """``df`` with ``shard`` and ``slot``: row counts of shards differ by one at most.

    Row number r goes to place p = ``permuted``(r): shard p mod shards, slot p div shards.
    So a place can be computed from a row number and back (``original``), without the
    table. Columns of ``df`` called shard or slot are replaced. Nulls sort first; an
    empty table gives no rows.
    """
    rows, total = numbered(df, order)

    @F.pandas_udf("long")
    def place(at: pd.Series) -> pd.Series:
        return pd.Series(permuted(at.to_numpy(), total, seed))

    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    fields = [F.col("row").getField(c).alias(c) for c in kept]
    at = rows.select("row", place("at").alias("at"))
    return at.select(*fields, (F.col("at") % shards).cast("int").alias("shard"), F.floor(F.col("at") / shards).alias("slot"))
