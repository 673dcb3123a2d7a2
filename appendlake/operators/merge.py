"""Merge rows into a table by key: update what matches, insert the rest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appendlake.operators.labels import quoted

DUPLICATE_MATCH = "several source rows match one target row"


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows after the merge.

    A matched target row takes every column of the source and keeps the columns
    only it has. A source row without a match is inserted. A null in a key
    matches nothing. Two source rows for one target row are an error; without a
    target row both are inserted.

    One full outer join of the target with the source, reduced to a row and a count
    per key before its shuffle: two scans and two shuffles. Keys that the source
    repeats, null ones among them, are looked for first, by one job over the source; only if there are any
    does a second branch insert their rows.
    """
    keys = list(keys)
    named = lambda c: F.col(quoted(c))
    new = [c for c in source.columns if c not in target.columns]
    key_columns = [named(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    rows = F.struct(*[named(c) for c in source.columns])
    by_key = source.groupBy(*key_columns).agg(F.count(F.lit(1)).alias("_n"), F.first(rows).alias("_s"))
    held = target.select(F.struct(*[named(c) for c in target.columns]).alias("_t"), *[named(k).alias(f"_t{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [F.col(f"_t{i}") == F.col(f"_k{i}") for i in range(len(keys))])
    joined = held.join(by_key, same, "full_outer")
    in_target, repeated = F.col("_t").isNotNull(), F.coalesce(F.col("_n") > 1, F.lit(False))
    error = F.raise_error(F.lit(DUPLICATE_MATCH)).cast("boolean")
    joined = joined.where(F.when(in_target & repeated, error).otherwise(~repeated))
    updated = F.col("_s").isNotNull()

    def after(name: str) -> Column:
        own = F.col("_t").getField(name) if name in target.columns else F.lit(None)
        if name not in source.columns:
            return own.alias(name)
        return F.when(updated, F.col("_s").getField(name)).otherwise(own).alias(name)

    result = joined.select(*[after(c) for c in [*target.columns, *new]])
    again = by_key.where("_n > 1").select(*[F.col(f"_k{i}") for i in range(len(keys))])
    if again.isEmpty():
        return result
    key_of = reduce(lambda a, b: a & b, [named(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return result.unionByName(source.join(again, key_of, "left_semi"), allowMissingColumns=True)


def bucket_of(columns: Sequence[str], count: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in columns]), F.lit(count)).cast("int")
