"""Set differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` minus rows of ``right`` by position, where copies count and null equals null."""
    return left.exceptAll(right.toDF(*left.columns))


def absent_from(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key occurs nowhere in ``right``; a null key occurs nowhere.

    The keys of ``right`` are made distinct first, so a key that is repeated very
    often there does not travel to one task with all its copies.
    """
    return left.join(right.select(*keys).distinct(), list(keys), "left_anti")
