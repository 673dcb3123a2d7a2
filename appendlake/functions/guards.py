"""Row predicates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appendlake.config import GUARD_COLUMNS, LAST_DATE


def in_list_or_all(column: Column, values: Sequence[str]) -> Column:
    """Membership, where an empty list means every value."""
    return column.isin(list(values)) if values else F.lit(True)


def date_condition(
    df: DataFrame,
    columns: Sequence[str] = GUARD_COLUMNS,
    last_date: str = LAST_DATE,
    stored: bool = True,
) -> Column:
    """Dates that are null or not after ``last_date``, in every column present.

    ``to_date(c) <= d`` is written as ``c < d + 1 day`` with the literal in the
    column's own type, so the comparison reaches a parquet scan as a filter. A
    column that is computed, not ``stored``, is named once only, since a filter
    runs below the computation and repeats it for each mention.
    """
    after = (dt.date.fromisoformat(last_date) + dt.timedelta(days=1)).isoformat()
    tests = []
    for name in columns:
        if name in df.columns:
            early = F.col(name) < F.lit(after).cast(df.schema[name].dataType)
            tests.append(F.col(name).isNull() | early if stored else F.coalesce(early, F.lit(True)))
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def date_guard(
    df: DataFrame,
    columns: Sequence[str] = GUARD_COLUMNS,
    last_date: str = LAST_DATE,
    stored: bool = True,
) -> DataFrame:
    return df.where(date_condition(df, columns, last_date, stored))
