"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str], tie: Sequence[str] = ()
) -> DataFrame:
    """The row with the greatest ``newest`` columns per key; ``tie`` columns decide between equals.

    The filter on the row number lets Spark keep one row per key and task before
    the shuffle, so a key with very many rows sends only one row per task.
    """
    order = [F.col(c).desc() for c in (*newest, *tie)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
