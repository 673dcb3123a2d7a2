"""How the operators of this folder take columns and tables."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column of exactly this name, whatever characters the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextlib.contextmanager
def memory_returned() -> Iterator[None]:
    """Gives freed memory back to the system at the end of a task.

    A Python worker serves one task after another, and what its allocators keep would
    stand beside the needs of the next stage.
    """
    try:
        yield
    finally:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)
