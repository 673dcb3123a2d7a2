"""Scratch space shared by all executors, and the task count for byte-sized work."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

MAX_TASKS = 20_000


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may run without that setting: it then gets a folder of
    its own. On a cluster a machine-local folder would be invisible to others.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="appendlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def persist_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage and fixes the rows: later jobs see the same values even if
    an executor is lost and a task runs again.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def discard(table: DataFrame) -> None:
    """Remove the files of a ``persist_table`` that nothing will read again."""
    spark = table.sparkSession
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def persist_counted(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict[str, int]]:
    """``persist_table``, and integer metrics of the rows, which the write itself takes."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    table = persist_table(df.observe(seen, *[m.alias(k) for k, m in metrics.items()]), name)
    return table, dict.fromkeys(metrics, 0) | metrics_of(seen, table)


def metrics_of(seen: Observation, written: DataFrame | None = None) -> dict[str, int]:
    """Observed sums and counts after the action.

    An observation that failed is an error, unless what was ``written`` shows that there
    was no row to observe.
    """
    try:
        return {name: int(value or 0) for name, value in seen.get.items()}
    except Py4JJavaError:
        if written is None or not written.isEmpty():
            raise
        return {}


def task_count(units: int) -> int:
    """One task per unit of work; beyond the limit a task takes several units."""
    return max(1, min(units, MAX_TASKS))
