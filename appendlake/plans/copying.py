"""Copy job: list, compare with the log, copy the new ranges, log them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appendlake.config import LakeConfig
from appendlake.operators import growth, ledger, ranges
from appendlake.session import persist_table
from appendlake.sources.listing import list_files


def copy_growth(
    spark: SparkSession,
    config: LakeConfig,
    entities: Sequence[str],
    run_ts: dt.datetime | None = None,
    max_tasks: int | None = None,
) -> DataFrame:
    """Copy the new ranges of all entities and return this run's log rows."""
    ledger.ensure_logs(spark, config)
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc)
    plan = growth.plan(
        list_files(spark, config.source_root, entities).drop("modified_at"),
        ledger.file_state(spark, config, entities),
    )
    plan = growth.marked(persist_table(plan, "growth"))
    ledger.append(ranges.copy(plan, config, run_ts, max_tasks), config.copies)
    return spark.table(config.copies).where(F.col("run") == F.lit(run_ts))


def growth_report(spark: SparkSession, config: LakeConfig, entities: Sequence[str], audit: bool = False) -> DataFrame:
    """Every listed file with ``status`` grown, same, shrunk or rewritten. Nothing is copied.

    Rewritten files are known by the last bytes that were copied; with ``audit`` all
    copied bytes are read again and compared with the checksums of the log.
    """
    ledger.ensure_logs(spark, config)
    rows = growth.compare(list_files(spark, config.source_root, entities), ledger.file_state(spark, config, entities))
    if audit:
        rows = rows.join(ledger.checksums(spark, config, entities), "path", "left")
    rows = growth.marked(persist_table(rows, "growth"), whole=audit)
    changed = F.col("rewritten") & (F.col("status") != growth.SHRUNK)
    return rows.withColumn("status", F.when(changed, growth.REWRITTEN).otherwise(F.col("status"))).drop("rewritten", "tail", "crc")
