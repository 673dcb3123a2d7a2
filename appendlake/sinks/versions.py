"""A table made of runs, where an upsert rewrites only the buckets it touches.

Each run writes ``<root>/<entity>/lake_run=<stamp>/lake_bucket=<n>/``; a row's bucket is a
hash of its key. The load log is the list of valid runs: a folder without a log
row, left by a run that died, is never read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appendlake.config import KEY_COLUMNS, LakeConfig
from appendlake.operators.ledger import FULL, UPSERT
from appendlake.operators.merge import bucket_of, merge
from appendlake.session import persist_table
from appendlake.sinks import history
from appendlake.sinks.run_folders import Written, run_stamp, written_rows
from appendlake.sources.files import literal

# Folder columns; named so that an entity has none of the same name.
BUCKET, RUN = "lake_bucket", "lake_run"


class VersionedSink:
    destination_type = "TABLE"

    def __init__(self, config: LakeConfig, keys: Sequence[str] = KEY_COLUMNS) -> None:
        self.config = config
        self.keys = list(keys)

    def write(self, df: DataFrame, entity: str, mode: str, run_ts: dt.datetime, number: int) -> Written:
        spark = df.sparkSession
        known = [k for k in self.keys if k in df.columns]
        keys = known if len(known) == len(self.keys) else []
        if mode == UPSERT and not keys:
            raise ValueError(f"upsert needs the key columns {', '.join(self.keys)}")
        live = live_runs(spark, self.config, entity) if mode != FULL else []
        # A table keeps the bucket count and the keys of its first run, whatever the config says now.
        count = live[0]["bucket_count"] if live else self.config.bucket_count
        if live and live[0]["keys"] != keys:
            raise ValueError(f"{entity} is bucketed by {live[0]['keys'] or 'all columns'}, not by {keys or 'all columns'}")
        history.refuse_type_change(live, df.schema, keys)
        rows, touched, kept = df.withColumn(BUCKET, bucket_of(keys or df.columns, count)), [], None
        if live and mode == UPSERT:
            # The source is used several times, so it is parsed once and staged.
            rows = persist_table(rows, f"{entity}-source")
            kept = rows.count()
            touched = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())
            target = _scan(spark, self.config, entity, live).where(F.col(BUCKET).isin(touched))
            merged = merge(target.drop(RUN, BUCKET), rows.drop(BUCKET), self.keys)
            rows = merged.withColumn(BUCKET, bucket_of(self.keys, count))
        run_id = run_stamp(run_ts, number)
        destination = f"{self.config.table_root}/{entity}/{RUN}={run_id}"
        # Rebalancing makes files of even size per bucket and splits a large bucket.
        rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(destination)
        schema = rows.drop(BUCKET).schema
        if kept is None:
            kept = written_rows(spark, destination, schema)
        return Written(destination, run_id, schema, touched, count, keys, kept)


def live_runs(spark: SparkSession, config: LakeConfig, entity: str) -> list[dict]:
    """Runs that still hold rows of the table, oldest first, with the buckets each has lost (``gone``)."""
    replaced: set[int] = set()
    kept = []
    for run in reversed(history.runs(spark, config, entity, VersionedSink.destination_type)):
        kept.append(run | {"gone": sorted(replaced)})
        if run["mode"] == UPSERT:
            replaced |= set(run["replaced"])
    return [k for k in reversed(kept) if len(k["gone"]) < k["bucket_count"]]


def _scan(spark: SparkSession, config: LakeConfig, entity: str, live: list[dict]) -> DataFrame:
    """The live part of the runs; both conditions are on folder names and prune the listing."""
    base = f"{config.table_root}/{entity}"
    # Runs that lost the same buckets share one condition, so there are at most
    # as many conditions as buckets.
    by_gone: dict[tuple, list[str]] = {}
    for run in live:
        by_gone.setdefault(tuple(run["gone"]), []).append(run["run_id"])
    condition = F.lit(False)
    for gone, runs in by_gone.items():
        own = F.col(RUN).isin(runs)
        condition = condition | (own & ~F.col(BUCKET).isin(list(gone)) if gone else own)
    schema = T.StructType(
        [*history.columns(live).fields, T.StructField(RUN, T.StringType()), T.StructField(BUCKET, T.IntegerType())]
    )
    return (
        spark.read.schema(schema)
        .option("basePath", base)
        .parquet(*[literal(f"{base}/{RUN}={run['run_id']}") for run in live])
        .where(condition)
    )


def current(spark: SparkSession, config: LakeConfig, entity: str) -> DataFrame:
    """The table as of the last logged load; columns of all live runs, null where a run lacks one."""
    live = live_runs(spark, config, entity)
    if not live:
        raise LookupError(f"no load of {entity!r} is logged")
    return _scan(spark, config, entity, live).drop(RUN, BUCKET)


def current_run_folders(spark: SparkSession, config: LakeConfig, entity: str) -> DataFrame:
    """Rows of the run folder sink: the last full run and the appends after it."""
    live = history.runs(spark, config, entity, "PATH")
    if not live:
        raise LookupError(f"no load of {entity!r} is logged")
    return spark.read.schema(history.columns(live)).parquet(*[literal(r["place"]) for r in live])
