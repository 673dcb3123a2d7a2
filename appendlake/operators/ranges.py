"""Copy byte ranges of growing files to new files, on the executors."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appendlake.config import MIB, LakeConfig
from appendlake.functions import paths
from appendlake.operators.ledger import COPIES, DONE
from appendlake.session import MAX_TASKS, persist_counted, task_count
from appendlake.sources import pieces, prints
from appendlake.sources.files import copy_bytes

SCAN_BYTES = 16 * MIB

# Outcomes of a range that was not copied; any other one is the error of its task.
NEGATIVE_OFFSET = "the range begins before the file"
EMPTY_RANGE = "the range has no bytes"
AFTER_ERROR = "an earlier part of this file failed"
REWRITTEN = "the bytes before the range are not those that were copied"

# What a task reports: a row of the log but for the run.
TRIED = T.StructType([f for f in COPIES.fields if f.name != "run"])


def copy(
    plan: DataFrame, config: LakeConfig, run_ts: dt.datetime, max_tasks: int | None = None
) -> DataFrame:
    """Planned ranges (``entity``, ``path``, ``start``, ``stop``[, ``rewritten``]) → rows of ``copies``.

    A range ends at its last complete record; what follows is left for the next
    run. A range longer than ``chunk_bytes`` becomes several files, each ending
    at a record end, so that neither this copy nor a later read of it has one
    task for a huge file. After a failure the later parts of the same file count
    as failed too: the logged ``stop`` only ever covers what was copied. A file that was
    rewritten is not continued.

    Copying happens when the result is evaluated; write it to the log once.
    """
    length = F.col("stop") - F.col("start")
    fault = F.when(F.col("start") < 0, NEGATIVE_OFFSET).when(length <= 0, EMPTY_RANGE)
    if "rewritten" in plan.columns:
        fault = fault.when(F.col("rewritten"), REWRITTEN)
    wanted = plan.select("entity", "path", "start", "stop", fault.alias("outcome"), (length > config.chunk_bytes).alias("is_long"))
    # Sizes are taken once: the files keep growing while the copy runs.
    sound = F.col("outcome").isNull()
    chunks = F.ceil(length / config.chunk_bytes).cast("bigint")
    wanted, seen = persist_counted(
        wanted, "range-plan", short=F.count_if(sound & ~F.col("is_long")), chunks=F.sum(F.when(sound & F.col("is_long"), chunks))
    )

    def tasks(units: int) -> int:
        return min(task_count(units), max_tasks or MAX_TASKS)

    # A short range is trimmed and copied by one task.
    short = wanted.where(sound & ~F.col("is_long")).withColumns({"target": _target(config, run_ts), "trim": F.lit(True)})
    tried = _copied(short.repartition(tasks(seen["short"])), config)
    if seen["chunks"]:
        parts, counts = _parts(wanted.where(sound & F.col("is_long")), config, run_ts, seen["chunks"])
        tried = tried.unionByName(_copied(parts.repartition(tasks(counts["parts"])), config))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    failed_before = F.max(F.col("outcome") != DONE).over(before)
    tried = tried.withColumn("outcome", F.when((F.col("outcome") == DONE) & failed_before, AFTER_ERROR).otherwise(F.col("outcome")))
    every = tried.unionByName(wanted.where(~sound).drop("is_long"), allowMissingColumns=True)
    return every.withColumn("run", F.lit(run_ts).cast("timestamp")).select(*COPIES.names)


def _target(config: LakeConfig, run_ts: dt.datetime) -> Column:
    """Name of a range file: stem, UTC time of the run and first byte, so that no other
    range of a file has it, whatever the session's zone and however quick the runs."""
    moment = run_ts if run_ts.tzinfo else run_ts.replace(tzinfo=dt.timezone.utc)
    stamp = moment.astimezone(dt.timezone.utc).strftime("%Y%m%d%H%M%S")
    folder = F.concat(F.lit(config.range_root + "/"), "entity", F.lit("/"))
    number = F.lpad(F.col("start").cast("string"), 15, "0")
    # The path's hash keeps apart two files that differ in their extension only.
    same_stem = F.lower(F.hex(F.xxhash64("path")))
    name = F.concat_ws("_", paths.stem(F.col("path")), same_stem, F.lit(stamp), number)
    return F.concat(folder, name, F.lit(".csv"))


def _parts(
    ranges: DataFrame, config: LakeConfig, run_ts: dt.datetime, chunks: int
) -> tuple[DataFrame, dict[str, int]]:
    """Long ranges cut at record ends, one row per file to make; the cuts are fixed by a table."""
    found = pieces.cut(
        ranges.select("entity", F.col("path").alias("source_path"), F.col("start").alias("range_start"), F.col("stop").alias("range_end")),
        config.chunk_bytes,
        min(config.block_bytes, SCAN_BYTES),
        keep_tail=False,
        keep_errors=True,
        carry=["entity"],
        chunks_known=chunks,
    )
    cut = found.select(
        "entity", F.col("source_path").alias("path"), F.col("piece_start").alias("start"), F.col("piece_end").alias("stop"),
        F.col("error").alias("outcome"), F.lit(False).alias("trim"),
    )
    return persist_counted(cut.withColumn("target", _target(config, run_ts)), "copy-plan", parts=F.count(F.lit(1)))


def _copied(files: DataFrame, config: LakeConfig) -> DataFrame:
    """Copy each row's bytes. A row to trim that holds no complete record yields no row."""
    block_bytes = config.block_bytes
    scan_bytes = min(block_bytes, SCAN_BYTES)

    def try_one(row: dict) -> dict | None:
        trim = row.pop("trim")
        row |= {"crc": None, "tail": None}
        if row["outcome"] is not None:  # its cuts could not be found
            return row
        try:
            if trim:
                row["stop"] = pieces.complete_end(row["path"], row["start"], row["stop"], scan_bytes)
                if row["stop"] is None:
                    return None
            row["crc"] = copy_bytes(row["path"], row["target"], row["start"], row["stop"], block_bytes)
            row["tail"] = prints.tail(row["path"], row["stop"])
            row["outcome"] = DONE
        except Exception as problem:
            row["outcome"] = repr(problem)
        return row

    def try_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [r for r in map(try_one, batch.to_dict("records")) if r is not None]
            yield pd.DataFrame(done, columns=TRIED.names, dtype=object)

    return files.select("entity", "path", "start", "stop", "target", "outcome", "trim").mapInPandas(try_all, TRIED)
