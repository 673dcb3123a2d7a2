"""Load job: read the pending range files of an entity, write them, log the load."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appendlake.config import DEFAULT_LANGUAGE, GUARD_COLUMNS, LakeConfig
from appendlake.functions.guards import date_condition, date_guard
from appendlake.operators import ledger
from appendlake.operators.labels import enrich, quoted
from appendlake.session import metrics_of, persist_counted, task_count
from appendlake.sinks import Sink
from appendlake.sources import records
from appendlake.sources.files import literal
from appendlake.sources.options import Patch, read_labels

LISTED_FILES = 1000
FILES_PER_TASK = 500


def read_entity(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType,
    guard_columns: Sequence[str] = GUARD_COLUMNS,
) -> DataFrame:
    """Rows of range files with their file columns, without dates beyond the cutoff."""
    return date_guard(records.read(spark, paths, schema), guard_columns, stored=False)


def load_entity(
    spark: SparkSession,
    config: LakeConfig,
    entity: str,
    schema: T.StructType,
    sink: Sink,
    mode: str = ledger.APPEND,
    **options,
) -> DataFrame:
    """Load the pending files of one entity and return the log rows; none without files.

    ``options`` are those of ``load_rows``.
    """
    ledger.ensure_logs(spark, config)
    log_finished(spark, config, entity, sink)
    files = ledger.pending(spark, config, entity, mode)
    return load_files(spark, config, files, entity, schema, sink, mode, **options)


def log_finished(spark: SparkSession, config: LakeConfig, entity: str, sink: Sink, load_ids: Sequence[str] | None = None) -> bool:
    """Log the loads whose rows are in a marked table, but whose driver died before it said so.

    Without ``load_ids`` these are looked for among all that named their files. Their
    files are then no longer pending. How many rows were malformed is not known any more.
    """
    if not getattr(sink, "mark", None):
        return False
    now = dt.datetime.now(dt.timezone.utc)
    found = sink.loads_in(spark, entity, ledger.begun(spark, config) if load_ids is None else load_ids)
    for load_id, rows in sorted(found.items()):
        number = ledger.take_number(spark, config, entity)
        place = f"{sink.schema}.{quoted(entity)}"
        row = (load_id, number, now, None, now, entity, ledger.APPEND, sink.destination_type, place, True, rows, None, "{}", [])
        ledger.append(spark.createDataFrame([row], ledger.LOADS).coalesce(1), config.loads)
    return bool(found)


def load_files(
    spark: SparkSession,
    config: LakeConfig,
    files: DataFrame,
    entity: str,
    schema: T.StructType,
    sink: Sink,
    mode: str,
    **options,
) -> DataFrame:
    """Read range files, write their rows to the sink, log the load; the options are those of ``load_rows``.

    Up to ``LISTED_FILES`` paths are handed to Spark's own reader. More files are read from
    the table that holds them, so the driver never gets a longer list; the rows are the same.
    """
    files, seen = persist_counted(files.select("target", "bytes"), f"{entity}-files", n=F.count(F.lit(1)), size=F.sum("bytes"))
    if not seen["n"]:
        return spark.createDataFrame([], ledger.LOADS)
    if seen["n"] <= LISTED_FILES:
        paths = [literal(r[0]) for r in files.select("target").collect()]
        every = records.read(spark, paths, schema, keep_corrupt=True)
    else:
        tasks = task_count(max(-(-seen["size"] // config.chunk_bytes), seen["n"] // FILES_PER_TASK))
        every = records.read_listed(files, schema, tasks, keep_corrupt=True)
    return load_rows(spark, config, every, entity, sink, mode, files=files, **options)


def load_rows(
    spark: SparkSession,
    config: LakeConfig,
    every: DataFrame,
    entity: str,
    sink: Sink,
    mode: str,
    files: DataFrame | None = None,
    load_id: str | None = None,
    with_labels: bool = False,
    language: int = DEFAULT_LANGUAGE,
    patch: Patch | None = None,
    guard_columns: Sequence[str] = GUARD_COLUMNS,
    run_ts: dt.datetime | None = None,
    update_log: bool = True,
) -> DataFrame:
    """Write rows read with ``keep_corrupt`` to the sink and log the load.

    The number of rows is taken from what was written, so it needs no plan to stay whole.
    The files are named in ``load_files`` first. The one row of ``loads``, written last by one task as one file, is what makes the load
    count: if the run dies before it, the next run reads the same files again and the
    folder written so far is never looked at. A load whose rows were all filtered away is
    logged too, so that its files are not read again.
    """
    started = dt.datetime.now(dt.timezone.utc)
    run_ts = run_ts or started
    if load_id and log_finished(spark, config, entity, sink, [load_id]):
        return ledger.log(spark, config.loads).where(ledger.is_load(load_id))
    load_id = load_id or uuid.uuid4().hex
    number = ledger.take_number(spark, config, entity)
    seen = Observation(f"load-{uuid.uuid4().hex}")
    keep = date_condition(every, guard_columns)
    # The counting stands between parsing and filter, so each value is parsed once:
    # a filter right after the parsing would move below it and parse again.
    bad = F.count_if(keep & F.col(records.CORRUPT)).alias("bad")
    rows = every.observe(seen, bad).where(keep).drop(records.CORRUPT)
    if with_labels:
        rows = enrich(rows, read_labels(spark, config.option_path(entity), entity, language, patch))
    if getattr(sink, "mark", None):
        rows = rows.withColumn(sink.mark, F.lit(load_id))
    if update_log and files is not None:
        ledger.append(files.select(F.lit(load_id).alias("load_id"), "target"), config.load_files)
    written = sink.write(rows, entity, mode, run_ts, number)
    # Without rows there is no bad one, and Spark may have dropped the plan with the counter.
    bad_rows = metrics_of(seen)["bad"] if written.rows else 0
    row = (
        load_id, number, run_ts, started, dt.datetime.now(dt.timezone.utc), entity, mode, sink.destination_type,
        written.destination, written.rows > 0, written.rows, bad_rows, written.layout(), written.buckets,
    )
    load = spark.createDataFrame([row], ledger.LOADS).coalesce(1)
    if update_log:
        ledger.append(load, config.loads)
    return load


def load_entities(
    spark: SparkSession,
    config: LakeConfig,
    schemas: Mapping[str, T.StructType],
    sink: Sink,
    mode: str = ledger.APPEND,
    at_once: int = 4,
    load: Callable[..., DataFrame] = load_entity,
    **options,
) -> DataFrame:
    """Load several entities, a few at a time, and return all their log rows.

    Small entities do not fill a cluster, so their jobs run side by side in
    scheduler pools of their own. Each entity is logged by itself; errors are
    raised together after all have been tried.
    """

    def one(name: str) -> DataFrame:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"load-{name}")
        try:
            return load(spark, config, name, schemas[name], sink, mode, **options)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    logs, errors = [], []
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(one), name) for name in schemas]
        for future in futures:
            try:
                logs.append(future.result())
            except Exception as problem:
                errors.append(problem)
    if errors:
        raise ExceptionGroup("some entities were not loaded", errors)
    result = spark.createDataFrame([], ledger.LOADS)
    for log in logs:
        result = result.unionByName(log)
    return result
