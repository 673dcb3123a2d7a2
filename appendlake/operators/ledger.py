"""What this engine remembers: copies, loads, and the files of each load.

``copies`` has a row per range that was tried. ``loads`` has one row per load, and that
row, a single file, makes the load count. ``load_files`` has a row per load and file; it
is written first, and rows without their load mean nothing.

The loads of an entity are ordered by ``number``, which no clock decides and no two
drivers can both take.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appendlake.config import LakeConfig
from appendlake.functions.guards import in_list_or_all
from appendlake.operators.sets import absent_from
from appendlake.sources import prints
from appendlake.sources.files import create_once

_one_append_at_a_time = threading.Lock()

APPEND, FULL, UPSERT = "append", "full", "upsert"
MODES = (APPEND, FULL, UPSERT)
DONE = "done"

TEXT, NUMBER, TIME = T.StringType(), T.LongType(), T.TimestampType()


def _columns(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


COPIES = _columns(path=TEXT, start=NUMBER, stop=NUMBER, target=TEXT, entity=TEXT, run=TIME, outcome=TEXT, crc=NUMBER, tail=TEXT)
LOADS = _columns(
    load_id=TEXT, number=NUMBER, run=TIME, started=TIME, ended=TIME, entity=TEXT, mode=TEXT, kind=TEXT, place=TEXT,
    live=T.BooleanType(), rows_in=NUMBER, rows_bad=NUMBER, layout=TEXT, replaced=T.ArrayType(T.IntegerType()),
)
LOAD_FILES = _columns(load_id=TEXT, target=TEXT)


def check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is not one of {', '.join(MODES)}")


def ensure_logs(spark: SparkSession, config: LakeConfig) -> None:
    """Create the schema and the tables where they are missing.

    With ``log_root`` the tables live there, and a new session finds them again
    whatever its catalog remembers.
    """
    place = f" LOCATION '{config.log_root}'" if config.log_root else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {config.log_schema}{place}")
    for name, schema in ((config.copies, COPIES), (config.loads, LOADS), (config.load_files, LOAD_FILES)):
        if not spark.catalog.tableExists(name):
            place = ""
            if config.log_root:
                place = f" LOCATION '{config.log_root}/{name.rsplit('.', 1)[1]}'"
            spark.sql(f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet{place}")
        known = [c.name for c in spark.catalog.listColumns(name)]
        added = T.StructType([f for f in schema.fields if f.name not in known])
        if added.fields:  # a log of an earlier version
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added.toDDL()})")


def log(spark: SparkSession, name: str) -> DataFrame:
    """A log table as it is now: another session, a stream's for one, may have added rows."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def is_load(load_id: str) -> Column:
    return F.col("load_id") == load_id


def take_number(spark: SparkSession, config: LakeConfig, entity: str) -> int:
    """The number of a new load, above those of all logged ones.

    A number is taken by making its file, which must not be there yet; the numbers of
    loads that died stay unused. So numbers follow the order in which loads began.
    """
    own = log(spark, config.loads).where(F.col("entity") == entity)
    last = own.agg(F.max("number")).first()[0] or 0
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {config.loads}").where("col_name = 'Location'").first()["data_type"]
    while not create_once(spark, f"{place}/_numbers/{entity}/{last + 1:012d}"):
        last += 1
    return last + 1


def append(rows: DataFrame, table: str) -> None:
    """Append by column name. An empty relation adds nothing.

    Two writes into one parquet folder at the same time remove each other's
    temporary files, so the loads of one driver take turns here.
    """
    columns = rows.sparkSession.table(table).columns
    with _one_append_at_a_time:
        rows.select(*columns).write.insertInto(table)


def file_state(spark: SparkSession, config: LakeConfig, entities: Sequence[str] = ()) -> DataFrame:
    """Last copied byte per source file; failed copies do not count."""
    return state_of(log(spark, config.copies).where(in_list_or_all(F.col("entity"), entities)))


def state_of(copies: DataFrame) -> DataFrame:
    """(``path``, ``stop``[, ``tail``]): the bytes only grow, so the largest end counts, whatever the clocks said."""
    done = copies.where(F.col("outcome") == DONE)
    tail = [F.max_by("tail", "stop").alias("tail")] if "tail" in copies.columns else []
    return done.groupBy("path").agg(F.max("stop").alias("stop"), *tail)


def checksums(spark: SparkSession, config: LakeConfig, entities: Sequence[str] = ()) -> DataFrame:
    """(``path``, ``crc``): CRC-32 of all copied bytes of each file, put together from its ranges' own.

    Null where a range was logged without one. A file's ranges meet in one task, as three numbers each.
    """
    done = log(spark, config.copies).where(in_list_or_all(F.col("entity"), entities) & (F.col("outcome") == DONE))
    ranges = F.sort_array(F.collect_set(F.struct("start", "stop", F.coalesce("crc", F.lit(-1)).alias("crc"))))

    @F.pandas_udf("bigint")
    def together(all_ranges: pd.Series) -> pd.Series:
        return pd.Series([_together(r) for r in all_ranges], dtype="Int64")

    return done.groupBy("path").agg(ranges.alias("ranges")).select("path", together("ranges").alias("crc"))


def _together(ranges: Sequence[dict]) -> int | None:
    parts, at = [], 0
    for r in ranges:
        if r["crc"] < 0 or r["start"] != at:
            return None
        parts.append((int(r["crc"]), int(r["stop"] - r["start"])))
        at = r["stop"]
    return prints.combined(parts)


def available(spark: SparkSession, config: LakeConfig, entity: str) -> DataFrame:
    """Range files that were copied whole, each once: ``target`` and its ``bytes``."""
    own = (F.col("entity") == entity) & (F.col("outcome") == DONE)
    return log(spark, config.copies).where(own).groupBy("target").agg(F.max(F.col("stop") - F.col("start")).alias("bytes"))


def loaded(spark: SparkSession, config: LakeConfig, entity: str) -> DataFrame:
    """Range files of the entity's loads, one row per load and file."""
    loads = log(spark, config.loads).where(F.col("entity") == entity).select("load_id")
    return log(spark, config.load_files).join(loads, "load_id", "left_semi").select("target")


def begun(spark: SparkSession, config: LakeConfig) -> list[str]:
    """Ids of loads that named their files and were not logged: they run now, or died."""
    ids = log(spark, config.load_files).select("load_id").distinct()
    return [r[0] for r in absent_from(ids, log(spark, config.loads).select("load_id"), ["load_id"]).collect()]


def pending(spark: SparkSession, config: LakeConfig, entity: str, mode: str = APPEND) -> DataFrame:
    """Range files a load has to read: the ones not loaded yet, or all of them for a full load."""
    check_mode(mode)
    files = available(spark, config, entity)
    if mode == FULL:
        return files
    return absent_from(files, loaded(spark, config, entity), ["target"])
