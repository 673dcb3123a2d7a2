"""A table of the session's catalog, for formats that have their own MERGE."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appendlake.config import KEY_COLUMNS
from appendlake.operators.labels import quoted
from appendlake.operators.ledger import FULL, UPSERT
from appendlake.session import persist_table
from appendlake.sinks.run_folders import Written, run_stamp


class CatalogTableSink:
    """Writes ``<schema>.<entity>`` in a table format the session knows.

    The format decides what it allows: parquet takes appends of the same columns and
    full loads, and refuses a merge. Each row carries the id of the load that wrote it
    (``mark``): a load that died after its rows were committed and before it was logged is
    known by it, and not made again. As far as the format commits a write as a whole,
    no load adds rows twice.
    """

    destination_type = "CATALOG"
    mark = "_load_id"

    def __init__(self, schema: str, provider: str, keys: Sequence[str] = KEY_COLUMNS) -> None:
        self.schema = schema
        self.provider = provider
        self.keys = list(keys)

    def write(self, df: DataFrame, entity: str, mode: str, run_ts: dt.datetime, number: int) -> Written:
        spark, name = df.sparkSession, f"{self.schema}.{quoted(entity)}"
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.schema}")
        # Staged: parsed once, counted, and a full load without rows leaves the table as it is.
        df = persist_table(df, f"{entity}-rows")
        rows = df.count()
        writer = df.write.format(self.provider)
        if mode == FULL and not rows:
            pass
        elif mode == FULL:
            writer.mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)
        elif mode == UPSERT and spark.catalog.tableExists(name):
            same = [F.col(f"{name}.{quoted(k)}") == F.col(f"source.{quoted(k)}") for k in self.keys]
            merge = df.alias("source").mergeInto(name, reduce(lambda a, b: a & b, same))
            merge.withSchemaEvolution().whenMatched().updateAll().whenNotMatched().insertAll().merge()
        else:
            if spark.catalog.tableExists(name) and self.mark in df.columns and self.mark not in spark.table(name).columns:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({self.mark} STRING)")  # a table of an earlier version
            writer.mode("append").option("mergeSchema", "true").saveAsTable(name)
        return Written(name, run_stamp(run_ts, number), df.schema, rows=rows)

    def loads_in(self, spark: SparkSession, entity: str, load_ids: Sequence[str]) -> dict[str, int]:
        """Which of these loads have rows in the table, and how many.

        A file holds the rows of one load, so its statistics spare all other files' pages.
        """
        name = f"{self.schema}.{quoted(entity)}"
        if not load_ids or not spark.catalog.tableExists(name):
            return {}
        spark.catalog.refreshTable(name)
        table = spark.table(name)
        if self.mark not in table.columns:
            return {}
        found = table.where(F.col(self.mark).isin(list(load_ids))).groupBy(self.mark).agg(F.count(F.lit(1)).alias("n"))
        return {r[self.mark]: r["n"] for r in found.collect()}
