"""A parquet folder per run."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from appendlake.config import LakeConfig
from appendlake.operators.ledger import FULL, UPSERT
from appendlake.sinks import history
from appendlake.sources.files import literal


@dataclass(frozen=True)
class Written:
    """Where a load went, with which columns, and which buckets of a table it replaced.

    ``bucket_count`` and ``keys`` say how the rows were dealt, if they were. ``rows`` is
    the number of the load's rows, taken from what was written.
    """

    destination: str
    run_id: str
    schema: T.StructType
    buckets: list[int] = field(default_factory=list)
    bucket_count: int = 0
    keys: list[str] = field(default_factory=list)
    rows: int = 0

    def layout(self) -> str:
        parts = {"run_id": self.run_id, "bucket_count": self.bucket_count, "keys": self.keys}
        return json.dumps(parts | {"schema": self.schema.jsonValue()})


def run_stamp(run_ts: dt.datetime, number: int) -> str:
    """UTC second and load number: no two loads of an entity have the same."""
    moment = run_ts.astimezone(dt.timezone.utc) if run_ts.tzinfo else run_ts
    return f"{moment:%Y%m%d_%H%M%S}_{number:06d}"


def written_rows(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """Rows of a folder as the footers of its files have them; no column is read."""
    return spark.read.schema(schema).parquet(literal(path)).count()


class RunFolderSink:
    """Writes ``<root>/<entity>/<entity>_<yyyyMMdd_HHmmss>_<number>.parquet``, without any shuffle."""

    destination_type = "PATH"

    def __init__(self, config: LakeConfig) -> None:
        if not config.table_root:
            raise ValueError("a run folder sink needs table_root")
        self.config = config

    def write(self, df: DataFrame, entity: str, mode: str, run_ts: dt.datetime, number: int) -> Written:
        if mode == UPSERT:
            raise ValueError("run folders do not support upsert")
        run_id = f"{entity}_{run_stamp(run_ts, number)}.parquet"
        destination = f"{self.config.table_root}/{entity}/{run_id}"
        if mode != FULL:
            history.refuse_type_change(history.runs(df.sparkSession, self.config, entity, self.destination_type), df.schema)
        df.write.parquet(destination)
        rows = written_rows(df.sparkSession, destination, df.schema)
        return Written(destination, run_id, df.schema, rows=rows)
