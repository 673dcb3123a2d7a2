"""Destinations of a load. Any object with the members of ``Sink`` can be one."""

from __future__ import annotations

import datetime as dt
from typing import Protocol

from pyspark.sql import DataFrame

from appendlake.sinks.catalog_tables import CatalogTableSink
from appendlake.sinks.run_folders import RunFolderSink, Written
from appendlake.sinks.versions import VersionedSink


class Sink(Protocol):
    destination_type: str

    def write(self, df: DataFrame, entity: str, mode: str, run_ts: dt.datetime, number: int) -> Written: ...


__all__ = ["CatalogTableSink", "RunFolderSink", "Sink", "VersionedSink", "Written"]
