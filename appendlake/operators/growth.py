"""Compare current sizes with the bytes handled so far, and tell growing files from rewritten ones."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appendlake.config import MIB
from appendlake.sources import prints

GROWN, SAME, SHRUNK, REWRITTEN = "grown", "same", "shrunk", "rewritten"


def compare(listing: DataFrame, state: DataFrame) -> DataFrame:
    """Adds ``start``, ``fresh`` and ``status`` to each listed row.

    ``listing`` has ``size``, ``state`` the byte up to which a file was handled (``stop``),
    both one row per ``path``; what else ``state`` has is added too. ``status`` is grown,
    same or shrunk; a file that is smaller than what was copied from it was rewritten.
    """
    joined = listing.join(state.withColumnRenamed("stop", "start"), "path", "left")
    start = F.coalesce("start", F.lit(0).cast("bigint"))
    joined = joined.withColumns({"start": start, "fresh": F.col("size") - start})
    status = F.when(F.col("fresh") > 0, GROWN).when(F.col("fresh") == 0, SAME).otherwise(SHRUNK)
    return joined.withColumn("status", status)


def plan(listing: DataFrame, state: DataFrame) -> DataFrame:
    """The new range of every row that grew: ``start``, ``stop``, ``fresh``."""
    grown = compare(listing, state).where(F.col("status") == GROWN)
    return grown.withColumn("stop", F.col("size")).drop("status", "size")


def marked(rows: DataFrame, whole: bool = False) -> DataFrame:
    """Rows with ``path``, ``start`` and ``tail``, and whether the bytes before ``start`` are ``rewritten``.

    ``tail`` is the fingerprint of the last bytes before ``start``, taken when they were
    copied; a file rewritten to the same or a larger size nearly never has the same
    there. It costs one small read per file, made by tasks. With ``whole`` all bytes up to
    ``start`` are read again and compared with ``crc``, their checksum: an audit. Where
    the log has no fingerprint, or no byte was handled yet, nothing is known: false.
    """
    wanted, kind = ("crc", "bigint") if whole else ("tail", "string")
    keys = rows.where((F.col("start") > 0) & F.col(wanted).isNotNull()).select("path", "start", wanted)
    tasks = rows.sparkSession.sparkContext.defaultParallelism * 4

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for path, start, known in zip(batch["path"], batch["start"], batch[wanted]):
                try:
                    now = prints.checksum(path, 0, start, 16 * MIB) if whole else prints.tail(path, start)
                except EOFError:  # shrunk meanwhile
                    now = None
                found.append(now != known)
            yield pd.DataFrame({"path": batch["path"], "rewritten": found})

    looked = keys.select("path", "start", F.col(wanted).cast(kind)).repartition(tasks).mapInPandas(look, "path string, rewritten boolean")
    return rows.join(looked, "path", "left").withColumn("rewritten", F.coalesce("rewritten", F.lit(False)))
