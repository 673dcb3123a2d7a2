"""Sizes of the files in entity folders."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appendlake.functions import paths
from appendlake.session import task_count
from appendlake.sources.files import open_file_system

LISTING_SCHEMA = T.StructType(
    [
        T.StructField("entity", T.StringType()),
        T.StructField("stem", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("modified_at", T.TimestampType()),
    ]
)


def list_files(spark: SparkSession, root: str, entities: Sequence[str]) -> DataFrame:
    """Files directly below ``<root>/<entity>/``, whatever their names, one row per file.

    Each entity's folder is listed by a task. Names with a leading dot are left out:
    they are files that a writer has not finished. A missing folder has no files.
    """
    if not entities:
        return spark.createDataFrame([], LISTING_SCHEMA)
    base = root if re.match("[A-Za-z][A-Za-z0-9+.-]*:", root) else f"file:{root}"
    found = T.StructType([f for f in LISTING_SCHEMA.fields if f.name != "stem"])

    def list_folder(entity: str) -> list[tuple]:
        fs, inner = open_file_system(f"{base}/{entity}")
        infos = fs.get_file_info(pafs.FileSelector(inner, allow_not_found=True))
        return [
            (entity, f"{base}/{entity}/{i.base_name}", i.size, i.mtime)
            for i in infos
            if i.type == pafs.FileType.File and not i.base_name.startswith(".")
        ]

    def list_folders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [row for entity in batch["entity"] for row in list_folder(entity)]
            yield pd.DataFrame(rows, columns=found.names, dtype=object)

    names = spark.createDataFrame([(e,) for e in dict.fromkeys(entities)], "entity string")
    listed = names.repartition(task_count(len(entities))).mapInPandas(list_folders, found)
    stem = paths.stem(F.col("path")).alias("stem")
    return listed.select("entity", stem, "path", "size", "modified_at")
