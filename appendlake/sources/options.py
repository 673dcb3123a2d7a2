"""Labels of coded columns, from one JSON file per entity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appendlake.config import DEFAULT_LANGUAGE

# Field names of the option files.
_GLOBAL_FIELDS = (
    "IsUserLocalizedLabel: boolean, LocalizedLabel: string, LocalizedLabelLanguageCode: bigint, "
    "Option: bigint, OptionSetName: string"
)
OPTION_SCHEMA = (
    f"OptionSetMetadata array<struct<EntityName: string, {_GLOBAL_FIELDS}>>, "
    f"GlobalOptionSetMetadata array<struct<{_GLOBAL_FIELDS}>>"
)
LABEL_SCHEMA = (
    "EntityName string, IsUserLocalizedLabel boolean, LocalizedLabel string, "
    "LocalizedLabelLanguageCode bigint, Option bigint, OptionSetName string, IsGlobal boolean"
)

Patch = Callable[[DataFrame, str], DataFrame]


def read_labels(
    spark: SparkSession,
    path: str,
    entity: str,
    language: int = DEFAULT_LANGUAGE,
    patch: Patch | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Distinct label rows of one language: the entity's own sets and the global ones.

    The schema is given, so an absent or empty list needs no look at the data
    first. A missing file has no labels. ``patch`` may change the rows.
    """
    try:
        document = spark.read.schema(OPTION_SCHEMA).json(path, multiLine=multi_line)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LABEL_SCHEMA)
    own = document.select(F.inline("OptionSetMetadata")).withColumn("IsGlobal", F.lit(False))
    shared = document.select(
        F.lit(entity).alias("EntityName"), F.inline("GlobalOptionSetMetadata")
    ).withColumn("IsGlobal", F.lit(True))
    rows = own.unionByName(shared).where(F.col("LocalizedLabelLanguageCode") == language)
    if patch is not None:
        rows = rows.transform(patch, entity)
    return rows.distinct()


def one_per_code(labels: DataFrame) -> DataFrame:
    """One label per set and code, so that adding labels never repeats a row.

    The entity's own label comes before a global one, a user's label before
    another; equal candidates are settled by their text.
    """
    order = F.struct("IsGlobal", ~F.coalesce("IsUserLocalizedLabel", F.lit(False)), "LocalizedLabel")
    return (
        labels.where("Option is not null")
        .groupBy("OptionSetName", "Option")
        .agg(F.min_by("LocalizedLabel", order).alias("LocalizedLabel"))
    )
