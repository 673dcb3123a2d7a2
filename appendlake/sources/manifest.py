"""Entities and attributes of a JSON manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appendlake.config import DECIMAL_TRAIT, SYNC_STATE_KEY, SYNC_STATE_MISSING, SYNC_STATE_READY
from appendlake.functions.guards import in_list_or_all
from appendlake.functions.maps import last_wins_map

MANIFEST_SCHEMA = """
entities array<struct<
  name: string,
  annotations: array<struct<name: string, value: string>>,
  attributes: array<struct<
    name: string,
    dataType: string,
    `cdm:traits`: array<struct<
      traitReference: string,
      arguments: array<struct<name: string, value: string>>>>>>>>
"""

# Declared type → Spark type. Decimals take their size from a trait.
SPARK_TYPES = {
    "guid": "string",
    "boolean": "boolean",
    "decimal": "decimal",
    "double": "double",
    "dateTimeOffset": "timestamp",
    "dateTime": "timestamp",
    "int64": "bigint",
    "string": "string",
}


def read_entities(
    spark: SparkSession, path: str, names: Sequence[str] = (), multi_line: bool = True
) -> DataFrame:
    """One row per synchronised entity: ``entity, annotations, sync_state, attributes``.

    ``names`` selects entities; an empty list selects all. A manifest is one
    multi-line document; with ``multi_line=False`` each line of the files is one.
    """
    documents = spark.read.schema(MANIFEST_SCHEMA).json(path, multiLine=multi_line)
    annotations = last_wins_map(F.col("annotations"))
    return (
        documents.select(F.inline("entities"))
        .where(in_list_or_all(F.col("name"), names))
        .select(
            F.col("name").alias("entity"),
            F.coalesce(annotations, F.create_map().cast("map<string,string>")).alias("annotations"),
            "attributes",
        )
        .withColumn(
            "sync_state",
            F.coalesce(F.try_element_at("annotations", F.lit(SYNC_STATE_KEY)), F.lit(SYNC_STATE_MISSING)),
        )
        .where(F.col("sync_state") == SYNC_STATE_READY)
    )


def attributes(entities: DataFrame) -> DataFrame:
    """``entity, pos, name, data_type, precision, scale, spark_type, known_type``, one row each."""
    attribute = F.col("attribute")
    declared = F.col("data_type")
    return (
        entities.select("entity", F.posexplode("attributes").alias("pos", "attribute"))
        .select(
            "entity",
            "pos",
            attribute["name"].alias("name"),
            attribute["dataType"].alias("data_type"),
            _decimal_arguments(attribute).alias("arguments"),
        )
        .select(
            "entity",
            "pos",
            "name",
            "data_type",
            _argument("precision").alias("precision"),
            _argument("scale").alias("scale"),
            declared.isin(list(SPARK_TYPES)).alias("known_type"),
        )
        .withColumn("spark_type", _spark_type(declared))
    )


def _decimal_arguments(attribute: Column) -> Column:
    shaped = F.filter(attribute["cdm:traits"], lambda t: t["traitReference"] == DECIMAL_TRAIT)
    first = F.try_element_at(shaped, F.lit(1))["arguments"]
    return F.when(attribute["dataType"] == "decimal", last_wins_map(first))


def _argument(name: str) -> Column:
    return F.try_element_at("arguments", F.lit(name)).try_cast("int")


def _spark_type(declared: Column) -> Column:
    """Spark's name of the type; a decimal without a complete trait has the default size."""
    sized = F.format_string("decimal(%d,%d)", F.col("precision"), F.col("scale"))
    both = F.col("precision").isNotNull() & F.col("scale").isNotNull()
    result = F.when(declared == "decimal", F.when(both, sized).otherwise("decimal(10,0)"))
    for name, spark_name in SPARK_TYPES.items():
        if name != "decimal":
            result = result.when(declared == name, spark_name)
    return result.otherwise("string")


def schemas(entities: DataFrame) -> dict[str, T.StructType]:
    """Entity name → read schema, in attribute order.

    This is the only part of a manifest the driver holds; it is as large as the
    schemas themselves.
    """
    found: dict[str, list[tuple[int, T.StructField]]] = {
        r["entity"]: [] for r in entities.select("entity").collect()
    }
    for r in attributes(entities).collect():
        field = T.StructField(r["name"], T.DataType.fromDDL(r["spark_type"]))
        found[r["entity"]].append((r["pos"], field))
    return {
        name: T.StructType([f for _, f in sorted(fields, key=lambda pair: pair[0])])
        for name, fields in found.items()
    }


def warnings(entities: DataFrame) -> DataFrame:
    """Attributes whose declared type is unknown and which are therefore read as text."""
    return attributes(entities).where("not known_type").select("entity", "name", "data_type")
