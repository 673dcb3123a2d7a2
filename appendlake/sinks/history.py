"""The runs that make up a table, as the log of loads has them."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appendlake.config import LakeConfig
from appendlake.operators.ledger import FULL, log


def runs(spark: SparkSession, config: LakeConfig, entity: str, kind: str) -> list[dict]:
    """Live runs from the last full load on, oldest first: one row per load, in one pass over the log."""
    own = log(spark, config.loads).where((F.col("entity") == entity) & (F.col("kind") == kind) & F.col("live"))
    rows = own.select("number", "run", "mode", "place", "layout", "replaced").collect()
    # Logs of an earlier version have no numbers; their loads came first.
    rows.sort(key=lambda r: (r["number"] or 0, r["run"], r["place"]))
    last_full = max((i for i, r in enumerate(rows) if r["mode"] == FULL), default=0)
    return [{"mode": r["mode"], "place": r["place"], "replaced": r["replaced"] or []} | json.loads(r["layout"]) for r in rows[last_full:]]


WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}  # and how many digits each needs


def wider(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The type that holds all values of both, if parquet files of ``old`` can be read as it; else None.

    int → long, int → double, float → double, whole numbers and decimals → a decimal with
    room for both.
    """
    if old == new:
        return new
    digits_old, digits_new = (WHOLE.get(type(t)) for t in (old, new))
    if digits_old and digits_new:
        return max((old, new), key=lambda t: WHOLE[type(t)])
    if isinstance(new, T.DoubleType) and (isinstance(old, T.FloatType) or (digits_old or 99) <= 10):
        return new
    if isinstance(new, T.DecimalType) and (digits_old or isinstance(old, T.DecimalType)):
        before, after = (digits_old, 0) if digits_old else (old.precision - old.scale, old.scale)
        scale = max(after, new.scale)
        precision = max(before, new.precision - new.scale) + scale
        return T.DecimalType(precision, scale) if precision <= 38 else None
    return None


def columns(live: list[dict]) -> T.StructType:
    """Columns of all runs, in the order of the first run that has each, with the widest of their types."""
    types: dict[str, T.DataType] = {}
    for run in live:
        for f in T.StructType.fromJson(run["schema"]).fields:
            types[f.name] = wider(types[f.name], f.dataType) or types[f.name] if f.name in types else f.dataType
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


def refuse_type_change(live: list[dict], schema: T.StructType, keys: Sequence[str] = ()) -> None:
    """A column may get a wider type, which old files are then read as. Any other change, or one
    of a key, whose hash is the row's place, waits for a full load."""
    known = {f.name: f.dataType for f in columns(live).fields}
    for f in schema.fields:
        if f.name not in known or known[f.name] == f.dataType:
            continue
        if f.name in keys or wider(known[f.name], f.dataType) in (None, known[f.name]):
            was, now = known[f.name].simpleString(), f.dataType.simpleString()
            raise ValueError(f"column {f.name!r} is {was} in the table and {now} in the load")
