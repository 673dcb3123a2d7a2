"""Add the label of each coded column."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appendlake.config import MIB
from appendlake.session import persist_table
from appendlake.sources.options import one_per_code

BROADCAST_BYTES = 64 * MIB
ROW_OVERHEAD = 64
SUFFIX = "_descr"


def lookup(
    df: DataFrame,
    labels: DataFrame,
    column: str,
    code: str,
    label: str,
    alias: str,
    may_broadcast: bool | None = None,
) -> DataFrame:
    """Left join on a code with at most one label each; unknown and null codes get null.

    The code takes the column's type (text, boolean, double), not the other way round.
    Codes that become equal by that are one code, with the label of the smallest, so no
    row is repeated. Labels up to a measured size are broadcast, which leaves the rows
    where they are. Beyond it both sides are shuffled by code in a sort-merge join; the
    labels hold a code once, so adaptive execution can split a hot code's rows.
    """
    own_type = df.schema[column].dataType
    typed = labels.select(F.col(quoted(code)).alias("code"), F.col(quoted(label)).alias("label"))
    typed = typed.withColumn("typed", F.col("code").try_cast(own_type)).where("typed is not null")
    side = typed.groupBy(F.col("typed").alias("_code")).agg(F.min_by("label", "code").alias(alias))
    if may_broadcast is None:
        size = labels.agg(_bytes(code, label)).first()[0] or 0
        may_broadcast = size <= BROADCAST_BYTES
    side = F.broadcast(side) if may_broadcast else side.hint("merge")
    kept = [F.col(quoted(c)) for c in df.columns]
    joined = df.join(side, F.col(quoted(column)) == F.col("_code"), "left")
    return joined.select(*kept, F.col(quoted(alias)))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _bytes(*columns: str) -> Column:
    sizes = [F.coalesce(F.octet_length(F.col(quoted(c)).cast("string")), F.lit(0)) for c in columns]
    return F.sum(sum(sizes, F.lit(ROW_OVERHEAD))).cast("bigint")


def enrich(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``<set>_descr`` for every option set that names a column of ``df``.

    The names and sizes of the sets are the only thing collected. Sets are broadcast,
    the smallest first, as long as all of them together stay below ``BROADCAST_BYTES``.
    A set that is no column is left out with a warning.
    """
    # Read once; a join per set follows.
    codes = persist_table(one_per_code(labels), "labels")
    sizes = {
        r["OptionSetName"]: r["bytes"]
        for r in codes.groupBy("OptionSetName").agg(_bytes("Option", "LocalizedLabel").alias("bytes")).collect()
    }
    by_lower = {name.lower(): name for name in sizes}
    for name in sizes.keys() - {by_lower.get(c.lower()) for c in df.columns}:
        warnings.warn(f"option set {name!r} is not a column; no label added", stacklevel=2)
    # Column names are compared as Spark resolves them, without regard to case.
    wanted = [c for c in df.columns if c.lower() in by_lower]
    left, small = BROADCAST_BYTES, set()
    for name in sorted({by_lower[c.lower()] for c in wanted}, key=lambda n: (sizes[n], n)):
        left -= sizes[name]
        if left >= 0:
            small.add(name)
    for column in wanted:
        name = by_lower[column.lower()]
        own = codes.where(F.col("OptionSetName") == name).select("Option", "LocalizedLabel")
        df = lookup(df, own, column, "Option", "LocalizedLabel", name + SUFFIX, name in small)
    return df
