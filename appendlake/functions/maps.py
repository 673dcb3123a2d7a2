"""Key/value lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_wins_map(pairs: Column, key: str = "name", value: str = "value") -> Column:
    """Array of structs → map, where the last entry of a repeated key counts.

    ``map_from_entries`` raises on a repeated key unless a session setting says
    otherwise; looking up each distinct key's last entry needs no setting. Meant
    for the short lists that come with one record.
    """
    keys = F.array_distinct(F.filter(F.transform(pairs, lambda p: p[key]), lambda k: k.isNotNull()))
    return F.map_from_arrays(
        keys,
        F.transform(keys, lambda k: F.element_at(F.filter(pairs, lambda p: p[key] == k), -1)[value]),
    )
