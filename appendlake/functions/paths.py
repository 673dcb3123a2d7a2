"""Names derived from paths and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """File name without its last extension; a leading dot starts no extension."""
    return F.regexp_extract(file_name(path), r"^(.+?)(\.[^.]*)?$", 1)


def remap_prefix(path: Column, prefix: str, root: str) -> Column:
    """Replace a URL prefix by a mount root; a path without the prefix goes below the root."""
    rest = F.when(path.startswith(prefix), F.substr(path, F.lit(len(prefix) + 1))).otherwise(path)
    first = F.when(rest.startswith("/"), F.substr(rest, F.lit(2))).otherwise(rest)
    return F.concat(F.lit(root.rstrip("/") + "/"), first)


def file_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmmss")


def folder_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)
