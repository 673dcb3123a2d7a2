"""Typed parsing of exported text; a value that does not parse becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the export's 12-hour timestamp, one- or two-digit month, day and hour.
TWELVE_HOUR_FORMAT = "M/d/yyyy h:mm:ss a"


def parse_timestamp(text: Column) -> Column:
    """Both timestamp forms of the export: US 12-hour, and ISO 8601.

    The slash selects the form, so a value is only ever tried against the
    format it can match; failing tries would cost an exception per row.
    """
    return F.when(
        text.contains("/"), F.try_to_timestamp(text, F.lit(TWELVE_HOUR_FORMAT))
    ).otherwise(text.try_cast("timestamp"))
