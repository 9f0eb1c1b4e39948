"""Time column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A calendar date, optionally with a time of day and a zone.
ISO = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"
)


def iso_timestamp(c: Column) -> Column:
    """Timestamp of an ISO 8601 text, null if it is none.

    A text without zone is UTC, whatever the zone of the session.
    """
    # A time of day without seconds gets them, a date its midnight, a text without zone "Z".
    full = F.when(F.length(c) == 10, F.concat(c, F.lit("T00:00:00"))).otherwise(
        F.regexp_replace(c, r"^(.{13}:\d{2})(?!:\d)", "$1:00")
    )
    zoned = F.when(full.rlike(r"(Z|[+-]\d{2}:\d{2})$"), full).otherwise(F.concat(full, F.lit("Z")))
    return F.when(c.rlike(ISO), zoned.try_cast("timestamp"))


def safe_timestamp(c: Column, run_ts: Column) -> Column:
    """``iso_timestamp`` with the time of the run in place of bad and missing values."""
    return F.coalesce(iso_timestamp(c), run_ts)


def is_bad_timestamp(c: Column) -> Column:
    """True for a text that is present but no ISO 8601 time."""
    return F.coalesce(c != "", F.lit(False)) & iso_timestamp(c).isNull()
