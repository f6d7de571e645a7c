"""Column functions on timestamps. Results are TIMESTAMP_NTZ: wall-clock time of the store."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# m/d/yy h:mm, as point-of-sale exports write it.
_SHORT = r"^(\d{1,2})/(\d{1,2})/(\d{2}) (\d{1,2}:\d{2})$"
# A date of three parts, and no zone behind the time.
_WALL_CLOCK = r"^\d{4}-\d{1,2}-\d{1,2}([T ]\d{1,2}(:\d{1,2}){1,2}(\.\d*)?)?$"


def parse_timestamp(text: Column) -> Column:
    """Text → TIMESTAMP_NTZ; null where no accepted format fits, never an error.

    Accepted: ISO with ``T`` or a blank and an optional fraction, a bare date, and
    ``m/d/yy h:mm`` (years 69-99 belong to the 1900s). The short form is rewritten as ISO
    rather than parsed in the session time zone, where an hour may not exist. A text with a
    time zone names another clock than the store's, and a year or month alone is no date;
    both are null and go to quarantine like any other text.
    """
    text = F.trim(text)
    year = F.regexp_extract(text, _SHORT, 3)
    century = F.when(year >= "69", F.lit("19")).otherwise(F.lit("20"))
    iso = F.concat(
        century,
        year,
        F.lit("-"),
        F.regexp_extract(text, _SHORT, 1),
        F.lit("-"),
        F.regexp_extract(text, _SHORT, 2),
        F.lit(" "),
        F.regexp_extract(text, _SHORT, 4),
    )
    # The usual form first: the short one is looked for only where that does not fit.
    return F.when(text.rlike(_WALL_CLOCK), text.try_cast("timestamp_ntz")).otherwise(
        F.when(text.rlike(_SHORT), iso.try_cast("timestamp_ntz"))
    )


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def month_name(ts: Column) -> Column:
    """Full English month name."""
    return F.date_format(ts, "MMMM")
