"""Text to typed columns. Strict parsers fail the job on bad text, lenient ones yield null.

Both hold whatever `spark.sql.ansi.enabled` says. Blank text is a missing value in either. A
good value is parsed once; the second look at a text happens only where parsing gave nothing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _strict(parsed: Column, text: Column, what: str) -> Column:
    fail = F.raise_error(F.concat(F.lit(f"not a {what}: "), text))
    return F.coalesce(parsed, F.when(F.trim(text) != "", fail))


def strict_timestamp(text: Column) -> Column:
    return _strict(text.try_cast("timestamp_ntz"), text, "timestamp")


def strict_date(text: Column) -> Column:
    return _strict(lenient_date(text), text, "date")


def lenient_date(text: Column) -> Column:
    """The day of a date or timestamp text. Parsed as a timestamp, as a plain date cast would
    accept any tail after the day."""
    return text.try_cast("timestamp_ntz").cast("date")


def parse(text: Column, kind: T.DataType, lenient: bool = False) -> Column:
    """Parse one text column to `kind`."""
    if isinstance(kind, T.StringType):
        return F.nullif(text, F.lit(""))
    if isinstance(kind, T.TimestampNTZType):
        return strict_timestamp(text)
    if isinstance(kind, T.DateType):
        return lenient_date(text) if lenient else strict_date(text)
    parsed = text.try_cast(kind)
    if isinstance(kind, T.LongType):
        # Other tools write nullable ids as floats ("5.0").
        whole = F.regexp_replace(text, r"\.0+$", "")
        parsed = F.coalesce(parsed, whole.try_cast(kind))
    return _strict(parsed, text, kind.simpleString())
