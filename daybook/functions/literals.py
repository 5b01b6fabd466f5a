"""Date and clock literals that do not depend on the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(day: dt.date | str) -> dt.date:
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)


def date_literal(day: dt.date | str) -> Column:
    return F.lit(as_date(day))


def clock_literal(moment: dt.datetime) -> Column:
    """A zone-free timestamp; `F.lit(datetime)` alone would be read in the session zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
