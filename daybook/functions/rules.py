"""Business rules and small expressions. Each rule is written here and nowhere else."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.schemas import APPROVED


def is_approved(status: str = "purchase_status") -> Column:
    """True or false, never null: a missing status is not approved."""
    return F.col(status).eqNullSafe(APPROVED)


def gmv_eligible() -> Column:
    """A purchase counts for revenue once it is paid and approved. Never null."""
    return F.col("release_date").isNotNull() & is_approved()


def in_year(date_column: str, year: int) -> Column:
    """Half-open day range: unlike `year(col) = n` it reaches the scan as a pushed filter."""
    day = F.col(date_column)
    return (day >= F.lit(dt.date(year, 1, 1))) & (day < F.lit(dt.date(year + 1, 1, 1)))


def provenance(touched: Mapping[str, Column]) -> Column:
    """Comma list of the sources whose condition holds, in mapping order; '' when none does."""
    return F.concat_ws(",", *[F.when(hit, F.lit(name)) for name, hit in touched.items()])


def share(part: Column, whole: Column) -> Column:
    """`part / whole` as a double; 0.0 when there is nothing to divide by."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def half_even(value: Column, places: int) -> Column:
    return F.bround(value, places)
