from daybook.functions.literals import as_date, clock_literal, date_literal
from daybook.functions.parsing import lenient_date, parse, strict_date, strict_timestamp
from daybook.functions.rules import (
    gmv_eligible,
    half_even,
    in_year,
    is_approved,
    provenance,
    share,
)

__all__ = [
    "as_date",
    "clock_literal",
    "date_literal",
    "gmv_eligible",
    "half_even",
    "in_year",
    "is_approved",
    "lenient_date",
    "parse",
    "provenance",
    "share",
    "strict_date",
    "strict_timestamp",
]
