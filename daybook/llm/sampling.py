"""Bounded samples: of many rows, those with the smallest hashes of their ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_RANGE = 1 << 30
#: Rows that pass for each one wanted, so that enough remain after further conditions.
SPARE = 3


def order(id_column: str) -> Column:
    return F.pmod(F.xxhash64(id_column), F.lit(_RANGE))


def among_lowest(id_column: str, wanted: int, total: int) -> Column:
    """Holds for about SPARE times as many rows as are wanted, out of `total`.

    A task drops the others on its own, so no task or driver sees more than that, however many
    tasks there are. Rows with a null id don't pass.
    """
    share = 1.0 if total <= 0 else min(1.0, SPARE * wanted / total)
    return F.col(id_column).isNotNull() & (order(id_column) < F.lit(int(share * _RANGE) + 1))
