"""Questions asked of a purchase history: now, as of a past day, and one purchase's story."""

from __future__ import annotations

import datetime as dt

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.literals import as_date, date_literal
from daybook.operators.snapshots import timeline
from daybook.operators.versions import as_of
from daybook.schemas import AUDIT_COLUMNS, MONEY_TOTAL, PURCHASE, Grain


def current(history: DataFrame) -> DataFrame:
    """The newest row of every purchase."""
    return history.where("is_current")


def _gmv(rows: DataFrame, keys: dict[str, str]) -> DataFrame:
    named = {alias: F.col(name).alias(alias) for name, alias in keys.items()}
    return (
        rows.groupBy(*named.values())
        .agg(F.sum("purchase_value").cast(MONEY_TOTAL).alias("gmv"))
        .orderBy(*[F.asc_nulls_last(alias) for alias in named])
    )


def gmv_daily(history: DataFrame, date_col: str = "release_date") -> DataFrame:
    """Current GMV per day and subsidiary. An unknown subsidiary is a group of its own."""
    rows = current(history).where("is_gmv_eligible")
    return _gmv(rows, {date_col: "data_compra", "subsidiary": "subsidiaria"})


def gmv_as_of(
    history: DataFrame,
    cutoff: dt.date | str,
    date_col: str = "order_date",
    month: dt.date | str | None = None,
) -> DataFrame:
    """GMV per day, purchase and subsidiary as the books stood on `cutoff`. The same cutoff
    gives the same answer forever. `month` (any day of it) keeps that month of `date_col`."""
    needed = ["purchase_id", date_col, "subsidiary", "purchase_value", "is_gmv_eligible"]
    rows = as_of(history, cutoff, needed).where("is_gmv_eligible")
    if month is not None:
        first = as_date(month).replace(day=1)
        after = (first + dt.timedelta(days=31)).replace(day=1)
        rows = rows.where((F.col(date_col) >= F.lit(first)) & (F.col(date_col) < F.lit(after)))
    return _gmv(
        rows, {date_col: "data_compra", "purchase_id": "id_compra", "subsidiary": "subsidiaria"}
    )


def audit(history: DataFrame, purchase_id: int, eligible_only: bool = False) -> DataFrame:
    """What changed in one purchase and when, oldest first. The id test reaches the scan, also
    through a history that has not been stored."""
    rows = history.where(F.col("purchase_id") == purchase_id)
    if eligible_only:
        rows = rows.where("is_gmv_eligible")
    return rows.select(*AUDIT_COLUMNS).orderBy("transaction_date")


def gmv_deltas(
    history: DataFrame, keys: Sequence[str] = ("order_date", "purchase_id", "subsidiary"), grain: Grain = PURCHASE
) -> DataFrame:
    """What each day adds to and takes from the GMV of each group: stored once, it answers any cutoff.

    A version adds its value to its group from its day on, and takes back that of the version before it. `rows`
    and `valued` count versions, and those with a value, so that a group without any is told from one
    that sums up to zero. The one window, by entity, is paid when the deltas are made, not when they are read.
    """
    entry = F.when(
        F.col("is_gmv_eligible"),
        F.struct(*[F.col(k).alias(k) for k in keys], F.col("purchase_value").alias("value")),
    )
    sides = F.array(
        F.struct(F.lit(1).alias("sign"), F.col("now").alias("entry")),
        F.struct(F.lit(-1).alias("sign"), F.col("before").alias("entry")),
    )
    changes = history.select(grain.key, grain.date, entry.alias("now")).withColumn(
        "before", F.lag("now").over(timeline(grain))
    ).where("NOT (now <=> before)")
    signed = changes.select(F.col(grain.date).alias("changed_on"), F.inline(sides)).where("entry IS NOT NULL")
    value = F.col("entry.value")
    return signed.groupBy("changed_on", *[F.col(f"entry.{k}").alias(k) for k in keys]).agg(
        F.sum(F.col("sign") * F.coalesce(value, F.lit(0))).cast(MONEY_TOTAL).alias("gmv"),
        F.sum("sign").alias("rows"),
        F.sum(F.when(value.isNotNull(), F.col("sign")).otherwise(0)).alias("valued"),
    ).where("gmv <> 0 OR rows <> 0 OR valued <> 0")


def _total(rows: Column, valued: Column, gmv: Column) -> Column:
    return F.when(rows > 0, F.struct(F.when(valued > 0, gmv).cast(MONEY_TOTAL).alias("gmv")))


def gmv_at(deltas: DataFrame, cutoff: dt.date | str, keys: dict[str, str]) -> DataFrame:
    """GMV by the keys (column -> name in the result) as the books stood on `cutoff`: a sum of deltas."""
    sums = (
        deltas.where(F.col("changed_on") <= date_literal(cutoff))
        .groupBy(*[F.col(k).alias(name) for k, name in keys.items()])
        .agg(*[F.sum(c).alias(c) for c in ("rows", "valued", "gmv")])
    )
    total = _total(F.col("rows"), F.col("valued"), F.col("gmv"))
    named = sums.select(*keys.values(), total.alias("total")).where("total IS NOT NULL")
    return named.select(*keys.values(), "total.gmv").orderBy(*[F.asc_nulls_last(c) for c in keys.values()])


def gmv_at_each(deltas: DataFrame, cutoffs: DataFrame, keys: dict[str, str], cutoff: str = "cutoff") -> DataFrame:
    """GMV by the keys at every cutoff of a table: running sums of the deltas by day.

    Deltas are added up by group and day first. Then each cutoff is a day without deltas of each group, so
    there are at most (groups x (days + cutoffs)) rows; group by few keys where cutoffs are many.
    """
    names = list(keys.values())
    daily = deltas.groupBy("changed_on", *[F.col(k).alias(name) for k, name in keys.items()]).agg(
        *[F.sum(c).alias(c) for c in ("rows", "valued", "gmv")]
    )
    days = cutoffs.select(F.col(cutoff).alias("changed_on")).dropna().distinct()
    dates = days.agg(F.array_sort(F.collect_set("changed_on")).alias("days")).scalar()
    asked = daily.select(*names).distinct().select(*names, F.explode(dates).alias("changed_on"))
    line = daily.unionByName(asked.withColumn("asks", F.lit(True)), allowMissingColumns=True)
    until = Window.partitionBy(*names).orderBy("changed_on", F.col("asks").asc_nulls_first())
    until = until.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {c: F.coalesce(F.sum(c).over(until), F.lit(0)) for c in ("rows", "valued", "gmv")}
    total = _total(F.col("rows"), F.col("valued"), F.col("gmv"))
    return (
        line.withColumns(sums).where("asks").withColumn("total", total).where("total IS NOT NULL")
        .select(F.col("changed_on").alias(cutoff), *names, "total.gmv")
    )
