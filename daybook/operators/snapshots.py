"""Operators that turn event feeds into one row per entity and touched day.

All event-level work is aggregation by (entity, day), which Spark starts on the map side: an
entity holding a third of all events reaches the shuffle as at most one row per day and map
task. Windows by entity only ever see those daily rows, so their groups are bounded by the
calendar, not by the number of events.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from daybook.schemas import PURCHASE, Grain
from daybook.sources.feeds import Feed, accepted


def last_of_day(feed: Feed, grain: Grain = PURCHASE) -> DataFrame:
    """The last event of each entity and day, reduced to keys and payload."""
    return (
        feed.placed(grain)
        .groupBy(*grain.day)
        .agg(F.max(feed.event(grain)).alias("event"))
        .select(*grain.day, *[F.col(f"event.{name}") for name in feed.payload])
    )


def shared_log(feeds: Sequence[Feed]) -> DataFrame | None:
    """The one log that all feeds are picked from, if there is one."""
    first = feeds[0].log
    shared = all(f.picked is not None for f in feeds) and all(
        f.log is first or f.log.sameSemantics(first) for f in feeds[1:]
    )
    return first if shared else None


def event_spine(feeds: Sequence[Feed], grain: Grain = PURCHASE) -> DataFrame:
    """Every (entity, day) that any feed touched, with a 0/1 flag per feed."""
    flags = [feed.flag for feed in feeds]
    log = shared_log(feeds)
    if log is not None:
        hits = accepted(log, grain).select(
            *grain.day, *[F.coalesce(f.picked, F.lit(False)).cast("int").alias(f.flag) for f in feeds]
        )
        spine = hits.groupBy(*grain.day).agg(*[F.max(flag).alias(flag) for flag in flags])
        return spine.where(F.greatest(*flags) == 1) if len(flags) > 1 else spine.where(F.col(flags[0]) == 1)
    touched = [
        feed.placed(grain).select(
            *grain.day, *[F.lit(int(flag == feed.flag)).alias(flag) for flag in flags]
        )
        for feed in feeds
    ]
    return (
        reduce(DataFrame.unionByName, touched)
        .groupBy(*grain.day)
        .agg(*[F.max(flag).alias(flag) for flag in flags])
    )


def attach(spine: DataFrame, feeds: Sequence[Feed], grain: Grain = PURCHASE) -> DataFrame:
    """Left-join each feed's last event of the day to the spine. Row count = spine."""
    return reduce(
        lambda wide, feed: wide.join(last_of_day(feed, grain), grain.day, "left"), feeds, spine
    )


def touched_days(feeds: Sequence[Feed], grain: Grain = PURCHASE) -> DataFrame:
    """Dedup, spine and join in one aggregation: per (entity, day) the last event of each feed
    as a struct column named after the feed's flag, null where the feed has none that day.

    Keeping a feed's columns in one struct makes an absent feed cost one null per row. Feeds that
    are picked from one log are aggregated in one pass over it.
    """
    log = shared_log(feeds)
    if log is not None:
        hit = reduce(lambda a, b: a | b, [feed.picked for feed in feeds])
        return accepted(log, grain).where(hit).groupBy(*grain.day).agg(
            *[F.max(F.when(feed.picked, feed.event(grain))).alias(feed.flag) for feed in feeds]
        )
    events = [
        feed.placed(grain).select(*grain.day, feed.event(grain).alias(feed.flag))
        for feed in feeds
    ]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), events)
    return together.groupBy(*grain.day).agg(
        *[F.max(feed.flag).alias(feed.flag) for feed in feeds]
    )


def timeline(grain: Grain = PURCHASE) -> WindowSpec:
    return Window.partitionBy(grain.key).orderBy(grain.date)


def until_now(grain: Grain = PURCHASE) -> WindowSpec:
    return timeline(grain).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def forward_fill(df: DataFrame, columns: Sequence[str], grain: Grain = PURCHASE) -> DataFrame:
    """Carry the last known value of each column forward, each column on its own, per entity
    in date order. Leading gaps stay null; nothing is ever filled backward."""
    return df.withColumns(
        {name: F.last(name, ignorenulls=True).over(until_now(grain)) for name in columns}
    )


def mark_current(df: DataFrame, grain: Grain = PURCHASE) -> DataFrame:
    """Flag the newest row of each entity. Needs one row per entity and day."""
    newest = F.lead(grain.date).over(timeline(grain)).isNull()
    return df.withColumn("is_current", newest)
