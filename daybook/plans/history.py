"""The history build: event feeds in, one row per purchase and touched day out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.literals import clock_literal
from daybook.functions.rules import gmv_eligible, provenance
from daybook.operators.snapshots import (
    attach,
    event_spine,
    forward_fill,
    mark_current,
    timeline,
    touched_days,
    until_now,
)
from daybook.schemas import HISTORY, PURCHASE, Grain
from daybook.sources.feeds import Feed


def stamp(
    filled: DataFrame, run_ts: dt.datetime, rule: Callable[[], Column] = gmv_eligible
) -> DataFrame:
    """Add eligibility, judged on the filled values, and the load time cut to seconds."""
    return filled.withColumns(
        {
            "is_gmv_eligible": rule(),
            "etl_loaded_at": clock_literal(run_ts.replace(microsecond=0)),
        }
    )


def fill_days(
    feeds: Sequence[Feed],
    touched: DataFrame,
    run_ts: dt.datetime,
    grain: Grain = PURCHASE,
    rule: Callable[[], Column] = gmv_eligible,
    before: DataFrame | None = None,
) -> DataFrame:
    """Rows of the history from `touched_days`: one window by entity fills, flags and stamps.

    `before` has the last known row of each entity from before the touched days; values carry over
    from it, and rows equal those that a build over all days gives.
    """
    values = [
        F.when(F.col(feed.flag).isNotNull(), F.struct(*[F.col(feed.flag)[c].alias(c) for c in feed.payload]))
        .alias(feed.flag)
        for feed in feeds
    ]
    days = touched.select(*grain.day, *values)
    if before is not None:
        known = [F.struct(*feed.payload).alias(feed.flag) for feed in feeds]
        seeds = before.select(*grain.day, *known, F.lit(True).alias("seed"))
        days = days.withColumn("seed", F.lit(False)).unionByName(seeds)
    filled = days.select(
        *grain.day,
        *[
            F.last(F.col(feed.flag)[name], ignorenulls=True).over(until_now(grain)).alias(name)
            for feed in feeds
            for name in feed.payload
        ],
        F.lead(grain.date).over(timeline(grain)).isNull().alias("is_current"),
        provenance({feed.source: F.col(feed.flag).isNotNull() for feed in feeds}).alias(
            "updated_sources"
        ),
        *(["seed"] if before is not None else []),
    )
    if before is not None:
        filled = filled.where("NOT seed").drop("seed")
    return stamp(filled, run_ts, rule)


def build_history(
    feeds: Sequence[Feed],
    run_ts: dt.datetime,
    grain: Grain = PURCHASE,
    columns: Sequence[str] = tuple(HISTORY.names),
    rule: Callable[[], Column] = gmv_eligible,
) -> DataFrame:
    """Two shuffles: events by (entity, day), pre-aggregated, then daily rows by entity.

    One shuffle of the raw events by entity would do the same, but would put all events of a
    hot entity into one task; here such a task gets no more rows than there are days.
    """
    return fill_days(feeds, touched_days(feeds, grain), run_ts, grain, rule).select(*columns)


def build_history_literal(
    feeds: Sequence[Feed],
    run_ts: dt.datetime,
    grain: Grain = PURCHASE,
    columns: Sequence[str] = tuple(HISTORY.names),
    rule: Callable[[], Column] = gmv_eligible,
) -> DataFrame:
    """The same result step by step (dedup, spine, joins, fill, flags): easier to inspect, and
    the yardstick `build_history` is tested against. It shuffles more."""
    wide = attach(event_spine(feeds, grain), feeds, grain)
    filled = forward_fill(wide, [name for feed in feeds for name in feed.payload], grain)
    flagged = mark_current(filled, grain).withColumn(
        "updated_sources", provenance({feed.source: F.col(feed.flag) == 1 for feed in feeds})
    )
    return stamp(flagged, run_ts, rule).select(*columns)
