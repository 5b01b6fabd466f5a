"""The history build: worked example, edge cases, and agreement with a plain-Python rebuild."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import samples as x
from daybook import schemas as s
from daybook.operators import event_spine, forward_fill, last_of_day, mark_current
from daybook.plans import build_history, build_history_literal
from daybook.sources import Feed, accepted, purchase_feeds, quarantined

BUILDS = [build_history, build_history_literal]


@pytest.mark.parametrize("build", BUILDS)
def test_worked_example(spark, build):
    built = build(x.feeds(spark), x.RUN_TS)
    assert built.columns == s.HISTORY.names
    assert [f.dataType for f in built.schema] == [f.dataType for f in s.HISTORY]
    assert x.same(built, x.history(spark))


@pytest.mark.parametrize("build", BUILDS)
def test_empty_feeds(spark, build):
    assert build(x.feeds(spark, [], [], []), x.RUN_TS).count() == 0


def one(df, *columns):
    return [tuple(r) for r in df.orderBy("purchase_id", "transaction_date").select(*columns).collect()]


@pytest.mark.parametrize("build", BUILDS)
def test_last_event_of_the_day_wins_and_ties_are_settled(spark, build):
    rows = [
        x.event("2024-01-01 10:00:00", 1, buyer=1),
        x.event("2024-01-01 11:00:00", 1, buyer=2),
        x.event("2024-01-01 09:00:00", 1, buyer=3),
        x.event("2024-01-01 10:00:00", 2, buyer=8),
        x.event("2024-01-01 10:00:00", 2, buyer=7),
    ]
    for order in (rows, rows[::-1]):
        built = build(x.feeds(spark, order, [], []), x.RUN_TS)
        assert one(built, "purchase_id", "buyer_id") == [(1, 2), (2, 8)]


@pytest.mark.parametrize("build", BUILDS)
def test_tiebreak_column_decides_before_the_payload(spark, build):
    rows = [
        x.event("2024-01-01 10:00:00", 1, buyer=9),
        x.event("2024-01-01 10:00:00", 1, buyer=2),
    ]
    events = x.purchase(spark, *rows).withColumn("seq", 100 - F.col("buyer_id"))
    others = x.feeds(spark, [], [], [])
    empty = [f.events.withColumn("seq", F.lit(0).cast("long")) for f in others[1:]]
    built = build(purchase_feeds(events, *empty, tiebreak=("seq",)), x.RUN_TS)
    assert one(built, "buyer_id") == [(2,)]


@pytest.mark.parametrize("build", BUILDS)
def test_fill_is_per_column_and_never_cleared_by_null(spark, build):
    rows = [
        x.event("2024-01-01 10:00:00", 1, release="2024-01-01", buyer=1),
        x.event("2024-01-02 08:00:00", 1, release="2024-01-02", buyer=2),
        x.event("2024-01-02 09:00:00", 1, release=None, buyer=None),
        x.event("2024-01-03 09:00:00", 1, status="CANCELADA", release=None, buyer=4),
    ]
    built = build(x.feeds(spark, rows, [], []), x.RUN_TS)
    # Day two: its last event has nulls, so the values come from day one, not from 08:00.
    assert one(built, "release_date", "buyer_id", "is_gmv_eligible", "is_current") == [
        (x.day("2024-01-01"), 1, True, False),
        (x.day("2024-01-01"), 1, True, False),
        (x.day("2024-01-01"), 4, False, True),
    ]


@pytest.mark.parametrize("build", BUILDS)
def test_missing_status_is_not_eligible(spark, build):
    built = build(x.feeds(spark, [x.event("2024-01-01 10:00:00", 1, status=None)], [], []), x.RUN_TS)
    assert one(built, "is_gmv_eligible") == [(False,)]


@pytest.mark.parametrize("build", BUILDS)
def test_ids_beyond_double_precision_stay_exact(spark, build):
    big = 2**53 + 1
    rows = [x.event("2024-01-01 10:00:00", big, buyer=big)]
    built = build(x.feeds(spark, rows, [("2024-01-02 10:00:00", "2024-01-02", big, 1, 1, 1)], []), x.RUN_TS)
    assert one(built, "purchase_id", "buyer_id") == [(big, big)] * 2


@pytest.mark.parametrize("build", BUILDS)
def test_events_without_key_day_or_time_are_set_aside(spark, build):
    bad = [
        x.event("2024-01-01 10:00:00", None),
        ("2024-01-01 10:00:00", None, 1, *x.event("2024-01-01", 1)[3:]),
        (None, "2024-01-01", 1, *x.event("2024-01-01", 1)[3:]),
    ]
    good = x.event("2024-01-01 09:00:00", 1, buyer=77)
    built = build(x.feeds(spark, [*bad, good], [], []), x.RUN_TS)
    assert one(built, "buyer_id") == [(77,)]
    events = x.purchase(spark, *bad, good)
    assert accepted(events).count() == 1
    assert sorted(r["reject_reason"] for r in quarantined(events).collect()) == [
        "purchase_id",
        "transaction_date",
        "transaction_datetime",
    ]


def test_transaction_date_is_taken_as_given(spark):
    rows = [x.event("2024-01-05 10:00:00", 1, day="2024-01-02")]
    assert one(build_history(x.feeds(spark, rows, [], []), x.RUN_TS), "transaction_date") == [
        (x.day("2024-01-02"),)
    ]


def test_step_operators(spark):
    feeds = x.feeds(spark)
    assert last_of_day(feeds[1]).columns == ["purchase_id", "transaction_date", *s.PRODUCT_ITEM_PAYLOAD]
    spine = event_spine(feeds)
    assert spine.count() == 10
    assert spine.agg(F.sum("has_purchase"), F.sum("has_product_item"), F.sum("has_extra_info")).first()[
        :
    ] == (5, 4, 4)
    flags = mark_current(spine).where("is_current").select("purchase_id").collect()
    assert sorted(r[0] for r in flags) == [55, 56, 69]
    gaps = spark.createDataFrame(
        [(1, x.day("2024-01-02"), None), (1, x.day("2024-01-03"), 4), (1, x.day("2024-01-05"), None)],
        "purchase_id long, transaction_date date, v long",
    )
    filled = forward_fill(gaps, ["v"]).orderBy("transaction_date").collect()
    assert [r["v"] for r in filled] == [None, 4, 4]


# ---- against a rebuild in plain Python -----------------------------------------------------


def rebuild(p_rows, pi_rows, ei_rows):
    """Dictionaries and loops: what the definition says, nothing shared with the library."""
    sources = [
        ("purchase", p_rows, [f.name for f in s.PURCHASE_EVENTS], s.PURCHASE_PAYLOAD),
        ("product_item", pi_rows, [f.name for f in s.PRODUCT_ITEM_EVENTS], s.PRODUCT_ITEM_PAYLOAD),
        ("purchase_extra_info", ei_rows, [f.name for f in s.EXTRA_INFO_EVENTS], s.EXTRA_INFO_PAYLOAD),
    ]
    days = {}
    for source, rows, names, payload in sources:
        latest = {}
        for row in rows:
            event = dict(zip(names, row))
            at = (event["purchase_id"], event["transaction_date"])
            if at not in latest or latest[at]["transaction_datetime"] < event["transaction_datetime"]:
                latest[at] = event
        for at, event in latest.items():
            days.setdefault(at, {})[source] = {c: event[c] for c in payload}
    out, known = [], {}
    for (pid, date), touched in sorted(days.items()):
        carried = known.setdefault(pid, {})
        for values in touched.values():
            carried.update({c: v for c, v in values.items() if v is not None})
        newest = not any(p == pid and d > date for p, d in days)
        eligible = carried.get("release_date") is not None and carried.get("purchase_status") == "APROVADA"
        names = ",".join(source for source, *_ in sources if source in touched)
        payload = [carried.get(c) for *_, columns in sources for c in columns]
        out.append((date, pid, *payload, newest, eligible, names, "2023-07-20 06:00:00"))
    return out


@pytest.mark.parametrize("seed,hot_share", [(1, 0.0), (2, 0.4), (3, 0.9)])
def test_agrees_with_plain_python(spark, seed, hot_share):
    p, pi, ei = x.random_events(seed, hot_share)
    expected = x.frame(spark, s.HISTORY, rebuild(p, pi, ei))
    for build in BUILDS:
        assert x.same(build(x.feeds(spark, p, pi, ei), x.RUN_TS), expected)


def test_row_order_and_partitioning_do_not_matter(spark):
    p, pi, ei = x.random_events(4, 0.5)
    expected = build_history(x.feeds(spark, p, pi, ei), x.RUN_TS)
    shuffled = x.feeds(spark, p[::-1], sorted(pi, key=str), ei)
    moved = [
        Feed(f.source, f.flag, f.events.repartition(7, "transaction_date"), f.payload)
        for f in shuffled
    ]
    assert x.same(build_history(moved, x.RUN_TS), expected)
