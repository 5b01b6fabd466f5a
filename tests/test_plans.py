"""The shape of the physical plans: shuffles, pushed filters, no Python in the data path."""

from __future__ import annotations

import datetime as dt
import os

import pytest

import samples as x
from daybook import schemas as s
from daybook.operators import as_of
from daybook.plans import (
    audit,
    build_history,
    build_history_literal,
    gmv_daily,
    read_history,
    top_producers,
    top_products,
    write_history,
)
from daybook.plans.quality import run_checks
from daybook.sources import purchase_feeds


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Feeds, history and current tables as Parquet, so that scans show what reaches them."""
    root = str(tmp_path_factory.mktemp("plans"))
    feeds = []
    for feed in x.feeds(spark):
        feed.events.write.parquet(f"{root}/{feed.source}")
        feeds.append(spark.read.parquet(f"{root}/{feed.source}"))
    write_history(x.history(spark), f"{root}/history")
    x.frame(spark, s.PURCHASE_CURRENT, x.PURCHASE_CURRENT_ROWS).write.parquet(f"{root}/p")
    x.frame(spark, s.PRODUCT_ITEM_CURRENT, x.ITEM_CURRENT_ROWS).write.parquet(f"{root}/pi")
    return {
        "feeds": purchase_feeds(*feeds),
        "history": read_history(spark, f"{root}/history"),
        "purchase": spark.read.parquet(f"{root}/p"),
        "item": spark.read.parquet(f"{root}/pi"),
    }


def test_history_build_shuffles_twice_and_pre_aggregates(stored):
    text = plan(build_history(stored["feeds"], x.RUN_TS))
    assert text.count("Exchange hashpartitioning") == 2 and text.count("Exchange") == 2
    assert text.index("partial_max") > text.index("Exchange hashpartitioning(purchase_id")
    assert "Join" not in text and "Python" not in text
    assert text.count("Window [") == 1
    literal = plan(build_history_literal(stored["feeds"], x.RUN_TS))
    assert literal.count("Exchange") > 2 and "Python" not in literal


@pytest.mark.parametrize("name", ["purchase_history", "event_spine", "updated_sources", "current_flags"])
def test_a_shared_log_is_scanned_once(spark, name):
    from registered.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    assert plan(QUERIES[name](spark, sf)).count("FileScan parquet") == 1


def test_registered_reports_prune(spark):
    from registered import queries as q

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    text = plan(q.top_producers_year(spark, sf))
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01" in text and "LessThan(l_shipdate,1999-01-01" in text
    for query in (q.gmv_at_cutoff, q.gmv_at_cutoff_month, q.as_of_snapshot):
        text = plan(query(spark, sf))
        filters = text[text.index("PartitionFilters: [") :].split("]")[0]
        assert "2024-01-15" in filters
    text = plan(q.items_by_partition(spark, sf))
    pruned = [part.split("]")[0] for part in text.split("PartitionFilters: [")[1:]]
    assert len(pruned) == 2 and all("= 6" in filters for filters in pruned)


def test_history_build_reads_no_unused_column(stored):
    assert "item_quantity" not in plan(build_history(stored["feeds"], x.RUN_TS))


def test_audit_lookup_reaches_every_scan(stored):
    text = plan(audit(build_history(stored["feeds"], x.RUN_TS), 55))
    assert text.count("EqualTo(purchase_id,55)") == 3
    assert "EqualTo(purchase_id,55)" in plan(audit(stored["history"], 55))


def test_current_gmv_pushes_its_flags_and_reads_five_columns(stored):
    text = plan(gmv_daily(stored["history"]))
    assert "EqualTo(is_current,true)" in text and "EqualTo(is_gmv_eligible,true)" in text
    scan = text[text.index("FileScan parquet") :].split("]")[0]
    assert "buyer_id" not in scan and "etl_loaded_at" not in scan


def test_cutoff_prunes_partitions_and_shuffles_once(stored):
    text = plan(as_of(stored["history"], dt.date(2023, 3, 1)))
    filters = text[text.index("PartitionFilters") :].split("]")[0]
    assert "transaction_date" in filters and "2023-03-01" in filters
    assert text.count("Exchange") == 1 and "partial_max" in text


def test_year_is_a_pushed_range_and_the_top_is_taken_per_task(stored):
    text = plan(top_producers(stored["purchase"], stored["item"], 2021))
    assert "GreaterThanOrEqual(release_date,2021-01-01)" in text
    assert "LessThan(release_date,2022-01-01)" in text
    assert "TakeOrderedAndProject(limit=50" in text
    assert "partial_count" in text and "Cartesian" not in text and "NestedLoop" not in text


def test_item_partition_prunes_both_sides_of_the_revenue_join(spark, tmp_path):
    for name, schema, rows in [
        ("p", s.PURCHASE_CURRENT, x.PURCHASE_CURRENT_ROWS),
        ("pi", s.PRODUCT_ITEM_CURRENT, x.ITEM_CURRENT_ROWS),
    ]:
        table = x.frame(spark, schema, rows)
        table.write.partitionBy("prod_item_partition").parquet(str(tmp_path / name))
    purchase, item = (spark.read.parquet(str(tmp_path / name)) for name in ("p", "pi"))
    text = plan(top_producers(purchase.where("prod_item_partition = 6"), item, 2021))
    pruned = [part.split("]")[0] for part in text.split("PartitionFilters: [")[1:]]
    assert len(pruned) == 2 and all("= 6" in filters for filters in pruned)


def test_products_are_pruned_to_n_before_the_shuffle_by_producer(stored):
    text = plan(top_products(stored["purchase"], stored["item"], 2))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
    shuffle = text.index("Exchange hashpartitioning(producer_id#", text.index("WindowGroupLimit"))
    assert "WindowGroupLimit" in text[shuffle:]


def test_keeping_ties_never_ranks_them_in_one_window(stored):
    text = plan(top_products(stored["purchase"], stored["item"], 2, ties="keep"))
    assert "rank(" not in text.replace("row_number(", "")
    assert text.count("WindowGroupLimit") == 2


def test_checks_move_counters_and_keys_only(stored):
    text = plan(run_checks(stored["history"], x.RUN_DATE, x.NOW))
    assert text.count("FileScan parquet") == 2
    keys = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(keys) == 2 and "Cartesian" not in text and "NestedLoop" not in text
