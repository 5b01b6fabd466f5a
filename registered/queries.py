"""One callable per operator or report: (spark, folder of the given tables) -> DataFrame."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import (
    as_of,
    as_of_each,
    attach,
    event_spine,
    forward_fill,
    last_of_day,
    mark_current,
    top_k_per_group,
)
from daybook.functions import gmv_eligible, provenance
from daybook.plans import (
    DailyStore,
    DataQualityError,
    audit,
    build_history,
    build_history_literal,
    create_history_table,
    current,
    export_csv,
    gate,
    gmv_as_of,
    gmv_at,
    gmv_at_each,
    gmv_daily,
    gmv_deltas,
    producer_products,
    publish,
    read_history,
    run_checks,
    save_colocated,
    top_producers,
    top_products,
    write_history,
    write_items,
)
from daybook.plans.quality import current_rows_per_entity as current_rows
from daybook.plans.quality import duplicate_keys as duplicates
from daybook.schemas import PURCHASE_EVENTS
from daybook.sources import (
    Feed,
    load_table,
    normalize,
    quarantined,
    read_csv,
    register_views,
    shared_folder,
    split_csv,
)
from registered import bindings as b

# ---- revenue -----------------------------------------------------------------------------


def top_producers_year(spark: SparkSession, sf: str) -> DataFrame:
    return top_producers(b.purchases(spark, sf, b.YEAR), b.items(spark, sf), b.YEAR, 50)


def items_by_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Both current tables laid out by item partition, and a report that reads one of them."""
    one = F.col("prod_item_partition") == b.ITEM_PARTITION
    tables = []
    for name, table in (("purchases", b.purchases(spark, sf)), ("items", b.items(spark, sf))):
        path = shared_folder(spark, name)
        write_items(table, path)
        tables.append(spark.read.schema(table.schema).parquet(path).where(one))
    return top_producers(*tables, b.YEAR, 50)


def revenue_colocated(spark: SparkSession, sf: str) -> DataFrame:
    """Both current tables bucketed by the item key: counted and joined without a shuffle of either."""
    tables = []
    for name, table in (("purchases", b.purchases(spark, sf)), ("items", b.items(spark, sf))):
        tables.append(save_colocated(table, f"{name}_{uuid.uuid4().hex}", shared_folder(spark, name), 8))
    return producer_products(*tables)


def producer_product_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return producer_products(b.purchases(spark, sf), b.items(spark, sf))


def top2_products_per_producer(spark: SparkSession, sf: str) -> DataFrame:
    return top_products(b.purchases(spark, sf), b.items(spark, sf), 2)


def top2_products_with_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Ranked by number of sales, where ties do occur."""
    sales = (
        b.purchases(spark, sf)
        .where(gmv_eligible())
        .groupBy("producer_id", "prod_item_id")
        .agg(F.count(F.lit(1)).alias("sales"))
    )
    return top_k_per_group(sales, "producer_id", "sales", 2, ["prod_item_id"], ties="keep")


def top_producers_sql_views(spark: SparkSession, sf: str) -> DataFrame:
    """Plain SQL over named tables."""
    register_views(purchase=b.purchases(spark, sf), product_item=b.items(spark, sf))
    report = spark.sql(
        f"""
        SELECT producer_id, CAST(SUM(purchase_value) AS DECIMAL(38, 2)) AS revenue
        FROM purchase JOIN product_item USING (prod_item_id, prod_item_partition)
        WHERE purchase_status = 'APROVADA'
          AND release_date >= DATE '{b.YEAR}-01-01' AND release_date < DATE '{b.YEAR + 1}-01-01'
        GROUP BY producer_id
        ORDER BY revenue DESC, producer_id
        LIMIT 50
        """
    )
    for name in ("purchase", "product_item"):  # the report keeps what they stood for
        spark.catalog.dropTempView(name)
    return report


def revenue_sql_over_files(spark: SparkSession, sf: str) -> DataFrame:
    """Plain SQL with file paths for table names."""
    return spark.sql(
        f"""
        SELECT l_suppkey AS producer_id, p_brand AS brand,
               CAST(SUM(CAST(p_retailprice AS DECIMAL(18, 2))) AS DECIMAL(38, 2)) AS revenue
        FROM parquet.`{sf}/lineitem.parquet` JOIN parquet.`{sf}/part.parquet`
          ON l_partkey = p_partkey
        WHERE l_linestatus = 'F' AND l_returnflag <> 'R'
        GROUP BY l_suppkey, p_brand
        """
    )


# ---- feeds -------------------------------------------------------------------------------


def normalized_purchase_feed(spark: SparkSession, sf: str) -> DataFrame:
    return normalize(b.raw_purchase_text(spark, sf), PURCHASE_EVENTS)


def csv_feed_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Export the raw feed as CSV, read it back by contract."""
    path = shared_folder(spark, "csv-feed")
    export_csv(b.raw_purchase_text(spark, sf).select(*PURCHASE_EVENTS.names), path)
    return read_csv(spark, path, PURCHASE_EVENTS)


def csv_malformed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV export with damaged lines: those are stored with their reason, the others are read."""
    path = shared_folder(spark, "csv-damaged")
    b.damaged_feed(spark, sf).write.option("header", True).option("quote", "").csv(path)
    rows, lines = split_csv(spark, path, PURCHASE_EVENTS, shared_folder(spark, "csv-rejects"))
    counts = lines.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("lines"))
    whole = rows.agg(F.lit("none").alias("reject_reason"), F.count("purchase_id").alias("lines"))
    return counts.unionByName(whole)


def quarantined_events(spark: SparkSession, sf: str) -> DataFrame:
    return (
        quarantined(b.unplaced_events(spark, sf))
        .groupBy("reject_reason")
        .agg(F.count(F.lit(1)).alias("events"))
    )


# ---- history, step by step ---------------------------------------------------------------


def last_of_day_purchase(spark: SparkSession, sf: str) -> DataFrame:
    return last_of_day(b.feeds(spark, sf)[0])


def spine(spark: SparkSession, sf: str) -> DataFrame:
    return event_spine(b.feeds(spark, sf))


def attached_sources(spark: SparkSession, sf: str) -> DataFrame:
    feeds = b.feeds(spark, sf)
    return attach(event_spine(feeds), feeds)


def forward_filled(spark: SparkSession, sf: str) -> DataFrame:
    feeds = b.feeds(spark, sf)
    wide = attach(event_spine(feeds), feeds)
    return forward_fill(wide, [name for feed in feeds for name in feed.payload])


def current_flags(spark: SparkSession, sf: str) -> DataFrame:
    return mark_current(spine(spark, sf)).select("purchase_id", "transaction_date", "is_current")


def eligibility_flags(spark: SparkSession, sf: str) -> DataFrame:
    return forward_filled(spark, sf).select(
        "purchase_id", "transaction_date", gmv_eligible().alias("is_gmv_eligible")
    )


def updated_sources(spark: SparkSession, sf: str) -> DataFrame:
    feeds = b.feeds(spark, sf)
    touched = {feed.source: F.col(feed.flag) == 1 for feed in feeds}
    return event_spine(feeds).select(
        "purchase_id", "transaction_date", provenance(touched).alias("updated_sources")
    )


def purchase_history(spark: SparkSession, sf: str) -> DataFrame:
    return build_history(b.feeds(spark, sf), b.RUN_TS)


def purchase_history_literal(spark: SparkSession, sf: str) -> DataFrame:
    return build_history_literal(b.feeds(spark, sf), b.RUN_TS)


# ---- questions to the history ------------------------------------------------------------


_VERSIONS: dict[tuple[str, str], str] = {}


def _published(spark: SparkSession, sf: str) -> str:
    """The history, published behind the gate once for each session and folder: the path of its version."""
    made = (spark.sparkContext.applicationId, sf)
    if made not in _VERSIONS:
        _VERSIONS[made] = _publish(spark, sf)
    return _VERSIONS[made]


def _publish(spark: SparkSession, sf: str) -> str:
    root, view = shared_folder(spark, "published"), f"history_{uuid.uuid4().hex}"
    feeds = b.feeds(spark, sf)
    publish(build_history(feeds, b.RUN_TS), root, "v1", view, b.RUN_DATE, b.NOW, feeds=feeds)
    for name in (view, f"{view}_current", f"{view}_rejected"):
        spark.sql(f"DROP VIEW {name}")
    return f"{root}/v1"


def _stored_history(spark: SparkSession, sf: str) -> DataFrame:
    return read_history(spark, _published(spark, sf))


def _stored_current(spark: SparkSession, sf: str) -> DataFrame:
    return read_history(spark, _published(spark, sf) + "-current")


def gmv_daily_current(spark: SparkSession, sf: str) -> DataFrame:
    return gmv_daily(_stored_current(spark, sf))


def gmv_at_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    return gmv_as_of(_stored_history(spark, sf), b.CUTOFF)


def gmv_at_cutoff_month(spark: SparkSession, sf: str) -> DataFrame:
    return gmv_as_of(_stored_history(spark, sf), b.CUTOFF, "release_date", b.MONTH)


def as_of_each_day(spark: SparkSession, sf: str) -> DataFrame:
    """Every purchase as known on every day of the history: a table of requests, answered at once."""
    history = _stored_history(spark, sf)
    days = history.select(F.col("transaction_date").alias("cutoff")).distinct()
    requests = history.select("purchase_id").distinct().crossJoin(F.broadcast(days))
    return as_of_each(history, requests, columns=b.VERSION_COLUMNS)


def _stored_deltas(spark: SparkSession, sf: str) -> DataFrame:
    return _stored(gmv_deltas(_stored_history(spark, sf)), "deltas")


def gmv_from_deltas(spark: SparkSession, sf: str) -> DataFrame:
    keys = {"order_date": "data_compra", "purchase_id": "id_compra", "subsidiary": "subsidiaria"}
    return gmv_at(_stored_deltas(spark, sf), b.CUTOFF, keys)


def gmv_every_day(spark: SparkSession, sf: str) -> DataFrame:
    """GMV by subsidiary as the books stood on every day of the history."""
    days = _stored_history(spark, sf).select(F.col("transaction_date").alias("cutoff"))
    return gmv_at_each(_stored_deltas(spark, sf), days, {"subsidiary": "subsidiaria"})


def as_of_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return as_of(_stored_history(spark, sf), b.CUTOFF)


def current_state(spark: SparkSession, sf: str) -> DataFrame:
    return current(_stored_current(spark, sf))


def audit_entity(spark: SparkSession, sf: str) -> DataFrame:
    return audit(purchase_history(spark, sf), b.PURCHASE_ID)


def audit_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The audit on the stored history, whose files have Bloom filters of the purchase."""
    return audit(_stored_history(spark, sf), b.PURCHASE_ID)


def audit_entity_eligible(spark: SparkSession, sf: str) -> DataFrame:
    return audit(purchase_history(spark, sf), b.PURCHASE_ID, eligible_only=True)


# ---- quality -----------------------------------------------------------------------------


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    """Checks read their input twice, so a computed history is written once before."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    return run_checks(_stored(purchase_history(spark, sf), "checked"), b.RUN_DATE, b.NOW)


def quality_report_dirty(spark: SparkSession, sf: str) -> DataFrame:
    dirty = b.plant(_stored(purchase_history(spark, sf), "sound"))
    return run_checks(dirty, b.RUN_DATE, b.NOW)


def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return duplicates(b.plant(purchase_history(spark, sf)))


def current_rows_per_entity(spark: SparkSession, sf: str) -> DataFrame:
    return current_rows(b.plant(purchase_history(spark, sf)))


# ---- storage -----------------------------------------------------------------------------


def history_roundtrip_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """Store by day, then ask for a past state: only partitions up to the cutoff are read."""
    path = shared_folder(spark, "history")
    write_history(purchase_history(spark, sf), path)
    return as_of(read_history(spark, path), b.CUTOFF)


def gate_failures(spark: SparkSession, sf: str) -> DataFrame:
    """The names of the critical checks that block a faulty history."""
    dirty = b.plant(_stored(purchase_history(spark, sf), "sound"))
    try:
        gate(run_checks(dirty, b.RUN_DATE, b.NOW))
    except DataQualityError as blocked:
        return blocked.report.where("critical AND NOT passed").select("check")
    raise AssertionError("the planted faults were let through")


def published_after_refusal(spark: SparkSession, sf: str) -> DataFrame:
    """A sound version, then a faulty one, which the gate refuses: the view shows the first."""
    root, view = shared_folder(spark, "refused"), f"history_{uuid.uuid4().hex}"
    sound = purchase_history(spark, sf)
    publish(sound, root, "v1", view, b.RUN_DATE, b.NOW)
    try:
        publish(b.plant(sound), root, "v2", view, b.RUN_DATE, b.NOW)
    except DataQualityError:
        shown = spark.table(view).select(*sound.columns)
        for name in (view, f"{view}_current"):
            spark.sql(f"DROP VIEW {name}")
        return shown
    raise AssertionError("the planted faults were let through")


def history_in_catalog_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table defined in the catalog, loaded and read by name."""
    name = f"history_{uuid.uuid4().hex}"
    create_history_table(spark, name, shared_folder(spark, "table"))
    history = purchase_history(spark, sf)
    columns = spark.table(name).columns
    history.select(*columns).write.insertInto(name)
    by_name = _stored(spark.table(name).select(*history.columns), "by-name")
    spark.sql(f"DROP TABLE {name}")
    return by_name


def _last_day(feeds: list[Feed]) -> dt.date:
    return feeds[0].log.agg(F.max("transaction_date")).first()[0]


def _loaded(spark: SparkSession, sf: str, state_every: int, days_back: tuple[int, ...]) -> DailyStore:
    """All events loaded in day order: the first of `days_back` before the last day at once, then one
    load for each of the others."""
    feeds = b.feeds(spark, sf)
    last = _last_day(feeds)
    store = DailyStore(spark, shared_folder(spark, "daily"), state_every)
    store.start(feeds, last - dt.timedelta(days=days_back[0]), b.RUN_TS)
    for back in days_back[1:]:
        store.append_day(feeds, last - dt.timedelta(days=back), b.RUN_TS)
    return store


def incremental_history(spark: SparkSession, sf: str) -> DataFrame:
    """Day by day, the last day twice."""
    return _loaded(spark, sf, 7, (3, 2, 1, 0, 0)).history()


def incremental_current(spark: SparkSession, sf: str) -> DataFrame:
    return _loaded(spark, sf, 1, (2, 1, 0, 0)).current()


def incremental_skipped_days(spark: SparkSession, sf: str) -> DataFrame:
    """Loads that leave out days: the next one brings them."""
    return _loaded(spark, sf, 2, (9, 5, 1, 0)).history()


def rejected_events_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Events that can't be placed, as a daily store keeps them."""
    log = b.event_log(load_table(spark, sf, "events"))
    last = log.agg(F.max("transaction_date")).first()[0]
    store = DailyStore(spark, shared_folder(spark, "rejected"))
    store.start(b.feeds_of(b.unplaced(log)), last, b.RUN_TS)
    kept = store.rejected().groupBy("source", "reject_reason")
    return kept.agg(F.count(F.lit(1)).alias("events"))


def rebuilt_history(spark: SparkSession, sf: str) -> DataFrame:
    """Loads that missed the last two hours of every day, then those events, late, and a
    rebuild of the purchases they belong to."""
    feeds = b.feeds(spark, sf)
    late = F.hour("transaction_datetime") >= 22
    last = _last_day(feeds)
    store = DailyStore(spark, shared_folder(spark, "rebuilt"))
    store.start([feed.where(~late) for feed in feeds], last, b.RUN_TS)
    batch = [feed.where(late) for feed in feeds]
    store.rebuild(feeds, store.late_purchases(batch), b.RUN_TS)
    return store.history()


QUERIES = {
    "top_producers_year": top_producers_year,
    "producer_product_revenue": producer_product_revenue,
    "revenue_colocated": revenue_colocated,
    "top2_products_per_producer": top2_products_per_producer,
    "top2_products_with_ties": top2_products_with_ties,
    "top_producers_sql_views": top_producers_sql_views,
    "revenue_sql_over_files": revenue_sql_over_files,
    "normalized_purchase_feed": normalized_purchase_feed,
    "csv_feed_roundtrip": csv_feed_roundtrip,
    "csv_malformed_lines": csv_malformed_lines,
    "quarantined_events": quarantined_events,
    "last_of_day_purchase": last_of_day_purchase,
    "event_spine": spine,
    "attached_sources": attached_sources,
    "forward_filled": forward_filled,
    "current_flags": current_flags,
    "eligibility_flags": eligibility_flags,
    "updated_sources": updated_sources,
    "purchase_history": purchase_history,
    "purchase_history_literal": purchase_history_literal,
    "gmv_daily_current": gmv_daily_current,
    "gmv_as_of": gmv_at_cutoff,
    "gmv_as_of_month": gmv_at_cutoff_month,
    "as_of_each_day": as_of_each_day,
    "gmv_from_deltas": gmv_from_deltas,
    "gmv_every_day": gmv_every_day,
    "as_of_snapshot": as_of_snapshot,
    "current_state": current_state,
    "audit_entity": audit_entity,
    "audit_stored": audit_stored,
    "audit_entity_eligible": audit_entity_eligible,
    "quality_report": quality_report,
    "quality_report_dirty": quality_report_dirty,
    "duplicate_keys": duplicate_keys,
    "current_rows_per_entity": current_rows_per_entity,
    "history_roundtrip_pruned": history_roundtrip_pruned,
    "items_by_partition": items_by_partition,
    "gate_failures": gate_failures,
    "published_after_refusal": published_after_refusal,
    "history_in_catalog_table": history_in_catalog_table,
    "rejected_events_stored": rejected_events_stored,
    "incremental_skipped_days": incremental_skipped_days,
    "incremental_history": incremental_history,
    "incremental_current": incremental_current,
    "rebuilt_history": rebuilt_history,
}
