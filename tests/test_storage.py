"""Reading raw files, storing histories, publishing, and loading day by day."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import samples as x
from daybook import schemas as s
from daybook.operators import as_of, as_of_each, mark_current
from daybook.plans import (
    DailyStore,
    DataQualityError,
    build_history,
    create_history_table,
    current,
    export_csv,
    gmv_as_of,
    gmv_at,
    gmv_at_each,
    gmv_deltas,
    publish,
    read_history,
    run_checks,
    save_colocated,
    write_history,
)
from daybook.plans.daily import changed_days
from daybook.sources import normalize, read_csv, register_views, shared_folder, split_csv

# ---- raw files -----------------------------------------------------------------------------


def text_feed(spark, **values):
    given = {
        "transaction_datetime": "2023-01-20 22:00:00",
        "transaction_date": "2023-01-20",
        "purchase_id": "55",
        "purchase_total_value": "500.0",
        **values,
    }
    names = s.PURCHASE_EVENTS.names
    schema = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([tuple(given.get(n) for n in names)], schema)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "column,text",
    [
        ("transaction_datetime", "yesterday"),
        ("transaction_date", "2023-01-20 x"),
        ("purchase_id", "5x"),
        ("purchase_total_value", "much"),
    ],
)
def test_strict_columns_fail_on_bad_text(spark, ansi, column, text):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="not a"):
            normalize(text_feed(spark, **{column: text}), s.PURCHASE_EVENTS).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_lenient_and_blank_values(spark):
    row = normalize(
        text_feed(
            spark,
            order_date="x",
            release_date="2023-01-20 23:59:59",
            buyer_id=" ",
            producer_id="852852.0",
            transaction_date="2023-01-20 05:00:00",
        ),
        s.PURCHASE_EVENTS,
    ).first()
    assert row["order_date"] is None and row["buyer_id"] is None
    assert row["release_date"] == row["transaction_date"] == x.day("2023-01-20")
    assert row["producer_id"] == 852852 and row["purchase_total_value"] == x.money(500)
    assert row["transaction_datetime"] == x.clock("2023-01-20 22:00:00")


def test_csv_files_give_the_same_history(spark, tmp_path):
    feeds = x.feeds(spark)
    schemas = [s.PURCHASE_EVENTS, s.PRODUCT_ITEM_EVENTS, s.EXTRA_INFO_EVENTS]
    read = []
    for feed, schema in zip(feeds, schemas):
        export_csv(feed.events, str(tmp_path / feed.source))
        read.append(read_csv(spark, str(tmp_path / feed.source), schema))
        assert x.same(read[-1], feed.events)
    from daybook.sources import purchase_feeds

    assert x.same(build_history(purchase_feeds(*read), x.RUN_TS), x.history(spark))


def test_a_history_written_by_a_float_id_tool_can_be_read(spark, tmp_path):
    (tmp_path / "h.csv").write_text(
        ",".join(s.HISTORY.names)
        + "\n2023-01-20,55,15947.0,5.0,2023-01-20,,852852.0,500.0,APROVADA,5.0,,696969.0,50.0,,"
        + 'False,True,"purchase,product_item",2026-04-25 16:21:31\n'
    )
    row = read_csv(spark, str(tmp_path / "h.csv"), s.HISTORY).first()
    assert (row["buyer_id"], row["prod_item_partition"], row["subsidiary"]) == (15947, None, None)
    assert (row["is_current"], row["is_gmv_eligible"]) == (False, True)
    assert row["updated_sources"] == "purchase,product_item"
    assert row["purchase_total_value"] == x.money(500)


def test_csv_with_another_header_is_refused(spark, tmp_path):
    export_csv(x.feeds(spark)[2].events.withColumnRenamed("subsidiary", "branch"), str(tmp_path / "f"))
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv(spark, str(tmp_path / "f"), s.EXTRA_INFO_EVENTS).collect()


# ---- storing and publishing ----------------------------------------------------------------


def test_roundtrip_by_day(spark, tmp_path):
    path = str(tmp_path / "history")
    write_history(x.history(spark), path)
    stored = read_history(spark, path)
    assert stored.columns == s.HISTORY.names and x.same(stored, x.history(spark))
    plan = as_of(stored, "2023-01-25", ["purchase_id", "subsidiary"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_date" in text
    assert "buyer_id" not in text


def test_publish_switches_only_after_the_gate(spark, tmp_path):
    root, sound = str(tmp_path), x.history(spark)
    publish(sound, root, "v1", "published_history", x.RUN_DATE, x.NOW)
    assert x.same(spark.table("published_history"), sound)
    with pytest.raises(DataQualityError):
        broken = sound.withColumn("updated_sources", F.lit(""))
        publish(broken, root, "v2", "published_history", x.RUN_DATE, x.NOW)
    assert x.same(spark.table("published_history"), sound)
    grown = sound.where("purchase_id <> 56")
    report = publish(grown, root, "v3", "published_history", x.RUN_DATE, x.NOW)
    assert report.where("passed").count() == 23
    assert spark.table("published_history").columns == s.HISTORY.names
    assert spark.table("published_history").count() == 8


def test_an_empty_history_can_be_published(spark, tmp_path):
    empty = x.history(spark).where("false")
    report = publish(empty, str(tmp_path), "v1", "empty_history", x.RUN_DATE, x.NOW)
    assert report.where("passed").count() == 23
    published = spark.table("empty_history")
    assert published.count() == 0 and published.dtypes == empty.dtypes


def test_table_definition(spark, tmp_path):
    create_history_table(spark, "history_table", str(tmp_path / "t"))
    create_history_table(spark, "history_table", str(tmp_path / "t"))
    x.history(spark).write.mode("append").partitionBy("transaction_date").format("parquet").saveAsTable(
        "history_table"
    )
    assert x.same(spark.table("history_table"), x.history(spark))


def test_plain_sql_over_names_and_paths(spark, tmp_path):
    register_views(purchase_history=x.history(spark))
    path = str(tmp_path / "h")
    write_history(x.history(spark), path)
    for table in ("purchase_history", f"parquet.`{path}`"):
        found = spark.sql(f"SELECT purchase_id, count(*) AS n FROM {table} GROUP BY 1 ORDER BY 1")
        assert [tuple(r) for r in found.collect()] == [(55, 5), (56, 2), (69, 3)]


def test_shared_folder_is_below_the_configured_one(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    a, b = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert a != b and a.startswith(root)


# ---- day by day ----------------------------------------------------------------------------


def touched_days(feeds):
    days = set()
    for feed in feeds:
        days |= {r[0] for r in feed.events.select("transaction_date").distinct().collect()}
    return sorted(days)


@pytest.mark.parametrize("state_every", [1, 30])
def test_loading_day_by_day_equals_the_full_build(spark, tmp_path, state_every):
    feeds = x.feeds(spark)
    days = touched_days(feeds)
    store = DailyStore(spark, str(tmp_path), state_every)
    store.start(feeds, days[1], x.RUN_TS, check=False)
    for day in days[2:]:
        # 2023-01-25 brings a purchase without its purchase event: the gate would hold it back
        store.append_day(feeds, day, x.RUN_TS, check=day > x.day("2023-01-25"))
    full = x.history(spark)
    assert x.same(store.history(), full)
    assert x.same(store.current(), current(full))
    for cutoff in ("2023-01-22", "2023-02-27", "2023-03-01", "2023-07-13"):
        assert x.same(store.as_of(cutoff), as_of(full.drop("is_current"), cutoff))


@pytest.mark.parametrize("seed,state_every", [(11, 2), (12, 9)])
def test_random_loads_with_late_events_equal_the_full_build(spark, tmp_path, seed, state_every):
    rows = x.random_events(seed, hot_share=0.3)
    full = x.feeds(spark, *rows)
    early = x.feeds(spark, *[[r for i, r in enumerate(feed) if i % 9 != seed % 9] for feed in rows])
    late = x.feeds(spark, *[[r for i, r in enumerate(feed) if i % 9 == seed % 9] for feed in rows])
    store = DailyStore(spark, str(tmp_path), state_every)
    store.start(early, "2024-01-03", x.RUN_TS, check=False)
    store.append_day(early, "2024-01-04", x.RUN_TS, check=False)
    store.rebuild(full, store.late_purchases(late), x.RUN_TS, check=False)
    for day in ("2024-01-05", "2024-01-06"):
        store.append_day(full, day, x.RUN_TS, check=False)
    expected = build_history(full, x.RUN_TS)
    assert x.same(store.history(), expected)
    assert x.same(store.current(), current(expected))
    for cutoff in ("2024-01-02", "2024-01-04", "2024-01-05"):
        assert x.same(store.as_of(cutoff), as_of(expected.drop("is_current"), cutoff))


def test_a_day_can_be_loaded_again(spark, tmp_path):
    feeds = x.feeds(spark)
    store = DailyStore(spark, str(tmp_path), state_every=1)
    store.start(feeds, "2023-07-12", x.RUN_TS)
    for _ in range(2):
        store.append_day(feeds, "2023-07-15", x.RUN_TS)
        assert x.same(store.history(), x.history(spark))
    with pytest.raises(ValueError, match="started"):
        store.start(feeds, "2023-07-12", x.RUN_TS)
    corrected = x.feeds(spark, x.PURCHASE_ROWS[:-1])
    store.append_day(corrected, "2023-07-15", x.RUN_TS)
    assert x.same(store.history(), build_history(corrected, x.RUN_TS))
    assert x.same(store.current(), current(build_history(corrected, x.RUN_TS)))
    with pytest.raises(ValueError, match="rebuild"):
        store.append_day(feeds, "2023-01-21", x.RUN_TS)


def test_loaded_days_are_not_touched_again(spark, tmp_path):
    feeds = x.feeds(spark)
    store = DailyStore(spark, str(tmp_path))
    store.start(feeds, "2023-02-28", x.RUN_TS, check=False)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "history").rglob("*.parquet")}
    for day in ("2023-03-12", "2023-07-12", "2023-07-15"):
        store.append_day(feeds, day, x.RUN_TS + dt.timedelta(days=1), check=False)
    assert files and all(p.stat().st_mtime_ns == at for p, at in files.items())


def test_gate_blocks_a_day(spark, tmp_path):
    feeds = x.feeds(spark)
    store = DailyStore(spark, str(tmp_path))
    store.start(feeds, "2023-07-12", x.RUN_TS)
    before = store.history().collect()
    bad = [*x.PURCHASE_ROWS, x.event("2023-07-15 10:00:00", 70, total=-5)]
    with pytest.raises(DataQualityError, match="purchase_total_value>=0"):
        store.append_day(x.feeds(spark, bad), "2023-07-15", x.RUN_TS)
    assert sorted(map(str, store.history().collect())) == sorted(map(str, before))


def test_late_events_rebuild_their_purchases(spark, tmp_path):
    early = x.feeds(spark, x.PURCHASE_ROWS[1:], x.ITEM_ROWS, x.INFO_ROWS[1:])
    store = DailyStore(spark, str(tmp_path), state_every=1)
    store.start(early, "2023-07-12", x.RUN_TS, check=False)
    full = x.feeds(spark)
    batch = x.feeds(spark, x.PURCHASE_ROWS[:1], [], x.INFO_ROWS[:1])
    late = store.late_purchases(batch)
    assert [r[0] for r in late.collect()] == [55]
    store.rebuild(full, late, x.RUN_TS, check=False)
    assert x.same(store.as_of("2023-07-12"), as_of(x.history(spark), "2023-07-12").drop("is_current"))
    # Day 2023-07-12 again, and the next one: states from before the rebuild are void.
    store.append_day(full, "2023-07-12", x.RUN_TS, check=False)
    store.append_day(full, "2023-07-15", x.RUN_TS, check=False)
    assert x.same(store.history(), x.history(spark))
    assert x.same(store.current(), current(x.history(spark)))


def test_events_taken_back_leave_no_day_behind(spark, tmp_path):
    store = DailyStore(spark, str(tmp_path))
    store.start(x.feeds(spark), "2023-07-15", x.RUN_TS, check=False)
    fewer = x.feeds(spark, ei=x.INFO_ROWS[1:])
    store.rebuild(fewer, spark.createDataFrame([(55,)], "purchase_id long"), x.RUN_TS, check=False)
    assert x.same(store.history(), build_history(fewer, x.RUN_TS))


def test_immutable_rows_plus_flag_equal_the_full_history(spark):
    full = x.history(spark)
    assert x.same(mark_current(full.drop("is_current")).select(*full.columns), full)


@pytest.mark.parametrize("text", ["a field too many", "a field too few"])
def test_csv_lines_with_a_wrong_number_of_fields_are_refused(spark, tmp_path, text):
    line = "2023-01-20 22:00:00,2023-01-20,55,nacional" + (",x" if "many" in text else "")
    short = "2023-01-20 22:00:00,2023-01-20,55"
    names = ",".join(s.EXTRA_INFO_EVENTS.names)
    (tmp_path / "f.csv").write_text(f"{names}\n{line if 'many' in text else short}\n")
    for columns in (["subsidiary"], s.EXTRA_INFO_EVENTS.names):
        with pytest.raises(Exception, match="MALFORMED"):
            read_csv(spark, str(tmp_path / "f.csv"), s.EXTRA_INFO_EVENTS).select(*columns).collect()


def test_days_between_loads_are_loaded(spark, tmp_path):
    store = DailyStore(spark, str(tmp_path))
    store.start(x.feeds(spark), "2023-01-20", x.RUN_TS)
    store.append_day(x.feeds(spark), "2023-07-15", x.RUN_TS)
    assert x.same(store.history(), x.history(spark))


def test_a_blocked_day_comes_whole_with_the_next_one(spark, tmp_path):
    feeds = x.feeds(spark)
    store = DailyStore(spark, str(tmp_path), state_every=1)
    store.start(feeds, "2023-01-23", x.RUN_TS)
    with pytest.raises(DataQualityError, match="no_null_current:buyer_id"):
        store.append_day(feeds, "2023-01-25", x.RUN_TS)
    store.append_day(feeds, "2023-01-26", x.RUN_TS)
    store.append_day(feeds, "2023-07-15", x.RUN_TS)
    assert x.same(store.history(), x.history(spark))
    assert x.same(store.as_of("2023-01-25"), as_of(x.history(spark).drop("is_current"), "2023-01-25"))


def test_a_load_that_breaks_off_can_be_run_again(spark, tmp_path, monkeypatch):
    feeds = x.feeds(spark)
    store = DailyStore(spark, str(tmp_path), state_every=1)
    store.start(feeds, "2023-02-28", x.RUN_TS, check=False)
    replace, done = DailyStore._replace, []

    def broken(self, rows, days):
        if done:
            raise KeyboardInterrupt
        done.append(days)
        replace(self, rows, days)

    monkeypatch.setattr(DailyStore, "_replace", broken)
    with pytest.raises(KeyboardInterrupt):
        store.append_day(feeds, "2023-07-15", x.RUN_TS)
    monkeypatch.setattr(DailyStore, "_replace", replace)
    assert done == [[store.last_day()]]  # the first day is in place, whole
    upto = [feed.where(F.col("transaction_date") <= str(store.last_day())) for feed in feeds]
    assert x.same(store.history(), build_history(upto, x.RUN_TS))
    store.append_day(feeds, "2023-07-15", x.RUN_TS)
    assert x.same(store.history(), x.history(spark)) and x.same(store.current(), current(x.history(spark)))


def test_days_are_compared_by_digests(spark):
    rows = [(1, "2024-01-01", 5), (2, "2024-01-01", 6), (1, "2024-01-02", 5), (3, "2024-01-03", 1)]
    frame = lambda rows: spark.createDataFrame(rows, "purchase_id long, d string, digest long").selectExpr(
        "purchase_id", "CAST(d AS DATE) AS transaction_date", "digest"
    )
    old = frame(rows)
    assert changed_days(old, frame(rows[::-1])) == []
    assert changed_days(old, frame([*rows[:2], (1, "2024-01-02", 6), (4, "2024-01-04", 1)])) == [x.day(f"2024-01-0{k}") for k in (2, 3, 4)]
    assert changed_days(old, frame([(1, "2024-01-01", 6), (2, "2024-01-01", 5), *rows[2:]])) == [x.day("2024-01-01")]


def test_a_rebuild_touches_changed_days_only(spark, tmp_path):
    early = x.feeds(spark, pi=x.ITEM_ROWS[:-1])
    later = x.RUN_TS + dt.timedelta(days=1)
    store = DailyStore(spark, str(tmp_path), state_every=1)
    store.start(early, "2023-02-28", x.RUN_TS, check=False)
    for day in ("2023-07-12", "2023-07-15"):
        store.append_day(early, day, x.RUN_TS, check=False)
    batch = x.feeds(spark, [], x.ITEM_ROWS[-1:], [])
    changed = [x.day("2023-07-12"), x.day("2023-07-15")]
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "history").rglob("*.parquet")}
    assert store.rebuild(x.feeds(spark), store.late_purchases(batch), later, check=False) == changed
    left = {p for p, at in files.items() if "2023-07-1" not in str(p)}
    assert left and all(p.exists() and p.stat().st_mtime_ns == files[p] for p in left)
    stamps = {r["transaction_date"]: r["etl_loaded_at"] for r in store.snapshots().where("purchase_id = 55").collect()}
    assert [d for d, at in stamps.items() if at == later.replace(microsecond=0)] == changed
    assert x.same(store.history().drop("etl_loaded_at"), x.history(spark).drop("etl_loaded_at"))
    assert "books/" in str(store.as_of("2023-03-01").inputFiles())
    # all as before: no load
    assert store.rebuild(x.feeds(spark), store.late_purchases(batch), later, check=False) == []


def test_rejected_events_are_stored(spark, tmp_path):
    bad = [*x.PURCHASE_ROWS, x.event("2023-02-01 10:00:00", None), (None, "2023-02-01", *x.event("2023-02-01 10:00:00", 70)[2:])]
    store = DailyStore(spark, str(tmp_path))
    store.start(x.feeds(spark, bad), "2023-07-15", x.RUN_TS)
    assert store.rejected().count() == 2 and x.same(store.history(), x.history(spark))
    found = sorted((r["source"], r["reject_reason"]) for r in store.rejected().collect())
    assert found == [("purchase", "purchase_id"), ("purchase", "transaction_datetime")]
    publish(x.history(spark), str(tmp_path / "p"), "v1", "with_rejects", x.RUN_DATE, x.NOW, feeds=x.feeds(spark, bad))
    assert spark.table("with_rejects_rejected").count() == 2
    assert x.same(spark.table("with_rejects_current"), current(x.history(spark)))


def test_malformed_csv_lines_are_stored_and_the_others_read(spark, tmp_path):
    names = ",".join(s.EXTRA_INFO_EVENTS.names)
    good = ["2023-01-20 22:00:00,2023-01-20,55,nacional", '2023-01-21 22:00:00,2023-01-21,56,"a,b"']
    bad = ["2023-01-20 22:00:00,2023-01-20,55,nacional,x", "2023-01-20 22:00:00,2023-01-20,57", "broken"]
    (tmp_path / "f.csv").write_text("\n".join([names, *good, *bad]) + "\n")
    rows, lines = split_csv(spark, str(tmp_path / "f.csv"), s.EXTRA_INFO_EVENTS, str(tmp_path / "rejects"))
    assert sorted((r["purchase_id"], r["subsidiary"]) for r in rows.collect()) == [(55, "nacional"), (56, "a,b")]
    found = sorted((r["reject_reason"], r["line"]) for r in lines.collect())
    assert found == [("fewer fields", bad[1]), ("fewer fields", bad[2]), ("more fields", bad[0])]


def test_tables_of_one_layout_join_without_a_shuffle(spark, tmp_path):
    made = [(k % 7, k % 3, k % 5, f"p{k}") for k in range(200)]
    sales = spark.createDataFrame(made, "prod_item_id long, prod_item_partition long, producer_id long, note string")
    items = sales.select("prod_item_id", "prod_item_partition").distinct().withColumn("purchase_value", F.lit(2))
    keys = ["prod_item_id", "prod_item_partition"]
    stored = [save_colocated(t, n, str(tmp_path / n), 4) for t, n in ((sales, "sales_b"), (items, "items_b"))]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        counted = stored[0].groupBy("producer_id", *keys).agg(F.count("note").alias("n")).join(stored[1], keys)
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert x.same(counted, sales.groupBy("producer_id", *keys).agg(F.count("note").alias("n")).join(items, keys).select(*counted.columns))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("sales_b", "items_b"):
            spark.sql(f"DROP TABLE {name}")


def test_row_checks_are_counted_while_writing(spark, tmp_path):
    history = x.history(spark)
    report = publish(history, str(tmp_path), "v1", "counted", x.RUN_DATE, x.NOW)
    assert x.same(report, run_checks(history, x.RUN_DATE, x.NOW))
    # what is read back is keys alone
    scans = [line for line in report._jdf.queryExecution().executedPlan().toString().split("\n") if "ReadSchema" in line]
    assert scans and all("purchase_status" not in line for line in scans)


def test_versions_and_deltas_answer_any_cutoff(spark):
    rows = x.random_events(21, hot_share=0.3)
    history = build_history(x.feeds(spark, *rows), x.RUN_TS).drop("is_current").cache()
    days = sorted(r[0] for r in history.select("transaction_date").distinct().collect())
    days = [days[0] - dt.timedelta(days=1), *days, days[-1] + dt.timedelta(days=9)]
    cutoffs = spark.createDataFrame([(d,) for d in days + days[:2]] + [(None,)], "cutoff date")
    asked = as_of_each(history, history.select("purchase_id").distinct().crossJoin(cutoffs)).cache()
    keys = {"order_date": "data_compra", "purchase_id": "id_compra", "subsidiary": "subsidiaria"}
    deltas = gmv_deltas(history).cache()
    each = gmv_at_each(deltas, cutoffs, keys).cache()
    for day in days:
        then = F.col("cutoff") == F.lit(day)
        assert x.same(asked.where(then).select(*history.columns), as_of(history, day))
        expected = gmv_as_of(history, day)
        assert x.same(gmv_at(deltas, day, keys), expected)
        assert x.same(each.where(then).drop("cutoff"), expected)
    empty = history.where("false")
    assert gmv_at_each(gmv_deltas(empty), cutoffs, keys).count() == as_of_each(empty, empty.withColumn("cutoff", F.lit(days[0]))).count() == 0
