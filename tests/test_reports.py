"""Time travel and revenue reports."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import samples as x
from daybook import schemas as s
from daybook.operators import as_of, top_k_per_group
from daybook.plans import (
    audit,
    current,
    gmv_as_of,
    gmv_daily,
    producer_products,
    top_producers,
    top_products,
)


@pytest.fixture(scope="module")
def history(spark):
    return x.history(spark).cache()


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_current_gmv(history):
    assert rows(gmv_daily(history)) == [
        (x.day("2023-02-28"), "internacional", Decimal("2000.00")),
        (x.day("2023-03-01"), "nacional", Decimal("55.00")),
    ]


@pytest.mark.parametrize(
    "cutoff,expected",
    [
        ("2000-01-01", []),
        ("2023-03-01", [("2023-01-20", 55, "nacional", "50.00"), ("2023-02-26", 69, "nacional", "2000.00")]),
        ("2023-03-31", [("2023-01-20", 55, "nacional", "50.00"), ("2023-02-26", 69, "internacional", "2000.00")]),
    ],
)
def test_gmv_as_of(history, cutoff, expected):
    found = rows(gmv_as_of(history, cutoff))
    assert found == [(x.day(d), p, sub, Decimal(v)) for d, p, sub, v in expected]


def test_gmv_as_of_for_one_month(history):
    assert [r["id_compra"] for r in gmv_as_of(history, "2023-03-31", month="2023-01-15").collect()] == [55]


def test_cutoff_answer_does_not_move_when_the_history_grows(spark, history):
    later = [
        *x.PURCHASE_ROWS,
        x.event("2023-08-01 10:00:00", 55, status="CANCELADA", release="2023-08-01"),
    ]
    from daybook.plans import build_history

    grown = build_history(x.feeds(spark, later), x.RUN_TS)
    assert rows(gmv_as_of(grown, "2023-03-31")) == rows(gmv_as_of(history, "2023-03-31"))
    assert [r["subsidiaria"] for r in gmv_daily(grown).collect()] == ["internacional"]


def test_as_of_the_last_day_is_the_current_state(history):
    assert x.same(as_of(history, "2023-12-31"), current(history))
    assert as_of(history, "2023-01-25", ["purchase_id", "subsidiary"]).columns == ["purchase_id", "subsidiary"]


def test_audit(history):
    full = audit(history, 55)
    assert full.columns == s.AUDIT_COLUMNS
    dates = [r["transaction_date"] for r in full.collect()]
    assert len(dates) == 5 and dates == sorted(dates)
    assert audit(history, 55, eligible_only=True).count() == 5
    assert audit(history, 56, eligible_only=True).count() == 0


def test_unknown_subsidiary_is_its_own_group_and_sorts_last(spark, history):
    unknown = history.withColumn("subsidiary", F.when(F.col("purchase_id") != 55, F.col("subsidiary")))
    same_day = unknown.withColumn("release_date", F.lit(x.day("2023-03-01")))
    assert [r[1:] for r in rows(gmv_daily(same_day.where("purchase_id <> 56")))] == [
        ("internacional", Decimal("2000.00")),
        (None, Decimal("55.00")),
    ]


def test_plain_sql_gives_the_same_answers(spark, history):
    history.createOrReplaceTempView("purchase_history")
    daily = spark.sql(
        """SELECT release_date AS data_compra, subsidiary AS subsidiaria, SUM(purchase_value) AS gmv
        FROM purchase_history WHERE is_current AND is_gmv_eligible GROUP BY ALL ORDER BY 1, 2"""
    )
    assert rows(daily) == rows(gmv_daily(history))
    at_cutoff = spark.sql(
        """SELECT version.order_date AS data_compra, purchase_id AS id_compra,
                  version.subsidiary AS subsidiaria, SUM(version.purchase_value) AS gmv
        FROM (SELECT purchase_id, MAX_BY(STRUCT(*), transaction_date) AS version
              FROM purchase_history WHERE transaction_date < DATE '2023-03-02' GROUP BY purchase_id)
        WHERE version.is_gmv_eligible GROUP BY ALL ORDER BY ALL"""
    )
    story = spark.sql(
        f"""SELECT {", ".join(s.AUDIT_COLUMNS)} FROM purchase_history
        WHERE purchase_id = 55 AND is_gmv_eligible = TRUE ORDER BY transaction_date"""
    )
    assert rows(story) == rows(audit(history, 55, eligible_only=True))


# ---- revenue -------------------------------------------------------------------------------


def tables(spark, purchases=x.PURCHASE_CURRENT_ROWS, items=x.ITEM_CURRENT_ROWS):
    return x.frame(spark, s.PURCHASE_CURRENT, purchases), x.frame(spark, s.PRODUCT_ITEM_CURRENT, items)


def sale(pid, item, producer, release="2021-05-05", status="APROVADA", partition=0):
    return (pid, 1, item, "2021-01-01", release, producer, 1, partition, status)


def test_worked_examples(spark):
    assert rows(top_producers(*tables(spark), 2021, 50)) == [(963963, Decimal("25.00"))]
    assert rows(top_products(*tables(spark), 2)) == [(963963, 37, Decimal("25.00"))]


def test_only_paid_approved_sales_of_the_year_count(spark):
    purchases = [
        sale(1, 1, 10, "2021-01-01"),
        sale(2, 1, 11, "2021-12-31"),
        sale(3, 1, 12, "2020-12-31"),
        sale(4, 1, 13, "2022-01-01"),
        sale(5, 1, 14, None),
        sale(6, 1, 15, status="CANCELADA"),
        sale(7, 1, 16, status=None),
        sale(8, 1, 17, partition=1),
        sale(9, None, 18),
    ]
    found = top_producers(*tables(spark, purchases, [(1, 5, 3, 7, 0)]), 2021)
    assert rows(found) == [(10, Decimal("7.00")), (11, Decimal("7.00"))]
    assert found.columns == ["producer_id", "faturamento_2021"]


def test_every_pair_of_sale_and_item_row_counts(spark):
    """A repeated item key multiplies, as an inner join does; quantity does not matter."""
    purchases = [sale(n, 1, 10) for n in range(3)] + [sale(9, 2, 10)]
    items = [(1, 5, 100, "1.10", 0), (1, 5, 1, "2.20", 0), (1, 6, 1, None, 0), (2, 5, 1, "0.05", 0)]
    found = producer_products(*tables(spark, purchases, items))
    assert sorted(rows(found), key=str) == [(10, 5, Decimal("9.95")), (10, 6, None)]
    assert rows(top_producers(*tables(spark, purchases, items), 2021)) == [(10, Decimal("9.95"))]


def test_limits_and_ties(spark):
    purchases = [sale(n, n % 4, 10) for n in range(8)] + [sale(20, 0, 3)]
    items = [(n, 100 - n, 1, 5 if n < 3 else 4, 0) for n in range(4)]
    both = tables(spark, purchases, items)
    assert rows(top_products(*both, 2)) == [
        (3, 100, Decimal("5.00")),
        (10, 98, Decimal("10.00")),
        (10, 99, Decimal("10.00")),
    ]
    assert [r[1] for r in rows(top_products(*both, 2, ties="keep"))] == [100, 98, 99, 100]
    assert len(rows(top_producers(*both, 2021, 1))) == 1


def test_ties_are_kept_like_rank_does(spark):
    data = [(g, i, v) for g, vs in {
        1: [5, 5, 5, 1], 2: [3, None, None], 3: [None, None, None], 4: [9], None: [2, 2, 1, 1],
    }.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(data, "g long, i long, v long")
    df.createOrReplaceTempView("ranked_input")
    ranked = spark.sql(
        "SELECT g, i, v FROM (SELECT *, rank() OVER (PARTITION BY g ORDER BY v DESC NULLS LAST) r"
        " FROM ranked_input) WHERE r <= 2"
    )
    assert x.same(top_k_per_group(df, "g", "v", 2, ["i"], ties="keep"), ranked)
