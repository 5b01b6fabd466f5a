"""The gate: worked example, one planted fault per check, blocking."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import samples as x
from daybook.plans import DataQualityError, gate, run_checks
from daybook.plans.quality import REPORT_COLUMNS, duplicate_keys


def report(history, now=x.NOW):
    found = run_checks(history, x.RUN_DATE, now)
    assert found.columns == REPORT_COLUMNS
    return {r["check"]: r for r in found.collect()}


def counts(history, **kw):
    return {name: r["violations"] for name, r in report(history, **kw).items() if r["violations"]}


FILL_RATES = {"fill_rate:release_date": 2, "fill_rate:purchase_total_value": 1, "fill_rate:subsidiary": 2}


def test_sound_history_passes(spark):
    found = report(x.history(spark))
    assert len(found) == 23 and all(r["passed"] for r in found.values())
    assert sum(r["critical"] for r in found.values()) == 16
    assert {n: r["violations"] for n, r in found.items() if r["violations"]} == FILL_RATES
    assert found["fill_rate:release_date"]["pct_violations"] == 20.0
    assert found["fill_rate:release_date"]["threshold_pct"] == 100.0
    assert found["no_null_current:buyer_id"]["total"] == 3
    assert found["one_is_current_per_purchase"]["total"] == 3
    assert found["no_duplicate_pk"]["total"] == 10


def test_empty_history_passes(spark):
    found = report(x.history(spark).where("false"))
    assert len(found) == 23 and all(r["passed"] and r["total"] == 0 for r in found.values())


def test_report_keeps_its_order(spark):
    names = [r["check"] for r in run_checks(x.history(spark), x.RUN_DATE, x.NOW).collect()]
    assert names[:3] == ["no_null:purchase_id", "no_null:transaction_date", "no_null_current:buyer_id"]
    assert names[14] == "one_is_current_per_purchase" and names[17] == "no_duplicate_pk"
    assert names[-1] == "gmv_requires_release_date"


# Column changes on the newest row of purchase 69, and the checks that must see them.
FAULTS = [
    ({"purchase_id": "NULL"}, {"no_null:purchase_id": 1, "one_is_current_per_purchase": 1}),
    ({"transaction_date": "NULL"}, {"no_null:transaction_date": 1}),
    ({"buyer_id": "NULL"}, {"no_null_current:buyer_id": 1}),
    (
        {"purchase_status": "NULL"},
        {"no_null_current:purchase_status": 1, "is_gmv_eligible_rule": 1, "gmv_requires_aprovada": 1},
    ),
    ({"purchase_status": "NULL", "is_gmv_eligible": "false"}, {"no_null_current:purchase_status": 1}),
    ({"purchase_total_value": "NULL"}, {"fill_rate:purchase_total_value": 2}),
    ({"purchase_value": "NULL"}, {"fill_rate:purchase_value": 1}),
    ({"subsidiary": "NULL"}, {"fill_rate:subsidiary": 3}),
    ({"purchase_total_value": "-0.01"}, {"purchase_total_value>=0": 1}),
    ({"purchase_value": "-0.01"}, {"purchase_value>=0": 1}),
    (
        {"order_date": "date'2023-03-13'", "release_date": "date'2023-03-13'"},
        {"order_date<=transaction_date": 1},
    ),
    ({"release_date": "date'2023-02-25'"}, {"release_date>=order_date": 1}),
    (
        {"purchase_status": "'OUTRA'", "is_gmv_eligible": "false"},
        {"purchase_status_in_domain": 1},
    ),
    ({"is_gmv_eligible": "false"}, {"is_gmv_eligible_rule": 1}),
    ({"is_current": "false"}, {"one_is_current_per_purchase": 1}),
    ({"transaction_date": "date'2023-07-21'"}, {"transaction_date_not_future": 1}),
    ({"transaction_date": "date'2023-07-20'"}, {}),
    ({"etl_loaded_at": "timestamp_ntz'2023-07-20 05:09:59'"}, {"etl_loaded_at_within_1h": 1}),
    ({"etl_loaded_at": "timestamp_ntz'2023-07-20 05:10:00'"}, {}),
    ({"purchase_total_value": "1000000.01"}, {"purchase_total_value<=1000000": 1}),
    ({"purchase_total_value": "1000000"}, {}),
    ({"updated_sources": "''"}, {"updated_sources_not_empty": 1}),
    ({"updated_sources": "NULL"}, {"updated_sources_not_empty": 1}),
    ({"etl_loaded_at": "NULL"}, {"etl_loaded_at_populated": 1}),
    (
        {"purchase_status": "'CANCELADA'"},
        {"is_gmv_eligible_rule": 1, "gmv_requires_aprovada": 1},
    ),
    (
        {"release_date": "NULL"},
        {"is_gmv_eligible_rule": 1, "gmv_requires_release_date": 1, "fill_rate:release_date": 3},
    ),
]


@pytest.mark.parametrize("change,expected", FAULTS, ids=lambda v: "-".join(v) or "none")
def test_planted_fault_is_counted(spark, change, expected):
    sound = x.history(spark)
    hit = "purchase_id = 69 AND is_current"
    kinds = dict(sound.dtypes)
    faulty = sound.select(
        *[
            F.expr(f"CASE WHEN {hit} THEN CAST({change[c]} AS {kinds[c]}) ELSE {c} END").alias(c)
            if c in change
            else c
            for c in sound.columns
        ]
    )
    assert counts(faulty) == {**FILL_RATES, **expected}


def test_duplicate_rows_count_beyond_the_first_and_null_equals_null(spark):
    sound = x.history(spark)
    nulls = sound.limit(1).withColumns(
        {"purchase_id": F.lit(None).cast("long"), "transaction_date": F.lit(None).cast("date")}
    )
    faulty = sound.union(sound.where("purchase_id = 56")).union(nulls).union(nulls).union(nulls)
    assert report(faulty)["no_duplicate_pk"]["violations"] == 2 + 2
    assert report(faulty)["no_duplicate_pk"]["total"] == 15
    assert sorted(r["copies"] for r in duplicate_keys(faulty).collect()) == [2, 2, 3]


def test_status_of_failed_checks(spark):
    stale = report(x.history(spark), now=x.NOW + dt.timedelta(days=1))["etl_loaded_at_within_1h"]
    assert (stale["status"], stale["violations"], stale["passed"]) == ("WARN", 10, False)
    broken = x.history(spark).withColumn("updated_sources", F.lit(""))
    failed = report(broken)["updated_sources_not_empty"]
    assert (failed["status"], failed["pct_violations"]) == ("FAIL [CRÍTICO]", 100.0)


def test_gate_blocks_on_critical_failures_only(spark):
    sound = x.history(spark)
    stale = run_checks(sound, x.RUN_DATE, x.NOW + dt.timedelta(days=1))
    assert gate(stale) is stale
    broken = sound.withColumns({"updated_sources": F.lit(""), "is_current": F.lit(False)})
    names = "one_is_current_per_purchase, updated_sources_not_empty"
    with pytest.raises(DataQualityError, match=names) as blocked:
        gate(run_checks(broken, x.RUN_DATE, x.NOW))
    assert blocked.value.report.count() == 23
