"""The quality gate: 23 checks over a purchase history, a report, and a stop on critical ones."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.literals import clock_literal, date_literal
from daybook.functions.rules import gmv_eligible, half_even, is_approved, share
from daybook.schemas import FRESHNESS_SECONDS, PURCHASE, STATUS_DOMAIN, VALUE_CEILING, Grain

REPORT_COLUMNS = [
    "dimension",
    "check",
    "violations",
    "total",
    "pct_violations",
    "threshold_pct",
    "passed",
    "critical",
    "status",
]

ONE_CURRENT = "one_is_current_per_purchase"
NO_DUPLICATE = "no_duplicate_pk"


class DataQualityError(RuntimeError):
    """A critical check failed; nothing may be published. `report` tells the whole story."""

    def __init__(self, message: str, report: DataFrame):
        super().__init__(message)
        self.report = report


@dataclass(frozen=True)
class Check:
    """`violation` marks bad rows. Checks about keys have none: they count groups, not rows.
    A check is judged against all rows, or only the current ones if `current_only`."""

    dimension: str
    name: str
    violation: Column | None
    critical: bool = True
    threshold: float = 0.0
    current_only: bool = False


def purchase_checks(run_date: dt.date | str, now: dt.datetime) -> list[Check]:
    """All checks, in report order. `run_date` is "today" and `now` the time of the check."""
    col = F.col
    oldest_fresh = clock_literal(now - dt.timedelta(seconds=FRESHNESS_SECONDS))
    status = col("purchase_status")
    keys = [
        Check("Completeness", f"no_null:{name}", col(name).isNull())
        for name in ("purchase_id", "transaction_date")
    ]
    served = [
        Check("Completeness", f"no_null_current:{name}", col(name).isNull(), current_only=True)
        for name in ("buyer_id", "purchase_status")
    ]
    # Gaps before a source first speaks are legitimate: measured, never failed.
    fill_rates = [
        Check("Completeness", f"fill_rate:{name}", col(name).isNull(), False, 1.0)
        for name in ("release_date", "purchase_total_value", "purchase_value", "subsidiary")
    ]
    negatives = [
        Check("Accuracy", f"{name}>=0", col(name) < 0)
        for name in ("purchase_total_value", "purchase_value")
    ]
    return [
        *keys,
        *served,
        *fill_rates,
        *negatives,
        Check("Accuracy", "order_date<=transaction_date", col("order_date") > col("transaction_date")),
        Check("Accuracy", "release_date>=order_date", col("release_date") < col("order_date"), False),
        Check("Consistency", "purchase_status_in_domain", ~status.isin(*STATUS_DOMAIN)),
        Check(
            "Consistency",
            "is_gmv_eligible_rule",
            ~col("is_gmv_eligible").eqNullSafe(gmv_eligible()),
        ),
        Check("Consistency", ONE_CURRENT, None),
        Check(
            "Currentness",
            "transaction_date_not_future",
            col("transaction_date") > date_literal(run_date),
        ),
        Check("Currentness", "etl_loaded_at_within_1h", col("etl_loaded_at") < oldest_fresh, False),
        Check("Credibility", NO_DUPLICATE, None),
        Check(
            "Credibility",
            f"purchase_total_value<={VALUE_CEILING}",
            col("purchase_total_value") > VALUE_CEILING,
            False,
        ),
        Check(
            "Traceability",
            "updated_sources_not_empty",
            col("updated_sources").isNull() | (col("updated_sources") == ""),
        ),
        Check("Traceability", "etl_loaded_at_populated", col("etl_loaded_at").isNull()),
        Check("Compliance", "gmv_requires_aprovada", col("is_gmv_eligible") & ~is_approved()),
        Check(
            "Compliance",
            "gmv_requires_release_date",
            col("is_gmv_eligible") & col("release_date").isNull(),
        ),
    ]


def _finding(position: int, check: Check, violations: Column, total: Column) -> Column:
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(check.dimension).alias("dimension"),
        F.lit(check.name).alias("check"),
        violations.alias("violations"),
        total.alias("total"),
        F.lit(check.threshold).alias("threshold"),
        F.lit(check.critical).alias("critical"),
    )


def _by_row(run_date: dt.date | str, now: dt.datetime) -> list[tuple[int, Check]]:
    return [(i, c) for i, c in enumerate(purchase_checks(run_date, now)) if c.violation is not None]


def row_counts(run_date: dt.date | str, now: dt.datetime) -> list[Column]:
    """All row-level checks as aggregates: one pass, each task sends a single row of counters. They also
    work in `DataFrame.observe`, in the pass that writes the rows."""
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if("is_current").alias("current_rows"),
        *[
            F.count_if(
                F.col("is_current") & check.violation if check.current_only else check.violation
            ).alias(f"check_{position}")
            for position, check in _by_row(run_date, now)
        ],
    ]


def _row_findings(counts: DataFrame, checks: list[tuple[int, Check]]) -> DataFrame:
    findings = [
        _finding(
            position,
            check,
            F.col(f"check_{position}"),
            F.col("current_rows" if check.current_only else "rows"),
        )
        for position, check in checks
    ]
    return counts.select(F.inline(F.array(*findings)))


def copies_per_grain(history: DataFrame, grain: Grain = PURCHASE) -> DataFrame:
    """Rows and current rows for each (entity, day). Null keys form groups, too."""
    return history.groupBy(*grain.day).agg(
        F.count(F.lit(1)).alias("copies"), F.count_if("is_current").alias("current_copies")
    )


def current_rows_per_entity(history: DataFrame, grain: Grain = PURCHASE) -> DataFrame:
    """How many rows of each entity claim to be the current one; exactly one should."""
    return (
        history.where(F.col(grain.key).isNotNull())
        .groupBy(grain.key)
        .agg(F.count_if("is_current").alias("current_rows"))
    )


def duplicate_keys(history: DataFrame, grain: Grain = PURCHASE) -> DataFrame:
    """The (entity, day) pairs that occur more than once."""
    return copies_per_grain(history, grain).where("copies > 1").select(*grain.day, "copies")


def _key_findings(history: DataFrame, checks: dict[str, tuple[int, Check]], grain: Grain) -> DataFrame:
    """The two checks about keys. Rows are counted per (entity, day), then per entity; only
    the keys and two counters are shuffled."""
    per_entity = (
        copies_per_grain(history, grain)
        .groupBy(grain.key)
        .agg(
            F.sum("copies").alias("copies"),
            F.sum(F.col("copies") - 1).alias("extra"),
            F.sum("current_copies").alias("current_rows"),
        )
    )
    known = F.col(grain.key).isNotNull()
    none = F.lit(0).cast("long")
    counts = per_entity.agg(
        F.coalesce(F.sum("copies"), none).alias("rows"),
        F.coalesce(F.sum("extra"), none).alias("extra"),
        F.count(grain.key).alias("entities"),
        F.count_if(known & (F.col("current_rows") != 1)).alias("wrong"),
    )
    findings = [
        _finding(*checks[ONE_CURRENT], F.col("wrong"), F.col("entities")),
        _finding(*checks[NO_DUPLICATE], F.col("extra"), F.col("rows")),
    ]
    return counts.select(F.inline(F.array(*findings)))


def run_checks(
    history: DataFrame, run_date: dt.date | str, now: dt.datetime, grain: Grain = PURCHASE,
    counted: dict[str, int] | None = None,
) -> DataFrame:
    """The report: one row per check, in report order. Reads `history` twice (rows, keys), so
    give it a stored one; only its keys, if `counted` has what `row_counts` gave when it was written."""
    by_row = _by_row(run_date, now)
    rest = [(i, c) for i, c in enumerate(purchase_checks(run_date, now)) if c.violation is None]
    by_key = {check.name: (i, check) for i, check in rest}
    if counted is None:
        counts = history.agg(*row_counts(run_date, now))
    else:
        schema = ", ".join(f"{name} long" for name in counted)
        counts = history.sparkSession.createDataFrame([tuple(counted.values())], schema)
    findings = _row_findings(counts, by_row).unionByName(_key_findings(history, by_key, grain))
    ratio = share(F.col("violations"), F.col("total"))
    passed = ratio <= F.col("threshold")
    status = (
        F.when(passed, "PASS").when(F.col("critical"), "FAIL [CRÍTICO]").otherwise("WARN")
    )
    return (
        findings.withColumns(
            {
                "pct_violations": half_even(ratio * 100, 2),
                "threshold_pct": F.col("threshold") * 100,
                "passed": passed,
                "status": status,
            }
        )
        .orderBy("position")
        .select(*REPORT_COLUMNS)
    )


def gate(report: DataFrame) -> DataFrame:
    """Return the report, or raise if a critical check failed. Collects its 23 rows."""
    failed = report.where(F.col("critical") & ~F.col("passed")).select("check").collect()
    if failed:
        names = ", ".join(row["check"] for row in failed)
        raise DataQualityError(f"load blocked, critical checks failed: {names}", report)
    return report
