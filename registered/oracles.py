"""The same answers in DuckDB's SQL, written from the definitions rather than from the plans."""

from __future__ import annotations

from daybook.schemas import (
    AUDIT_COLUMNS,
    EXTRA_INFO_PAYLOAD,
    HISTORY,
    PRODUCT_ITEM_PAYLOAD,
    PURCHASE_EVENTS,
    PURCHASE_PAYLOAD,
    STATUS_DOMAIN,
)
from registered.bindings import (
    COPIED,
    CUTOFF,
    NOW,
    PLANTED,
    PURCHASE_ID,
    ITEM_PARTITION,
    RUN_DATE,
    RUN_TS,
    VERSION_COLUMNS,
    YEAR,
)

PAYLOAD = [*PURCHASE_PAYLOAD, *PRODUCT_ITEM_PAYLOAD, *EXTRA_INFO_PAYLOAD]
SOURCES = {
    "purchase": "has_purchase",
    "product_item": "has_product_item",
    "purchase_extra_info": "has_extra_info",
}


def listed(names) -> str:
    return ", ".join(names)


def sql(*ctes: str, final: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + final


# ---- revenue -----------------------------------------------------------------------------

SALES = """
sales AS (
  SELECT l_suppkey AS producer_id, l_partkey AS prod_item_id,
         l_partkey % 10 AS prod_item_partition, CAST(l_shipdate AS DATE) AS release_date
  FROM lineitem WHERE l_returnflag <> 'R' AND l_linestatus = 'F'
),
item AS (
  SELECT p_partkey AS prod_item_id, p_partkey % 10 AS prod_item_partition,
         CAST(p_size AS BIGINT) AS product_id,
         CAST(p_retailprice AS DECIMAL(18, 2)) AS purchase_value
  FROM part
)"""
JOINED = "sales JOIN item USING (prod_item_id, prod_item_partition)"
REVENUE = "CAST(SUM(purchase_value) AS DECIMAL(38, 2))"


def top_producers(name: str) -> str:
    return sql(
        SALES,
        final=f"""
        SELECT producer_id, {REVENUE} AS {name} FROM {JOINED}
        WHERE EXTRACT(YEAR FROM release_date) = {YEAR}
        GROUP BY producer_id ORDER BY {name} DESC, producer_id LIMIT 50""",
    )


PRODUCTS = f"""
products AS (
  SELECT producer_id, product_id, {REVENUE} AS faturamento FROM {JOINED}
  GROUP BY producer_id, product_id
)"""

# ---- feeds -------------------------------------------------------------------------------

EVENTS = """
ev AS (
  SELECT *, CAST(ts AS DATE) AS day, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
  FROM events
),
purchase_feed AS (
  SELECT ts AS transaction_datetime, day AS transaction_date, user_id AS purchase_id, event_id,
         b AS buyer_id, b + 1000 AS prod_item_id, CASE WHEN b IS NOT NULL THEN day END AS order_date,
         CASE WHEN b % 5 <> 0 THEN day END AS release_date,
         CASE WHEN b IS NOT NULL THEN user_id % 20 END AS producer_id,
         CASE WHEN b IS NOT NULL THEN CAST(value AS DECIMAL(18, 2)) END AS purchase_total_value,
         CASE WHEN b IS NULL THEN 'CANCELADA' WHEN b % 4 = 2 THEN 'CANCELADA'
              WHEN b % 4 = 3 THEN 'INICIADA' ELSE 'APROVADA' END AS purchase_status,
         CASE WHEN b IS NOT NULL THEN user_id % 10 END AS purchase_partition,
         b % 10 AS prod_item_partition
  FROM (SELECT *, CASE WHEN event_type <> 'error' THEN k END AS b FROM ev
        WHERE event_type IN ('purchase', 'signup', 'error'))
),
product_item_feed AS (
  SELECT ts AS transaction_datetime, day AS transaction_date, user_id AS purchase_id, event_id,
         k AS product_id, CAST(value AS DECIMAL(18, 2)) AS purchase_value
  FROM ev WHERE event_type = 'view'
),
purchase_extra_info_feed AS (
  SELECT ts AS transaction_datetime, day AS transaction_date, user_id AS purchase_id, event_id,
         CASE WHEN k % 2 = 0 THEN 'nacional' ELSE 'internacional' END AS subsidiary
  FROM ev WHERE event_type = 'click'
)"""

TYPED_FEED = sql(
    EVENTS,
    final=f"""
    SELECT * REPLACE (
      CASE WHEN buyer_id % 7 <> 0 THEN order_date END AS order_date,
      CASE WHEN buyer_id % 5 > 1 THEN order_date END AS release_date
    ) FROM (SELECT {listed(PURCHASE_EVENTS.names)} FROM purchase_feed)""",
)

QUARANTINED = sql(
    EVENTS,
    """reasons AS (
  SELECT concat_ws(',', CASE WHEN buyer_id % 11 = 0 THEN 'purchase_id' END,
                        CASE WHEN buyer_id % 13 = 0 THEN 'transaction_date' END,
                        CASE WHEN buyer_id % 17 = 0 THEN 'transaction_datetime' END)
         AS reject_reason
  FROM purchase_feed
)""",
    final="""SELECT reject_reason, COUNT(*) AS events FROM reasons
    WHERE reject_reason <> '' GROUP BY reject_reason""",
)

REJECTED = "SELECT 'purchase' AS source, * FROM (" + QUARANTINED + ")"

# ---- history -----------------------------------------------------------------------------


def last_of_day(source: str, payload) -> str:
    return f"""
{source}_day AS (
  SELECT purchase_id, transaction_date, {listed(payload)} FROM {source}_feed
  QUALIFY ROW_NUMBER() OVER (PARTITION BY purchase_id, transaction_date
                             ORDER BY transaction_datetime DESC, event_id DESC) = 1
)"""


DAYS = ",".join(
    [
        EVENTS,
        last_of_day("purchase", PURCHASE_PAYLOAD),
        last_of_day("product_item", PRODUCT_ITEM_PAYLOAD),
        last_of_day("purchase_extra_info", EXTRA_INFO_PAYLOAD),
    ]
)
_touched = " UNION ALL ".join(
    "SELECT purchase_id, transaction_date, "
    + listed(f"{int(source == other)} AS {flag}" for other, flag in SOURCES.items())
    + f" FROM {source}_day"
    for source in SOURCES
)
SPINE = f"""
spine AS (
  SELECT purchase_id, transaction_date, {listed(f"MAX({f}) AS {f}" for f in SOURCES.values())}
  FROM ({_touched}) GROUP BY purchase_id, transaction_date
)"""
WIDE = """
wide AS (
  SELECT * FROM spine
  LEFT JOIN purchase_day USING (purchase_id, transaction_date)
  LEFT JOIN product_item_day USING (purchase_id, transaction_date)
  LEFT JOIN purchase_extra_info_day USING (purchase_id, transaction_date)
)"""
FILLED = f"""
filled AS (
  SELECT purchase_id, transaction_date, {listed(SOURCES.values())},
         {listed(f"LAST_VALUE({c} IGNORE NULLS) OVER known AS {c}" for c in PAYLOAD)}
  FROM wide
  WINDOW known AS (PARTITION BY purchase_id ORDER BY transaction_date
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""
IS_CURRENT = "transaction_date = MAX(transaction_date) OVER (PARTITION BY purchase_id)"
ELIGIBLE = "(release_date IS NOT NULL AND purchase_status IS NOT DISTINCT FROM 'APROVADA')"
TOUCHED_BY = "concat_ws(',', {})".format(
    listed(f"CASE WHEN {flag} = 1 THEN '{source}' END" for source, flag in SOURCES.items())
)
HIST = f"""
hist AS (
  SELECT transaction_date, purchase_id, {listed(PAYLOAD)}, {IS_CURRENT} AS is_current,
         {ELIGIBLE} AS is_gmv_eligible, {TOUCHED_BY} AS updated_sources,
         TIMESTAMP '{RUN_TS}' AS etl_loaded_at
  FROM filled
)"""
BUILD = ",".join([DAYS, SPINE, WIDE, FILLED, HIST])
HISTORY_SQL = sql(BUILD, final=f"SELECT {listed(HISTORY.names)} FROM hist")

VERSION = f"""
version AS (
  SELECT * FROM hist WHERE transaction_date <= DATE '{CUTOFF}'
  QUALIFY ROW_NUMBER() OVER (PARTITION BY purchase_id ORDER BY transaction_date DESC) = 1
)"""
AS_OF = sql(BUILD, VERSION, final=f"SELECT {listed(HISTORY.names)} FROM version")
CURRENT = sql(BUILD, final=f"SELECT {listed(HISTORY.names)} FROM hist WHERE is_current")
GMV = "CAST(SUM(purchase_value) AS DECIMAL(38, 2)) AS gmv"


AS_OF_EACH = sql(
    BUILD,
    """days AS (SELECT DISTINCT transaction_date AS cutoff FROM hist),
requests AS (SELECT DISTINCT purchase_id, cutoff FROM hist, days)""",
    final=f"""SELECT purchase_id, cutoff, {listed("h." + c for c in VERSION_COLUMNS)}
    FROM requests r JOIN hist h USING (purchase_id)
    WHERE h.transaction_date = (SELECT MAX(x.transaction_date) FROM hist x
      WHERE x.purchase_id = r.purchase_id AND x.transaction_date <= r.cutoff)""",
)
GMV_EVERY_DAY = sql(
    BUILD,
    """days AS (SELECT DISTINCT transaction_date AS cutoff FROM hist),
versions AS (
  SELECT cutoff, h.* FROM days JOIN hist h ON h.transaction_date <= cutoff
  QUALIFY ROW_NUMBER() OVER (PARTITION BY cutoff, purchase_id ORDER BY transaction_date DESC) = 1
)""",
    final=f"""SELECT cutoff, subsidiary AS subsidiaria, {GMV} FROM versions
    WHERE is_gmv_eligible GROUP BY cutoff, subsidiary""",
)
MALFORMED_LINES = sql(
    EVENTS,
    """told AS (
  SELECT CASE WHEN buyer_id % 11 = 3 THEN 'more fields' ELSE 'none' END AS reject_reason FROM purchase_feed
  UNION ALL
  SELECT 'fewer fields' FROM purchase_feed WHERE buyer_id % 13 = 5 AND buyer_id % 11 <> 3
)""",
    final="SELECT reject_reason, COUNT(*) AS lines FROM told GROUP BY reject_reason",
)


def audit(extra: str = "") -> str:
    return sql(
        BUILD,
        final=f"""SELECT {listed(AUDIT_COLUMNS)} FROM hist
        WHERE purchase_id = {PURCHASE_ID}{extra} ORDER BY transaction_date""",
    )


# ---- quality -----------------------------------------------------------------------------

DIRTY = f"""
doubled AS (SELECT * FROM hist UNION ALL SELECT * FROM hist WHERE {COPIED}),
dirty AS (
  SELECT {listed(
      f"{PLANTED.get(c, c).format(clock='TIMESTAMP')} AS {c}" for c in HISTORY.names
  )} FROM doubled
)"""
_DOMAIN = listed(f"'{status}'" for status in STATUS_DOMAIN)


def report(rows: str, *ctes: str) -> str:
    """One SELECT per check; `rows` is the checked table."""

    def count(condition: str, among: str = "TRUE") -> tuple[str, str]:
        return (
            f"(SELECT COUNT(*) FROM {rows} WHERE ({among}) AND ({condition}))",
            f"(SELECT COUNT(*) FROM {rows} WHERE {among})",
        )

    per_purchase = (
        f"(SELECT COUNT(*) FILTER (WHERE is_current) AS n FROM {rows}"
        " WHERE purchase_id IS NOT NULL GROUP BY purchase_id)"
    )
    one_current = (
        f"(SELECT COUNT(*) FROM {per_purchase} WHERE n <> 1)",
        f"(SELECT COUNT(DISTINCT purchase_id) FROM {rows})",
    )
    duplicates = (
        f"(SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) FROM"
        f" (SELECT COUNT(*) AS n FROM {rows} GROUP BY purchase_id, transaction_date))",
        f"(SELECT COUNT(*) FROM {rows})",
    )
    stale = f"date_diff('second', etl_loaded_at, TIMESTAMP '{NOW}') > 3600"
    found = [
        ("Completeness", "no_null:purchase_id", True, 0, count("purchase_id IS NULL")),
        ("Completeness", "no_null:transaction_date", True, 0, count("transaction_date IS NULL")),
        ("Completeness", "no_null_current:buyer_id", True, 0, count("buyer_id IS NULL", "is_current")),
        (
            "Completeness",
            "no_null_current:purchase_status",
            True,
            0,
            count("purchase_status IS NULL", "is_current"),
        ),
        *[
            ("Completeness", f"fill_rate:{c}", False, 1, count(f"{c} IS NULL"))
            for c in ("release_date", "purchase_total_value", "purchase_value", "subsidiary")
        ],
        ("Accuracy", "purchase_total_value>=0", True, 0, count("purchase_total_value < 0")),
        ("Accuracy", "purchase_value>=0", True, 0, count("purchase_value < 0")),
        ("Accuracy", "order_date<=transaction_date", True, 0, count("order_date > transaction_date")),
        ("Accuracy", "release_date>=order_date", False, 0, count("release_date < order_date")),
        (
            "Consistency",
            "purchase_status_in_domain",
            True,
            0,
            count(f"purchase_status NOT IN ({_DOMAIN})"),
        ),
        (
            "Consistency",
            "is_gmv_eligible_rule",
            True,
            0,
            count(f"is_gmv_eligible IS DISTINCT FROM {ELIGIBLE}"),
        ),
        ("Consistency", "one_is_current_per_purchase", True, 0, one_current),
        (
            "Currentness",
            "transaction_date_not_future",
            True,
            0,
            count(f"transaction_date > DATE '{RUN_DATE}'"),
        ),
        ("Currentness", "etl_loaded_at_within_1h", False, 0, count(stale)),
        ("Credibility", "no_duplicate_pk", True, 0, duplicates),
        ("Credibility", "purchase_total_value<=1000000", False, 0, count("purchase_total_value > 1000000")),
        (
            "Traceability",
            "updated_sources_not_empty",
            True,
            0,
            count("updated_sources IS NULL OR updated_sources = ''"),
        ),
        ("Traceability", "etl_loaded_at_populated", True, 0, count("etl_loaded_at IS NULL")),
        (
            "Compliance",
            "gmv_requires_aprovada",
            True,
            0,
            count("is_gmv_eligible AND purchase_status IS DISTINCT FROM 'APROVADA'"),
        ),
        (
            "Compliance",
            "gmv_requires_release_date",
            True,
            0,
            count("is_gmv_eligible AND release_date IS NULL"),
        ),
    ]
    union = " UNION ALL ".join(
        f"""SELECT {i} AS position, '{dimension}' AS dimension, '{name}' AS "check",
        {bad} AS violations, {total} AS total, {str(critical).upper()} AS critical,
        CAST({threshold} AS DOUBLE) AS threshold"""
        for i, (dimension, name, critical, threshold, (bad, total)) in enumerate(found)
    )
    return sql(
        BUILD,
        *ctes,
        f"found AS ({union})",
        """judged AS (
          SELECT *, CASE WHEN total > 0 THEN violations::DOUBLE / total ELSE 0.0 END AS ratio
          FROM found
        )""",
        final="""
        SELECT dimension, "check", violations, total, round_even(ratio * 100, 2) AS pct_violations,
               threshold * 100 AS threshold_pct, ratio <= threshold AS passed, critical,
               CASE WHEN ratio <= threshold THEN 'PASS' WHEN critical THEN 'FAIL [CRÍTICO]'
                    ELSE 'WARN' END AS status
        FROM judged ORDER BY position""",
    )


ORACLES = {
    "top_producers_year": top_producers(f"faturamento_{YEAR}"),
    "producer_product_revenue": sql(SALES, PRODUCTS, final="SELECT * FROM products"),
    "revenue_colocated": sql(SALES, PRODUCTS, final="SELECT * FROM products"),
    "top2_products_per_producer": sql(
        SALES,
        PRODUCTS,
        final="""SELECT * FROM products
        QUALIFY ROW_NUMBER() OVER (PARTITION BY producer_id
                                   ORDER BY faturamento DESC, product_id) <= 2
        ORDER BY producer_id, faturamento DESC, product_id""",
    ),
    "top2_products_with_ties": sql(
        SALES,
        """counted AS (
          SELECT producer_id, prod_item_id, COUNT(*) AS sales FROM sales
          GROUP BY producer_id, prod_item_id
        )""",
        final="""SELECT * FROM counted
        QUALIFY RANK() OVER (PARTITION BY producer_id ORDER BY sales DESC) <= 2""",
    ),
    "top_producers_sql_views": top_producers("revenue"),
    "revenue_sql_over_files": sql(
        """sold AS (
          SELECT l_suppkey AS producer_id, p_brand AS brand,
                 CAST(p_retailprice AS DECIMAL(18, 2)) AS purchase_value
          FROM lineitem JOIN part ON p_partkey = l_partkey
          WHERE l_returnflag <> 'R' AND l_linestatus = 'F'
        )""",
        final=f"SELECT producer_id, brand, {REVENUE} AS revenue FROM sold GROUP BY ALL",
    ),
    "normalized_purchase_feed": TYPED_FEED,
    "csv_feed_roundtrip": TYPED_FEED,
    "csv_malformed_lines": MALFORMED_LINES,
    "quarantined_events": QUARANTINED,
    "last_of_day_purchase": sql(DAYS, final="SELECT * FROM purchase_day"),
    "event_spine": sql(DAYS, SPINE, final="SELECT * FROM spine"),
    "attached_sources": sql(DAYS, SPINE, WIDE, final="SELECT * FROM wide"),
    "forward_filled": sql(DAYS, SPINE, WIDE, FILLED, final="SELECT * FROM filled"),
    "current_flags": sql(
        DAYS,
        SPINE,
        final=f"SELECT purchase_id, transaction_date, {IS_CURRENT} AS is_current FROM spine",
    ),
    "eligibility_flags": sql(
        BUILD, final="SELECT purchase_id, transaction_date, is_gmv_eligible FROM hist"
    ),
    "updated_sources": sql(
        BUILD, final="SELECT purchase_id, transaction_date, updated_sources FROM hist"
    ),
    "purchase_history": HISTORY_SQL,
    "purchase_history_literal": HISTORY_SQL,
    "gmv_daily_current": sql(
        BUILD,
        final=f"""SELECT release_date AS data_compra, subsidiary AS subsidiaria, {GMV} FROM hist
        WHERE is_current AND is_gmv_eligible GROUP BY ALL ORDER BY 1, 2""",
    ),
    "gmv_as_of": sql(
        BUILD,
        VERSION,
        final=f"""SELECT order_date AS data_compra, purchase_id AS id_compra,
        subsidiary AS subsidiaria, {GMV} FROM version WHERE is_gmv_eligible
        GROUP BY ALL ORDER BY 1, 2, 3""",
    ),
    "gmv_as_of_month": sql(
        BUILD,
        VERSION,
        final=f"""SELECT release_date AS data_compra, purchase_id AS id_compra,
        subsidiary AS subsidiaria, {GMV} FROM version
        WHERE is_gmv_eligible AND strftime(release_date, '%Y-%m') = '2024-01'
        GROUP BY ALL ORDER BY 1, 2, 3""",
    ),
    "as_of_snapshot": AS_OF,
    "as_of_each_day": AS_OF_EACH,
    "gmv_every_day": GMV_EVERY_DAY,
    "current_state": CURRENT,
    "audit_entity": audit(),
    "audit_stored": audit(),
    "audit_entity_eligible": audit(" AND is_gmv_eligible"),
    "quality_report": report("hist"),
    "quality_report_dirty": report("dirty", DIRTY),
    "duplicate_keys": sql(
        BUILD,
        DIRTY,
        final="""SELECT purchase_id, transaction_date, COUNT(*) AS copies FROM dirty
        GROUP BY purchase_id, transaction_date HAVING COUNT(*) > 1""",
    ),
    "current_rows_per_entity": sql(
        BUILD,
        DIRTY,
        final="""SELECT purchase_id, COUNT(*) FILTER (WHERE is_current) AS current_rows
        FROM dirty WHERE purchase_id IS NOT NULL GROUP BY purchase_id""",
    ),
    "history_roundtrip_pruned": AS_OF,
    "items_by_partition": sql(
        SALES,
        final=f"""
        SELECT producer_id, {REVENUE} AS faturamento_{YEAR} FROM {JOINED}
        WHERE EXTRACT(YEAR FROM release_date) = {YEAR} AND prod_item_partition = {ITEM_PARTITION}
        GROUP BY producer_id ORDER BY 2 DESC, 1 LIMIT 50""",
    ),
    "gate_failures": f"""SELECT "check" FROM ({report("dirty", DIRTY)})
        WHERE critical AND NOT passed""",
    "published_after_refusal": HISTORY_SQL,
    "history_in_catalog_table": HISTORY_SQL,
    "rejected_events_stored": REJECTED,
    "incremental_skipped_days": HISTORY_SQL,
    "incremental_history": HISTORY_SQL,
    "incremental_current": CURRENT,
    "rebuilt_history": HISTORY_SQL,
}
ORACLES["gmv_from_deltas"] = ORACLES["gmv_as_of"]
