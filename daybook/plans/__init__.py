from daybook.plans.daily import DailyStore
from daybook.plans.history import build_history, build_history_literal, fill_days
from daybook.plans.quality import DataQualityError, gate, run_checks
from daybook.plans.revenue import producer_products, top_producers, top_products
from daybook.plans.storage import (
    create_history_table,
    export_csv,
    publish,
    read_history,
    save_colocated,
    write_history,
    write_items,
)
from daybook.plans.timetravel import audit, current, gmv_as_of, gmv_at, gmv_at_each, gmv_daily, gmv_deltas

__all__ = [
    "DailyStore",
    "DataQualityError",
    "audit",
    "build_history",
    "build_history_literal",
    "create_history_table",
    "current",
    "export_csv",
    "fill_days",
    "gate",
    "gmv_as_of",
    "gmv_at",
    "gmv_at_each",
    "gmv_daily",
    "gmv_deltas",
    "producer_products",
    "publish",
    "read_history",
    "run_checks",
    "save_colocated",
    "top_producers",
    "top_products",
    "write_history",
    "write_items",
]
