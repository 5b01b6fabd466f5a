from daybook.sources.feeds import (
    Feed,
    accepted,
    normalize,
    picked_feeds,
    purchase_feeds,
    quarantined,
    read_csv,
    rejected_events,
    split_csv,
)
from daybook.sources.tables import load_table, register_views, shared_folder

__all__ = [
    "Feed",
    "accepted",
    "load_table",
    "normalize",
    "picked_feeds",
    "purchase_feeds",
    "quarantined",
    "read_csv",
    "register_views",
    "rejected_events",
    "shared_folder",
    "split_csv",
]
