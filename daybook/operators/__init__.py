from daybook.operators.ranking import top_k, top_k_per_group
from daybook.operators.snapshots import (
    attach,
    event_spine,
    forward_fill,
    last_of_day,
    mark_current,
    touched_days,
)
from daybook.operators.versions import as_of, as_of_each

__all__ = [
    "as_of",
    "as_of_each",
    "attach",
    "event_spine",
    "forward_fill",
    "last_of_day",
    "mark_current",
    "top_k",
    "top_k_per_group",
    "touched_days",
]
