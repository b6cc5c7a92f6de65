"""DataFrame-in, DataFrame-out operators."""

from eventlake.operators.events import (
    add_event_columns,
    clickstream_events,
    collapse_by_id,
    dead_letters,
    dedupe_events,
    enrich_events,
    parse_events,
    parse_records,
    select_dead_letters,
)
from eventlake.operators.verify import (
    distinct_ids,
    exactly_once,
    rows_per_date,
    top_event_types,
)

__all__ = [
    "add_event_columns",
    "clickstream_events",
    "collapse_by_id",
    "dead_letters",
    "dedupe_events",
    "distinct_ids",
    "enrich_events",
    "exactly_once",
    "parse_events",
    "parse_records",
    "rows_per_date",
    "select_dead_letters",
    "top_event_types",
]
