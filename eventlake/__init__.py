"""Click-stream landing on PySpark: exactly-once by event id, with dead letters and upkeep."""

from eventlake.plans import (
    BatchCounts,
    compact,
    dead_letter_table,
    events_table,
    land_batch,
    maintain,
    merge_insert,
    vacuum,
)
from eventlake.schema import EVENT_SCHEMA, RAW_SCHEMA
from eventlake.session import build_session
from eventlake.settings import Settings
from eventlake.streaming import ClickstreamIngest

__all__ = [
    "EVENT_SCHEMA",
    "RAW_SCHEMA",
    "BatchCounts",
    "ClickstreamIngest",
    "Settings",
    "build_session",
    "compact",
    "dead_letter_table",
    "events_table",
    "land_batch",
    "maintain",
    "merge_insert",
    "vacuum",
]
