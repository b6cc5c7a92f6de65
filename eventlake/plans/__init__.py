"""Multi-step jobs: insert-only merge, landing one batch, table upkeep."""

from eventlake.plans.ingest import BatchCounts, dead_letter_table, events_table, land_batch
from eventlake.plans.merge import MergeOutcome, merge_insert
from eventlake.plans.upkeep import compact, is_due, maintain, recover, unfinished, vacuum, writing

__all__ = [
    "BatchCounts",
    "MergeOutcome",
    "compact",
    "dead_letter_table",
    "events_table",
    "is_due",
    "land_batch",
    "maintain",
    "merge_insert",
    "recover",
    "unfinished",
    "vacuum",
    "writing",
]
