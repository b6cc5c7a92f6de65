"""The streaming query, its batch audit and its progress figures."""

from eventlake.streaming.audit import AuditLog, audit_totals
from eventlake.streaming.ingest import ClickstreamIngest
from eventlake.streaming.progress import ProgressGauges, Snapshot

__all__ = ["AuditLog", "ClickstreamIngest", "ProgressGauges", "Snapshot", "audit_totals"]
