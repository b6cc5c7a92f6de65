"""Column expressions; all run inside the JVM."""

from eventlake.functions.columns import (
    error_reason,
    event_date,
    event_time,
    payload_fields,
    value_text,
)

__all__ = ["error_reason", "event_date", "event_time", "payload_fields", "value_text"]
