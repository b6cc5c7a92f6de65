"""The scalar expressions of the event plan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The reasons stored with a dead letter.
REASON_NULL = "null value"
REASON_EMPTY = "empty value"
REASON_UNPARSEABLE = "unparseable or missing eventId"


def value_text(value: str | Column = "value") -> Column:
    """The record's bytes as text."""
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def payload_fields(text: Column, schema: T.StructType) -> Column:
    """Parse JSON text into one output column per schema field.

    Fields are produced by a generator and not by ``payload.*``: Spark would otherwise push
    ``eventId IS NOT NULL`` below the projection and parse every record a second time.
    """
    return F.inline(F.array(F.from_json(text, schema)))


def error_reason(text: Column) -> Column:
    """Why a record without an event id was rejected. ``trim`` strips spaces only."""
    return (
        F.when(text.isNull(), F.lit(REASON_NULL))
        .when(F.length(F.trim(text)) == 0, F.lit(REASON_EMPTY))
        .otherwise(F.lit(REASON_UNPARSEABLE))
    )


def event_time(millis: str = "timestamp") -> Column:
    """Epoch milliseconds as a timestamp; null where the value is out of range.

    A plain cast raises under ANSI mode, and one hostile record must not stop the stream.
    """
    return (F.col(millis) / F.lit(1000)).try_cast("timestamp")


def event_date(time: Column) -> Column:
    """The UTC date of a timestamp, whatever the session time zone is."""
    days = F.floor(F.unix_seconds(time) / F.lit(86400)).cast("int")
    return F.date_from_unix_date(days)
