"""Column names and schemas of the raw feed, the event payload and the two tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The wire field names, the stored column names and their types.
ID_COLUMN = "eventId"
TIME_COLUMN = "eventTime"
DATE_COLUMN = "eventDate"
INGEST_COLUMN = "ingestTime"
PARTITION_COLUMN = "kafkaPartition"
OFFSET_COLUMN = "kafkaOffset"
RAW_COLUMN = "rawValue"
REASON_COLUMN = "errorReason"

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("eventId", T.StringType(), False),
        T.StructField("userId", T.StringType(), False),
        T.StructField("eventType", T.StringType(), False),
        T.StructField("url", T.StringType(), True),
        T.StructField("referrer", T.StringType(), True),
        T.StructField("amount", T.DoubleType(), True),
        T.StructField("timestamp", T.LongType(), False),
    ]
)

# The part of a log record the engine reads; a Kafka frame has more columns, which are ignored.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("value", T.BinaryType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

DEAD_LETTER_SCHEMA = T.StructType(
    [
        T.StructField("kafkaPartition", T.IntegerType()),
        T.StructField("kafkaOffset", T.LongType()),
        T.StructField("rawValue", T.StringType()),
        T.StructField("errorReason", T.StringType()),
        T.StructField("ingestTime", T.TimestampType()),
    ]
)

COORDINATES = [PARTITION_COLUMN, OFFSET_COLUMN]


def require_id_column(payload: T.StructType) -> None:
    """Refuse a payload schema without the business key."""
    if ID_COLUMN not in payload.fieldNames():
        raise ValueError(f"the event schema must have a {ID_COLUMN} field")
