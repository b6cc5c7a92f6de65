"""Raw records to events: parse, split, enrich, collapse duplicates.

Every function is lazy and takes static and streaming frames alike, except the two that collapse
duplicates: those are meant for one micro-batch, so they hold no streaming state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.functions import (
    error_reason,
    event_date,
    event_time,
    payload_fields,
    value_text,
)
from eventlake.schema import (
    DATE_COLUMN,
    DEAD_LETTER_SCHEMA,
    EVENT_SCHEMA,
    ID_COLUMN,
    INGEST_COLUMN,
    OFFSET_COLUMN,
    PARTITION_COLUMN,
    RAW_COLUMN,
    REASON_COLUMN,
    TIME_COLUMN,
)

COPIES_COLUMN = "_copies"


def parse_records(raw: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """One row per raw record, good or bad: coordinates, text and the parsed payload fields."""
    return raw.select(
        F.col("partition").alias(PARTITION_COLUMN),
        F.col("offset").alias(OFFSET_COLUMN),
        value_text().alias(RAW_COLUMN),
        payload_fields(value_text(), schema),
    )


def parse_events(raw: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """The records that carry an event id, as coordinates and payload fields.

    Fields absent from ``schema`` are ignored, so a longer schema is what lets a new producer
    field through to the table.
    """
    return parse_records(raw, schema).drop(RAW_COLUMN).where(F.col(ID_COLUMN).isNotNull())


def add_event_columns(events: DataFrame) -> DataFrame:
    """Add event time, event date and the ingest stamp."""
    return (
        events.withColumn(TIME_COLUMN, event_time())
        .withColumn(DATE_COLUMN, event_date(F.col(TIME_COLUMN)))
        .withColumn(INGEST_COLUMN, F.current_timestamp())
    )


def enrich_events(parsed: DataFrame) -> DataFrame:
    """The rows with an event id, with event time, event date and the ingest stamp."""
    return add_event_columns(parsed.where(F.col(ID_COLUMN).isNotNull()))


def collapse_by_id(events: DataFrame) -> DataFrame:
    """One row per event id, the first by (partition, offset), with the number of copies seen.

    An aggregate, not a window: copies are merged on the map side before the shuffle, so an id
    that makes up a third of the batch sends one row per map task and not all of its copies.
    """
    coordinates = [PARTITION_COLUMN, OFFSET_COLUMN]
    rest = [c for c in events.columns if c not in (*coordinates, ID_COLUMN)]
    if any(_has_map(events.schema[c].dataType) for c in rest):
        # Maps have no order, so compare by the coordinates alone.
        first = F.min_by(F.struct(*coordinates, *rest), F.struct(*coordinates))
    else:
        first = F.min(F.struct(*coordinates, *rest))
    return (
        events.groupBy(ID_COLUMN)
        .agg(first.alias("first"), F.count(F.lit(1)).alias(COPIES_COLUMN))
        .select(
            *[F.col("first")[c].alias(c) if c != ID_COLUMN else F.col(c) for c in events.columns],
            COPIES_COLUMN,
        )
    )


def dedupe_events(events: DataFrame) -> DataFrame:
    """One row per event id: the first by (partition, offset)."""
    return collapse_by_id(events).drop(COPIES_COLUMN)


def clickstream_events(raw: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Raw records to unique, enriched events.

    Duplicates go before the derived columns are added, so those never cross the shuffle; the
    result is the same because enrichment looks at one row at a time.
    """
    return enrich_events(dedupe_events(parse_events(raw, schema)))


def select_dead_letters(records: DataFrame) -> DataFrame:
    """The dead letters among already parsed records (see :func:`parse_records`)."""
    return (
        records.where(F.col(ID_COLUMN).isNull())
        .withColumn(REASON_COLUMN, error_reason(F.col(RAW_COLUMN)))
        .withColumn(INGEST_COLUMN, F.current_timestamp())
        .select(*DEAD_LETTER_SCHEMA.fieldNames())
    )


def dead_letters(raw: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """The exact complement of :func:`parse_events`, with the raw text and the reason."""
    return select_dead_letters(parse_records(raw, schema))


def _has_map(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.MapType):
        return True
    if isinstance(data_type, T.ArrayType):
        return _has_map(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(_has_map(f.dataType) for f in data_type.fields)
    return False
