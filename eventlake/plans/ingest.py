"""Land one batch of raw records: unique events in one table, rejected records in another."""

from __future__ import annotations

import functools
import operator
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.operators.events import (
    COPIES_COLUMN,
    add_event_columns,
    collapse_by_id,
    enrich_events,
    parse_events,
    parse_records,
    select_dead_letters,
)
from eventlake.plans.merge import (
    SourceProfile,
    keyed_join,
    merge_insert,
    profile_columns,
    stored_keys,
    text_columns,
)
from eventlake.plans.upkeep import writing
from eventlake.schema import (
    COORDINATES,
    DATE_COLUMN,
    DEAD_LETTER_SCHEMA,
    EVENT_SCHEMA,
    ID_COLUMN,
    OFFSET_COLUMN,
    RAW_COLUMN,
    RAW_SCHEMA,
    require_id_column,
)
from eventlake.settings import MergeSettings
from eventlake.sources.table import LakeTable


LETTER_KEYS = [*COORDINATES, RAW_COLUMN]
# Log partitions that get a range of offsets each; with more of them one range does for all.
MOST_RANGES = 256


@dataclass(frozen=True)
class BatchCounts:
    """Rows of one batch, by fate. ``rowsInserted`` counts what the merge really appended."""

    rowsRead: int = 0
    rowsValid: int = 0
    rowsUnique: int = 0
    rowsDead: int = 0
    rowsInserted: int = 0
    deadInserted: int = 0


def events_table(
    spark: SparkSession,
    path: str,
    payload: T.StructType = EVENT_SCHEMA,
    rows_per_file: int = MergeSettings.rows_per_file,
) -> LakeTable:
    """The events table at ``path``, made if absent.

    Its columns come from running the real plan over no rows, so they cannot drift from it.
    """
    require_id_column(payload)
    table = LakeTable(spark, path, DATE_COLUMN, [ID_COLUMN], rows_per_file)
    if table.exists():
        return table
    no_rows = spark.createDataFrame([], RAW_SCHEMA)
    return table.ensure(enrich_events(parse_events(no_rows, payload)).schema)


def dead_letter_table(
    spark: SparkSession, path: str, rows_per_file: int = MergeSettings.rows_per_file
) -> LakeTable:
    """The dead-letter table at ``path``, made if absent; unpartitioned."""
    table = LakeTable(spark, path, None, COORDINATES, rows_per_file)
    if table.exists():
        return table
    return table.ensure(DEAD_LETTER_SCHEMA)


def land_batch(
    raw: DataFrame,
    events: LakeTable,
    dead: LakeTable | None = None,
    *,
    payload: T.StructType = EVENT_SCHEMA,
    merge: MergeSettings | None = None,
) -> BatchCounts:
    """Parse, collapse and merge a static frame of raw records; safe to repeat.

    All counts come from one aggregate over the collapsed batch: records without an event id form
    one group there, which the map side has already shrunk to a row per task.
    """
    with writing(events):
        return _land(raw, events, dead, payload, merge or MergeSettings())


def _land(
    raw: DataFrame,
    events: LakeTable,
    dead: LakeTable | None,
    payload: T.StructType,
    merge: MergeSettings,
) -> BatchCounts:
    records = parse_records(raw, payload)
    if dead is not None:
        # Both branches read the parsed records, so the source is read and parsed once. Only
        # dead letters need the text itself, so that of the events is not kept.
        text = F.when(F.col(ID_COLUMN).isNull(), F.col(RAW_COLUMN))
        records = records.withColumn(RAW_COLUMN, text).persist(StorageLevel.MEMORY_AND_DISK)
    groups = collapse_by_id(records.drop(RAW_COLUMN))
    batch = add_event_columns(groups).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        profile, read, valid = _profile(events, batch)
        unique = batch.where(F.col(ID_COLUMN).isNotNull()).drop(COPIES_COLUMN)
        outcome = merge_insert(
            events,
            unique,
            [ID_COLUMN],
            scope=merge.scope,
            broadcast_bytes=merge.broadcast_bytes,
            profile=profile,
        )
        rejected = read - valid
        dead_inserted = 0
        if dead is not None and rejected:
            dead_inserted = merge_dead_letters(
                select_dead_letters(records), dead, merge.broadcast_bytes
            )
        return BatchCounts(
            rowsRead=read,
            rowsValid=valid,
            rowsUnique=profile.rows,
            rowsDead=rejected,
            rowsInserted=outcome.inserted_rows,
            deadInserted=dead_inserted,
        )
    finally:
        batch.unpersist()
        if dead is not None:
            records.unpersist()


def merge_dead_letters(
    letters: DataFrame, table: LakeTable, broadcast_bytes: int = MergeSettings.broadcast_bytes
) -> int:
    """Insert dead letters not stored yet; returns how many.

    A letter is known by its partition, offset and text, null matching null. In a log the first
    two say it all; the text keeps records apart whose coordinates are missing or used again, so
    none is lost, while a replay finds every one of them. The offset range of the batch bounds
    what is read of the table, which is sorted by offset within its files.
    """
    letters = letters.dropDuplicates(LETTER_KEYS).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with writing(table):
            return _merge_letters(letters, table, broadcast_bytes)
    finally:
        letters.unpersist()


def _merge_letters(letters: DataFrame, table: LakeTable, broadcast_bytes: int) -> int:
    """Coordinates first: texts are read of the table only where a coordinate is there already,
    which a fresh batch has none of."""
    columns = profile_columns(
        table, COORDINATES, F.lit(True), OFFSET_COLUMN, text_columns(letters)
    )
    profile = SourceProfile(**_measure(letters, columns)[0])
    if profile.rows == 0:
        return 0
    options = {"null_safe": True, "broadcast_bytes": broadcast_bytes}
    possible = offset_ranges(letters)
    hits = stored_keys(
        table, letters, COORDINATES, OFFSET_COLUMN, profile, possible=possible, **options
    )
    hits = hits.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if hits.isEmpty():
            table.append(letters, profile.rows, profile.dates, profile.text_bytes)
            return profile.rows
        small = profile.broadcast_size <= broadcast_bytes
        side = F.broadcast(hits) if small else hits
        doubtful = keyed_join(letters, side, COORDINATES, "left_semi", null_safe=True)
        known = merge_insert(table, doubtful, LETTER_KEYS, range_key=OFFSET_COLUMN, **options)
        fresh = keyed_join(letters, side, COORDINATES, "left_anti", null_safe=True)
        count = profile.rows - known.source_rows
        if count:
            table.append(fresh, count, text_bytes=profile.text_bytes)
        return count + known.inserted_rows
    finally:
        hits.unpersist()


def offset_ranges(records: DataFrame) -> Column | None:
    """What the coordinates of any of these records meet: the range of offsets of their own log
    partition, or null where one of the two is.

    Offsets of different partitions have nothing to do with each other, so one range over all of
    them can span the whole log. As a condition on plain columns it reaches the Parquet reader,
    which skips row groups of other partitions and times. None if there are too many partitions.
    """
    partition, offset = (F.col(c) for c in COORDINATES)
    ranges = (
        records.groupBy(partition)
        .agg(
            F.min(offset).alias("first"),
            F.max(offset).alias("last"),
            F.bool_or(offset.isNull()).alias("unknown"),
        )
        .limit(MOST_RANGES + 1)
        .collect()
    )
    if not ranges or len(ranges) > MOST_RANGES:
        return None
    conditions = [
        (partition == r[0]) & offset.between(r["first"], r["last"])
        for r in ranges
        if r[0] is not None and r["first"] is not None
    ]
    if any(r[0] is None for r in ranges):
        conditions.append(partition.isNull())
    if any(r["unknown"] for r in ranges):
        conditions.append(offset.isNull())
    return functools.reduce(operator.or_, conditions)


def _profile(table: LakeTable, batch: DataFrame) -> tuple[SourceProfile, int, int]:
    """Measure the batch in one pass: the merge profile, rows read, rows valid."""
    has_id = F.col(ID_COLUMN).isNotNull()
    copies = F.col(COPIES_COLUMN)
    profile, counts = _measure(
        batch,
        profile_columns(table, [ID_COLUMN], has_id, texts=text_columns(batch)),
        {
            "read": F.coalesce(F.sum(copies), F.lit(0)),
            "valid": F.coalesce(F.sum(F.when(has_id, copies)), F.lit(0)),
        },
    )
    return SourceProfile(**profile), counts["read"], counts["valid"]


def _measure(frame: DataFrame, *groups: dict[str, Column]) -> list[dict]:
    """Evaluate several sets of named aggregates in one job."""
    columns = [c.alias(f"{i}_{name}") for i, g in enumerate(groups) for name, c in g.items()]
    row = frame.agg(*columns).first()
    return [{name: row[f"{i}_{name}"] for name in g} for i, g in enumerate(groups)]
