"""Insert-only merge: rows whose key is stored already are left alone, the rest are appended."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.operators.evidence import files_read
from eventlake.plans.upkeep import leased
from eventlake.session import input_bytes, runtime_key_filter, sized_shuffles
from eventlake.sources.table import LakeTable

BROADCAST_BYTES = 64 * 1024 * 1024
# Rough size of one key row in a broadcast hash table, besides the text itself.
KEY_ROW_BYTES = 64
# Longest key put into a scan filter as a literal.
LITERAL_CHARS = 256
SCOPES = ("window", "table")


@dataclass(frozen=True)
class SourceProfile:
    """What one aggregate tells about a batch of unique rows."""

    rows: int
    key_bytes: int = 0
    low: str | None = None
    high: str | None = None
    null_dates: int = 0
    dates: int = 1
    # Smallest and largest value of the range key, and how many rows have none.
    first_key: Any = None
    last_key: Any = None
    null_keys: int = 0
    # Bytes of the rows' text.
    text_bytes: int = 0

    @property
    def broadcast_size(self) -> int:
        return self.rows * KEY_ROW_BYTES + self.key_bytes


@dataclass(frozen=True)
class MergeOutcome:
    """What a merge did. ``window`` is None when keys were matched against the whole table;
    ``files_read`` counts the data files of the table that the match was given."""

    source_rows: int
    matched_rows: int
    inserted_rows: int
    window: tuple[str, str] | None = None
    files_read: int = field(default=0, compare=False)


def profile_columns(
    table: LakeTable,
    keys: Sequence[str],
    rows: Column,
    range_key: str | None = None,
    texts: Sequence[str] = (),
) -> dict[str, Column]:
    """Aggregates over the given ``rows`` of a frame that fill a :class:`SourceProfile`.

    ``texts`` are the columns that may be long (see :func:`text_columns`).
    """
    range_key = range_key or keys[0]
    size = _bytes_of(keys)
    columns = {
        "rows": F.count_if(rows),
        "key_bytes": F.coalesce(F.sum(F.when(rows, size)), F.lit(0)),
        "first_key": F.min(F.when(rows, F.col(range_key))),
        "last_key": F.max(F.when(rows, F.col(range_key))),
        "null_keys": F.count_if(rows & F.col(range_key).isNull()),
    }
    if texts:
        columns["text_bytes"] = F.coalesce(F.sum(F.when(rows, _bytes_of(texts))), F.lit(0))
    if table.partition_column:
        # As text: a date past the year 9999 has no Python value.
        date = F.when(rows, F.col(table.partition_column))
        columns |= {
            "low": F.min(date).cast("string"),
            "high": F.max(date).cast("string"),
            "null_dates": F.count_if(rows & F.col(table.partition_column).isNull()),
            # Only sizes the write, so an estimate that needs no shuffle will do.
            "dates": F.approx_count_distinct(date),
        }
    return columns


def text_columns(frame: DataFrame) -> list[str]:
    return [name for name, kind in frame.dtypes if kind in ("string", "binary")]


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _bytes_of(columns: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a + b,
        [
            F.coalesce(F.octet_length(_column(c).cast("string")), F.lit(0)).cast("long")
            for c in columns
        ],
    )


@leased
def merge_insert(
    table: LakeTable,
    source: DataFrame,
    keys: Sequence[str],
    *,
    scope: str = "window",
    null_safe: bool = False,
    range_key: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    profile: SourceProfile | None = None,
) -> MergeOutcome:
    """Append the rows of ``source`` whose ``keys`` the table does not hold.

    ``scope="window"`` looks for stored keys between the smallest and largest partition value of
    the source, and in the null partition if the source has rows there; a key stored under a date
    outside that window is not seen. ``scope="table"`` looks everywhere. The table must exist; it
    is widened by the source's new columns. With ``null_safe`` a null key part matches null,
    otherwise nothing. ``range_key`` is the key column whose range prunes the scan of the table,
    the first one if not given.

    Re-running a merge that was cut short inserts exactly what is missing, because the rows that
    landed are matched like any others.

    ``profile`` says that the caller has cached the source, found its keys to be unique, and
    measured it.
    """
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}, not {scope!r}")
    table.widen(source.schema)
    owned = profile is None
    if owned:
        source = source.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        range_key = range_key or keys[0]
        profile = profile or _measure(table, source, keys, range_key)
        if profile.rows == 0:
            return MergeOutcome(0, 0, 0)
        target, window = _match_side(table, profile, scope)
        if target is None:
            table.append(source, profile.rows, profile.dates, profile.text_bytes)
            return MergeOutcome(profile.rows, 0, profile.rows, window)
        target = _within_key_range(target, range_key, profile, null_safe)

        small = profile.broadcast_size <= broadcast_bytes
        with _shuffled_match(table, target, profile, small):
            mine = source if small else _within_key_range(source, range_key, profile, null_safe)
            hits = _stored_keys(target.select(*keys), mine.select(*keys), keys, small, null_safe)
            hits = hits.persist(StorageLevel.MEMORY_AND_DISK)  # planned here
        try:
            matched = hits.count()
            opened = files_read(hits)
            inserted = profile.rows - matched
            if inserted:
                fresh = source
                if matched:
                    fresh = keyed_join(
                        source, F.broadcast(hits) if small else hits, keys, "left_anti", null_safe
                    )
                table.append(fresh, inserted, profile.dates, profile.text_bytes)
        finally:
            hits.unpersist()
        return MergeOutcome(profile.rows, matched, inserted, window, opened)
    finally:
        if owned:
            source.unpersist()


def _measure(
    table: LakeTable, source: DataFrame, keys: Sequence[str], range_key: str
) -> SourceProfile:
    columns = profile_columns(table, keys, F.lit(True), range_key, text_columns(source))
    row = source.agg(*[c.alias(n) for n, c in columns.items()]).first()
    repeated = source.groupBy(*keys).count().where("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"the source has several rows for one key ({', '.join(keys)})")
    return SourceProfile(**row.asDict())


@contextlib.contextmanager
def _shuffled_match(
    table: LakeTable, target: DataFrame, profile: SourceProfile, small: bool
) -> Iterator[None]:
    """Settings for the match: as wide as the table's files, whose scan is filtered by the batch's
    keys before its shuffle. A broadcast match does not shuffle the table."""
    if small:
        yield
        return
    spark = table.spark
    with sized_shuffles(spark, input_bytes(target)), runtime_key_filter(spark, profile.rows):
        yield


def _match_side(
    table: LakeTable, profile: SourceProfile, scope: str
) -> tuple[DataFrame | None, tuple[str, str] | None]:
    """The part of the table in which the source's keys are looked up."""
    if scope == "table" or not table.partition_column or profile.low is None:
        return table.scan(), None
    window = (profile.low, profile.high)
    return table.scan_window(*window, with_null=profile.null_dates > 0), window


def _within_key_range(
    target: DataFrame, key: str, profile: SourceProfile, null_safe: bool
) -> DataFrame:
    """Keep target rows whose key can match at all.

    Equality implies it, so no match is lost, and Parquet skips files and row groups by it where
    keys grow over time (offsets, time-ordered ids) or the table is clustered on them.
    """
    low, high = profile.first_key, profile.last_key
    if low is None or any(isinstance(v, str) and len(v) > LITERAL_CHARS for v in (low, high)):
        return target
    possible = F.col(key).between(F.lit(low), F.lit(high))
    if null_safe and profile.null_keys:
        possible = possible | F.col(key).isNull()
    return target.where(possible)


def stored_keys(
    table: LakeTable,
    source: DataFrame,
    keys: Sequence[str],
    range_key: str,
    profile: SourceProfile,
    *,
    null_safe: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    possible: Column | None = None,
) -> DataFrame:
    """The distinct ``keys`` of the source that the whole table holds.

    ``possible`` is a condition that all rows with one of these keys meet; without one it is made
    from the range of ``range_key``.
    """
    if possible is not None:
        target = table.scan().where(possible)
    else:
        target = _within_key_range(table.scan(), range_key, profile, null_safe)
    small = profile.broadcast_size <= broadcast_bytes
    return _stored_keys(target.select(*keys), source.select(*keys), keys, small, null_safe)


def _stored_keys(
    target: DataFrame, source: DataFrame, keys: Sequence[str], small: bool, null_safe: bool
) -> DataFrame:
    """The distinct source keys found in the target; never more rows than the source.

    A small source is broadcast, so the target is only scanned. Otherwise the target's keys are
    made distinct, map side first, and that one shuffle also serves the join.
    """
    if small:
        found = keyed_join(target, F.broadcast(source), keys, "left_semi", null_safe)
        return found.distinct()
    return keyed_join(target.distinct(), source, keys, "left_semi", null_safe)


def keyed_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: bool
) -> DataFrame:
    if not null_safe:
        return left.join(right, list(keys), how)
    named = right.select(*[F.col(k).alias(f"match_{i}") for i, k in enumerate(keys)])
    conditions = [F.col(k).eqNullSafe(F.col(f"match_{i}")) for i, k in enumerate(keys)]
    return left.join(named, reduce(and_, conditions), how)
