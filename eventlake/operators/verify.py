"""Reports that prove a table holds every event id once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.schema import DATE_COLUMN, ID_COLUMN

TOP_TYPES = 10


def exactly_once(events: DataFrame) -> DataFrame:
    """One row ``total, distinct, pass``; passes when no id is stored twice.

    Counts per id are merged on the map side and then summed, so no id and no task carries more
    than one row per map task, however often an id repeats.
    """
    per_id = (
        events.where(F.col(ID_COLUMN).isNotNull())
        .groupBy(ID_COLUMN)
        .agg(F.count(F.lit(1)).alias("stored"))
    )
    totals = per_id.agg(
        F.coalesce(F.sum("stored"), F.lit(0)).alias("total"),
        F.count(F.lit(1)).alias("distinct"),
    )
    return totals.withColumn("pass", F.col("total") == F.col("distinct"))


def rows_per_date(events: DataFrame) -> DataFrame:
    """Row count per event date, in date order. Reads the partition column alone.

    No rows for a table without dates.
    """
    if DATE_COLUMN not in events.columns:
        return events.sparkSession.createDataFrame([], f"{DATE_COLUMN} date, rows long")
    return events.groupBy(DATE_COLUMN).agg(F.count(F.lit(1)).alias("rows")).orderBy(DATE_COLUMN)


def top_event_types(events: DataFrame, n: int = TOP_TYPES) -> DataFrame:
    """The ``n`` most frequent event types; equal counts are ordered by name.

    No rows for a table without event types.
    """
    if "eventType" not in events.columns:
        return events.sparkSession.createDataFrame([], "eventType string, rows long")
    return (
        events.groupBy("eventType")
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), F.asc("eventType"))
        .limit(n)
    )


def distinct_ids(events: DataFrame) -> DataFrame:
    """The distinct event ids."""
    return events.select(ID_COLUMN).distinct()


BY_ID, BY_DATE, BY_TYPE = "ids", "dates", "types"


def verification(events: DataFrame) -> DataFrame:
    """All reports from one scan: (report, key, rows, distinct).

    ``ids`` is one row with the rows that have an id and the distinct ids; ``dates`` and ``types``
    have a row per event date and type, as far as the table has these columns. Counts by each of
    the three are grouping sets of one aggregate, merged on the map side, and are then summed per
    report and key. So the result has a row per date and type, and no task sees more of an id, date
    or type than a row per map task. Meant to be cached and read by the functions below.
    """
    present = {c.lower() for c in events.columns}
    columns = {BY_ID: ID_COLUMN, BY_DATE: DATE_COLUMN, BY_TYPE: "eventType"}
    columns = {report: c for report, c in columns.items() if c.lower() in present}
    keys = list(columns.values())
    # Of k keys all but one are out of a set: their bits are 1, the first key's the highest.
    every = (1 << len(keys)) - 1
    report, key = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, (name, column) in enumerate(columns.items()):
        here = F.col("set") == every - (1 << (len(keys) - 1 - i))
        report = F.when(here, F.lit(name)).otherwise(report)
        if name != BY_ID:
            key = F.when(here, F.col(column).cast("string")).otherwise(key)
    return (
        events.select(*keys)
        .groupingSets([[c] for c in keys], *keys)
        .agg(F.grouping_id().alias("set"), F.count(F.lit(1)).alias("stored"))
        .select("stored", report.alias("report"), key.alias("key"), F.col(ID_COLUMN).alias("id"))
        .where(f"report != '{BY_ID}' OR id IS NOT NULL")
        .groupBy("report", "key")
        .agg(F.sum("stored").alias("rows"), F.count(F.lit(1)).alias("distinct"))
    )


def exactly_once_of(verified: DataFrame) -> DataFrame:
    """``exactly_once`` from the result of ``verification``."""
    totals = verified.where(F.col("report") == BY_ID).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("distinct"), F.lit(0)).alias("distinct"),
    )
    return totals.withColumn("pass", F.col("total") == F.col("distinct"))


def rows_per_date_of(verified: DataFrame) -> DataFrame:
    """``rows_per_date`` from the result of ``verification``."""
    date = F.col("key").cast("date").alias(DATE_COLUMN)
    return verified.where(F.col("report") == BY_DATE).select(date, "rows").orderBy(DATE_COLUMN)


def top_event_types_of(verified: DataFrame, n: int = TOP_TYPES) -> DataFrame:
    """``top_event_types`` from the result of ``verification``."""
    types = verified.where(F.col("report") == BY_TYPE)
    return (
        types.select(F.col("key").alias("eventType"), "rows")
        .orderBy(F.desc("rows"), F.asc("eventType"))
        .limit(n)
    )
