"""Every registered query: (spark, folder of the given tables) -> DataFrame.

Queries that fill a table write it under a new path in the shared scratch folder and return a
scan of it. ``ingestTime`` is left out of every result, and timestamps are returned without a
zone, so that results can be compared.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.operators.events import (
    clickstream_events,
    dead_letters,
    dedupe_events,
    enrich_events,
    parse_events,
)
from eventlake.operators.verify import (
    distinct_ids,
    exactly_once,
    rows_per_date,
    top_event_types,
    verification,
)
from eventlake.plans import (
    compact,
    dead_letter_table,
    events_table,
    land_batch,
    maintain,
    merge_insert,
    vacuum,
)
from eventlake.plans.ingest import merge_dead_letters
from eventlake.plans.upkeep import COMPACTED_PREFIX, OLD_DIR, partition_files
from eventlake.schema import DATE_COLUMN, ID_COLUMN, INGEST_COLUMN, TIME_COLUMN
from eventlake.session import scratch_path, tune_cached_batches
from eventlake.settings import MaintenanceSettings, MergeSettings, Settings
from eventlake.sources import Folder, LakeTable, raw_file_stream
from eventlake.streaming import AuditLog, ClickstreamIngest, audit_totals
from eventlake.workloads import feeds

# A stream's source files, and about how many micro-batches it takes them in.
RECORDS_PER_FILE, BATCHES = 2_000_000, 4

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under its function's name; it runs with the session settings of build_session."""

    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        tune_cached_batches(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


# -- stateless operators ------------------------------------------------------------------


@query
def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = feeds.raw_clickstream(feeds.clickstream_rows(spark, sf_dir))
    text = F.col("value").cast("string")
    return raw.select(
        "partition",
        "offset",
        text.isNull().alias("isNull"),
        F.coalesce(F.length(F.trim(text)) == 0, F.lit(False)).alias("isBlank"),
    )


@query
def parse_valid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_events(_raw(spark, sf_dir))


@query
def enrich_valid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(enrich_events(parse_events(_raw(spark, sf_dir))))


@query
def dedupe_in_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_events(parse_events(_raw(spark, sf_dir)))


@query
def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(clickstream_events(_raw(spark, sf_dir)))


@query
def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dead_letters(_raw(spark, sf_dir)).drop(INGEST_COLUMN)


@query
def rejected_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dead_letters(feeds.raw_documents(spark, sf_dir)).drop(INGEST_COLUMN)


@query
def merge_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window that a real merge reports."""
    outcome = merge_insert(
        _new_events(spark, "window"), clickstream_events(_raw(spark, sf_dir)), [ID_COLUMN]
    )
    dates = spark.createDataFrame([outcome.window], "minDate string, maxDate string")
    return dates.select(*[F.col(c).cast("date").alias(c) for c in dates.columns])


# -- merges into a table ------------------------------------------------------------------


@query
def merge_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches that share the middle third of the time range."""
    first, second = _overlapping(spark, sf_dir)
    events = _new_events(spark, "overlap")
    land_batch(first, events)
    land_batch(second, events)
    return _comparable(events.scan())


@query
def merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch landed three times."""
    events = _new_events(spark, "replay")
    for _ in range(3):
        land_batch(_raw(spark, sf_dir), events)
    return _comparable(events.scan())


@query
def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows inserted by each of three landings of one batch."""
    events = _new_events(spark, "counts")
    inserted = [
        (i, land_batch(_raw(spark, sf_dir), events).rowsInserted) for i in (1, 2, 3)
    ]
    return spark.createDataFrame(inserted, "landing long, rowsInserted long")


@query
def merge_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last third of the time range landed again on the full table: a narrow window."""
    events = _landed(spark, sf_dir, "pruned")
    rows = feeds.clickstream_rows(spark, sf_dir)
    _, late = _cuts(rows)
    batch = clickstream_events(feeds.raw_clickstream(rows.where(F.col("ts") >= late)))
    outcome = merge_insert(events, batch, [ID_COLUMN])
    files = partition_files(spark, events).agg(F.sum("files")).first()[0]
    # Shown by the metrics of the match: it has opened some of the files and not all.
    return _comparable(events.scan()).withColumn("pruned", F.lit(0 < outcome.files_read < files))


@query
def merge_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The overlap again with broadcasting switched off: the way of a large batch."""
    first, second = _overlapping(spark, sf_dir)
    events = _new_events(spark, "shuffled")
    for raw in (first, second):
        land_batch(raw, events, merge=MergeSettings(broadcast_bytes=0))
    return _comparable(events.scan())


@query
def merge_cross_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases sent again 400 days later: outside the window, so they are stored again."""
    return _comparable(_landed_late_resends(spark, sf_dir, "window").scan())


@query
def merge_table_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same matched against the whole table: nothing is stored twice."""
    return _comparable(_landed_late_resends(spark, sf_dir, "table").scan())


@query
def merge_null_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups without a time stamp, landed twice: the null partition is matched as well."""
    rows = feeds.clickstream_rows(spark, sf_dir)
    raw = feeds.raw_clickstream(rows, untimed=F.col("event_type") == "signup")
    events = _new_events(spark, "nulldates")
    for _ in range(2):
        land_batch(raw, events)
    return _comparable(events.scan()).drop("timestamp")


@query
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A producer adds ``channel`` half-way; rows landed before read null."""
    rows = feeds.clickstream_rows(spark, sf_dir)
    early, _ = _cuts(rows)
    events = _new_events(spark, "evolve")
    land_batch(feeds.raw_clickstream(rows.where(F.col("ts") < early)), events)
    channel = F.concat(F.lit("web-"), F.col("event_type"))
    land_batch(
        feeds.raw_clickstream(rows.where(F.col("ts") >= early), channel=channel),
        events,
        payload=feeds.CHANNEL_SCHEMA,
    )
    return _comparable(events.scan())


@query
def dlq_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed's dead letters merged twice."""
    dead = dead_letter_table(spark, scratch_path(spark, "dlq"))
    for _ in range(2):
        merge_dead_letters(dead_letters(_raw(spark, sf_dir)), dead)
    return dead.scan().drop(INGEST_COLUMN)


@query
def dlq_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of whole documents, landed twice: all of it goes to the dead-letter table."""
    events = _new_events(spark, "docs")
    dead = dead_letter_table(spark, scratch_path(spark, "docs-dlq"))
    for _ in range(2):
        land_batch(feeds.raw_documents(spark, sf_dir), events, dead)
    return dead.scan().drop(INGEST_COLUMN)


# -- reports on a table -------------------------------------------------------------------


@query
def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(_landed(spark, sf_dir, "scan").scan())


@query
def verify_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactly_once(_landed(spark, sf_dir, "verify").scan())


@query
def verify_repeated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on the parsed feed itself, whose resent ids make it fail."""
    return exactly_once(parse_events(_raw(spark, sf_dir)))


@query
def rows_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_per_date(_landed(spark, sf_dir, "dates").scan())


@query
def frequent_event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_event_types(_landed(spark, sf_dir, "types").scan())


@query
def verify_in_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three reports of the verification job, from one scan."""
    return verification(_landed(spark, sf_dir, "one-pass").scan())


@query
def stored_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_ids(_landed(spark, sf_dir, "ids").scan())


# -- upkeep -------------------------------------------------------------------------------


@query
def compact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _landed_in_parts(spark, sf_dir, "compact")
    compact(events, "eventId")
    return _comparable(events.scan())


@query
def vacuum_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _landed_in_parts(spark, sf_dir, "vacuum")
    compact(events, "eventId")
    vacuum(events, 0, allow_short=True)
    return _comparable(events.scan())


@query
def compact_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per date, and whether its files have become fewer: one that does nothing shows."""
    events = _landed_in_parts(spark, sf_dir, "compact-report")
    before = _files(events, "filesBefore")
    compact(events, "eventId")
    counts = _files(events, "filesAfter").join(before, DATE_COLUMN)
    merged = (F.col("filesBefore") == 1) | (F.col("filesAfter") < F.col("filesBefore"))
    return (
        rows_per_date(events.scan())
        .join(counts, DATE_COLUMN)
        .select(DATE_COLUMN, "rows", merged.alias("merged"))
    )


@query
def vacuum_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the table, and replaced runs before and after reclaiming space."""
    events = _landed_in_parts(spark, sf_dir, "vacuum-report")
    compact(events, "eventId")
    before = len(events.folder.names(OLD_DIR))
    vacuum(events, 0, allow_short=True)
    after = len(events.folder.names(OLD_DIR))
    return events.scan().agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(before).cast("long").alias("runsBefore"),
        F.lit(after).cast("long").alias("runsAfter"),
    )


@query
def maintain_then_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upkeep by settings, then the whole feed again on the rewritten table."""
    events = _landed_in_parts(spark, sf_dir, "maintain")
    before = _files(events, "filesBefore")
    maintain(events, MaintenanceSettings(enabled=True))
    land_batch(_raw(spark, sf_dir), events)
    rows = events.scan().withColumn("merged", _is_compacted()).join(before, DATE_COLUMN)
    alone = F.col("filesBefore") == 1
    return _comparable(rows.withColumn("merged", F.col("merged") | alone).drop("filesBefore"))


# -- streams ------------------------------------------------------------------------------


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several micro-batches; the purchases come again in later ones."""
    stream = _Stream(spark, sf_dir, "stream")
    stream.run()
    return _comparable(stream.events().scan())


@query
def stream_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = _Stream(spark, sf_dir, "stream-dlq", dlq={"enabled": True})
    stream.run()
    return stream.dead().scan().drop(INGEST_COLUMN)


@query
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last batch's commit is lost, so the restarted query runs that batch again."""
    stream = _Stream(spark, sf_dir, "stream-replay", dlq={"enabled": True})
    stream.run()
    stream.forget_last_commit()
    stream.run()
    return _comparable(stream.events().scan())


@query
def stream_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upkeep after every second batch of the stream."""
    upkeep = {"enabled": True, "every_batches": 2, "vacuum_retention_hours": 0}
    stream = _Stream(spark, sf_dir, "stream-upkeep", maintenance=upkeep)
    stream.run()
    events = stream.events().scan()
    merged = not events.where(_is_compacted()).isEmpty()
    return _comparable(events).withColumn("merged", F.lit(merged))


@query
def batch_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit totals of a stream; the number of batches depends on the files, so it is dropped."""
    options = {"dlq": {"enabled": True}, "audit": {"enabled": True}}
    stream = _Stream(spark, sf_dir, "stream-audit", **options)
    stream.run()
    return audit_totals(stream.audit().scan()).drop("batches")


# -- helpers ------------------------------------------------------------------------------


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.raw_clickstream(feeds.clickstream_rows(spark, sf_dir))


def _comparable(events: DataFrame) -> DataFrame:
    zoneless = F.col(TIME_COLUMN).cast("timestamp_ntz")
    return events.drop(INGEST_COLUMN).withColumn(TIME_COLUMN, zoneless)


def _new_events(spark: SparkSession, label: str) -> LakeTable:
    return events_table(spark, scratch_path(spark, label))


def _landed(spark: SparkSession, sf_dir: str, label: str) -> LakeTable:
    events = _new_events(spark, label)
    land_batch(_raw(spark, sf_dir), events)
    return events


def _cuts(rows: DataFrame):
    """Two instants that split the time range in three."""
    low, high = rows.agg(F.min("ts"), F.max("ts")).first()
    third = (high - low) / 3
    return low + third, low + 2 * third


def _overlapping(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = feeds.clickstream_rows(spark, sf_dir)
    early, late = _cuts(rows)
    first = feeds.raw_clickstream(rows.where(F.col("ts") < late))
    second = feeds.raw_clickstream(rows.where(F.col("ts") >= early))
    return first, second


def _landed_late_resends(spark: SparkSession, sf_dir: str, scope: str) -> LakeTable:
    rows = feeds.clickstream_rows(spark, sf_dir)
    events = _new_events(spark, f"late-{scope}")
    for raw in (feeds.originals(rows), feeds.resends(rows, later_days=400)):
        land_batch(raw, events, merge=MergeSettings(scope=scope))
    return events


def _landed_in_parts(spark: SparkSession, sf_dir: str, label: str) -> LakeTable:
    """The feed landed by log partition, so that every date has several files."""
    raw = _raw(spark, sf_dir)
    events = _new_events(spark, label)
    for p in range(feeds.LOG_PARTITIONS):
        land_batch(raw.where(F.col("partition") == p), events)
    return events


def _is_compacted() -> Column:
    """True for rows read from a file that a compaction has written."""
    return F.element_at(F.split(F.input_file_name(), "/"), -1).startswith(COMPACTED_PREFIX)


def _files(table: LakeTable, name: str) -> DataFrame:
    """Data files per date, as they are now."""
    counts = partition_files(table.spark, table).collect()
    rows = [(r["directory"].removeprefix(f"{DATE_COLUMN}="), r["files"]) for r in counts]
    frame = table.spark.createDataFrame(rows, f"{DATE_COLUMN} string, {name} long")
    return frame.withColumn(DATE_COLUMN, F.col(DATE_COLUMN).cast("date"))


class _Stream:
    """A stream over the feed written to files: first deliveries, then the second ones."""

    def __init__(self, spark: SparkSession, sf_dir: str, label: str, **sections):
        self.spark = spark
        self.base = scratch_path(spark, label)
        self.settings = Settings.from_mapping(
            {
                "storage": {"base_path": self.base, "checkpoint_path": f"{self.base}/checkpoints"},
                "stream": {"once": True},
                **sections,
            }
        )
        rows = feeds.clickstream_rows(spark, sf_dir)
        # Dealt out before records are made of them: the ranges are found by a pass of their own.
        # Offsets grow with the event id. A batch gets a file for every core, of either wave.
        width = max(1, BATCHES * spark.sparkContext.defaultParallelism // 2)
        dealt = rows.repartitionByRange(width, "event_id")
        for wave in (feeds.originals(dealt), feeds.resends(dealt)):
            files = wave.write.mode("append")
            # Beyond that the width follows the data, by a bound on a file's rows.
            files.option("maxRecordsPerFile", RECORDS_PER_FILE).parquet(f"{self.base}/raw")

    def run(self) -> None:
        files = len(self.spark.read.parquet(f"{self.base}/raw").inputFiles())
        share = max(1, files // BATCHES)
        source = raw_file_stream(self.spark, f"{self.base}/raw", max_files_per_trigger=share)
        ClickstreamIngest(self.spark, self.settings, source).run()

    def forget_last_commit(self) -> None:
        storage = self.settings.storage
        checkpoint = Folder(self.spark, storage.checkpoint_for(storage.table_name))
        last = max(checkpoint.visible("commits"), key=int)
        checkpoint.remove(f"commits/{last}")

    def events(self) -> LakeTable:
        return LakeTable(self.spark, self.settings.storage.table_path, DATE_COLUMN)

    def dead(self) -> LakeTable:
        path = self.settings.storage.path_of(self.settings.dlq.table_name)
        return LakeTable(self.spark, path)

    def audit(self) -> AuditLog:
        path = self.settings.storage.path_of(self.settings.audit.table_name)
        return AuditLog(self.spark, path)
