"""The ingest query: raw stream in, events and dead letters out, exactly once by event id."""

from __future__ import annotations

import logging
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventlake.plans.ingest import BatchCounts, dead_letter_table, events_table, land_batch
from eventlake.plans.upkeep import is_due, maintain
from eventlake.schema import EVENT_SCHEMA, require_id_column
from eventlake.session import tune_cached_batches
from eventlake.settings import Settings
from eventlake.sources.kafka import kafka_stream
from eventlake.streaming.audit import AuditLog
from eventlake.streaming.progress import ProgressGauges

QUERY_NAME = "eventlake-clickstream"
log = logging.getLogger(__name__)


class ClickstreamIngest:
    """Runs the stream; use as a context manager to stop it cleanly.

    The stream itself is only the source. Each micro-batch is landed by ``foreachBatch`` as a
    static frame, so both tables are fed from the same records and no streaming state is kept;
    a batch that is run again after a failure finds its rows and inserts what is missing.
    """

    def __init__(
        self,
        spark: SparkSession,
        settings: Settings,
        source: DataFrame | None = None,
        payload: T.StructType = EVENT_SCHEMA,
    ):
        require_id_column(payload)
        self.spark = spark
        self.settings = settings
        self.payload = payload
        self.query: StreamingQuery | None = None
        self.progress = ProgressGauges(QUERY_NAME)
        self._source = source
        self._listening = False

    def start(self) -> StreamingQuery:
        """Make the tables, start the query and return it."""
        storage, stream = self.settings.storage, self.settings.stream
        self._tables(self.spark)
        source = self._source
        if source is None:
            source = kafka_stream(self.spark, self.settings.kafka)
        self.spark.streams.addListener(self.progress)
        self._listening = True
        trigger = (
            {"availableNow": True} if stream.once else {"processingTime": stream.trigger_interval}
        )
        self.query = (
            source.writeStream.queryName(QUERY_NAME)
            .option("checkpointLocation", storage.checkpoint_for(storage.table_name))
            .trigger(**trigger)
            .foreachBatch(self.process_batch)
            .start()
        )
        return self.query

    def process_batch(self, raw: DataFrame, batch_id: int) -> BatchCounts:
        """Land one micro-batch, audit it, and run upkeep when it is due."""
        started = time.monotonic()
        # The batch's own session: it carries the settings the query was started with.
        spark = raw.sparkSession
        tune_cached_batches(spark)
        settings = self.settings
        events, dead = self._tables(spark)
        counts = land_batch(raw, events, dead, payload=self.payload, merge=settings.merge)
        tables = [table for table in (events, dead) if table is not None]
        if settings.audit.enabled:
            query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
            elapsed = int((time.monotonic() - started) * 1000)
            audit = AuditLog(spark, settings.storage.path_of(settings.audit.table_name))
            audit.record(query_id, batch_id, counts, elapsed)
            tables.append(audit.table)
        seconds = time.monotonic() - started
        log.info(
            "batch %d: %s in %.1f s, %.0f records/s",
            batch_id,
            counts,
            seconds,
            counts.rowsRead / max(seconds, 1e-3),
        )
        if is_due(batch_id, settings.maintenance):
            for table in tables:
                done = maintain(table, settings.maintenance, touched_only=True)
                log.info("batch %d: upkeep %s", batch_id, done)
        return counts

    def run(self) -> None:
        """Start and wait until the query ends; stop it on the way out."""
        with self:
            try:
                self.start().awaitTermination()
            except Exception:
                log.exception("the ingest query has ended with an error")
                raise
            log.info("the ingest query has ended")

    def stop(self) -> None:
        """Stop the query and drop the listener. A batch cut short runs again on restart."""
        try:
            if self.query is not None and self.query.isActive:
                self.query.stop()
        finally:
            if self._listening:
                self.spark.streams.removeListener(self.progress)
                self._listening = False

    def __enter__(self) -> ClickstreamIngest:
        return self

    def __exit__(self, *exc_info) -> None:
        self.stop()

    def _tables(self, spark: SparkSession):
        storage, merge = self.settings.storage, self.settings.merge
        events = events_table(spark, storage.table_path, self.payload, merge.rows_per_file)
        dead = None
        if self.settings.dlq.enabled:
            path = storage.path_of(self.settings.dlq.table_name)
            dead = dead_letter_table(spark, path, merge.rows_per_file)
        return events, dead
