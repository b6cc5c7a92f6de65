"""One audit row per micro-batch."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.plans.ingest import BatchCounts
from eventlake.plans.merge import SourceProfile, merge_insert
from eventlake.sources.table import LakeTable

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("queryId", T.StringType()),
        T.StructField("batchId", T.LongType()),
        T.StructField("rowsRead", T.LongType()),
        T.StructField("rowsValid", T.LongType()),
        T.StructField("rowsUnique", T.LongType()),
        T.StructField("rowsDead", T.LongType()),
        T.StructField("rowsInserted", T.LongType()),
        T.StructField("deadInserted", T.LongType()),
        T.StructField("durationMs", T.LongType()),
    ]
)


AUDIT_KEYS = ["queryId", "batchId"]


class AuditLog:
    """A table of audit rows known by query and batch; upkeep merges its files like any table's.

    A replayed batch keeps the figures of the run that did the work: its row is merged in, and the
    match reads only what may hold the batch's number.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = LakeTable(spark, path, None, AUDIT_KEYS[::-1])

    def record(self, query_id: str, batch_id: int, counts: BatchCounts, duration_ms: int) -> bool:
        """Store a batch's figures; False if they are stored already."""
        self.table.ensure(AUDIT_SCHEMA)
        row = {
            **asdict(counts), "queryId": query_id, "batchId": batch_id, "durationMs": duration_ms
        }
        values = [tuple(row[f.name] for f in AUDIT_SCHEMA.fields)]
        one = SourceProfile(1, len(query_id), first_key=batch_id, last_key=batch_id)
        done = merge_insert(
            self.table,
            self.spark.createDataFrame(values, AUDIT_SCHEMA),
            AUDIT_KEYS,
            range_key="batchId",
            profile=one,
        )
        return done.inserted_rows == 1

    def scan(self) -> DataFrame:
        return self.table.ensure(AUDIT_SCHEMA).scan()


def audit_totals(audit: DataFrame) -> DataFrame:
    """Totals over all batches: one row, zeros for an empty log."""
    counters = ["rowsRead", "rowsValid", "rowsDead", "rowsInserted"]
    return audit.agg(
        F.count(F.lit(1)).alias("batches"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counters],
    )
