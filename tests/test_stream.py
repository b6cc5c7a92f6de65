"""The streaming query: restart, replay, failure, audit, progress."""

import pytest
from helpers import DAY1, event, ids
from pyspark.sql.classic.dataframe import DataFrame as Classic

from eventlake.plans import BatchCounts, ingest, land_batch
from eventlake.schema import DATE_COLUMN, EVENT_SCHEMA
from eventlake.settings import Settings
from eventlake.sources import Folder, LakeTable, raw_file_stream
from eventlake.streaming import AuditLog, ClickstreamIngest, ProgressGauges, audit_totals
from eventlake.workloads import feeds, queries


class Lake:
    """A lake in a test folder, fed by files."""

    def __init__(self, spark, base, **sections):
        self.spark, self.base = spark, str(base)
        self.settings = Settings.from_mapping(
            {
                "storage": {"base_path": self.base, "checkpoint_path": f"{self.base}/ckpt"},
                "stream": {"once": True},
                "dlq": {"enabled": True},
                "audit": {"enabled": True},
                **sections,
            }
        )

    def feed(self, frame):
        frame.coalesce(1).write.mode("append").parquet(f"{self.base}/raw")

    def ingest(self, per_trigger=1):
        source = raw_file_stream(self.spark, f"{self.base}/raw", per_trigger)
        job = ClickstreamIngest(self.spark, self.settings, source)
        job.run()
        return job

    def forget_last_commit(self):
        folder = Folder(self.spark, f"{self.base}/ckpt/events")
        last = max(folder.visible("commits"), key=int)
        folder.remove(f"commits/{last}")
        return int(last)

    @property
    def events(self):
        return LakeTable(self.spark, f"{self.base}/events", DATE_COLUMN).scan()

    @property
    def dead(self):
        return LakeTable(self.spark, f"{self.base}/events_dlq").scan()

    @property
    def audit(self):
        return AuditLog(self.spark, f"{self.base}/events_audit").scan()


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def test_restart_on_one_checkpoint(lake, raw):
    lake.feed(raw([event(i) for i in "abbc"]))
    lake.ingest()
    assert ids(lake.events) == ["a", "b", "c"]
    lake.feed(raw([event(i) for i in "cdde"]))
    lake.ingest()
    assert ids(lake.events) == ["a", "b", "c", "d", "e"]
    assert lake.audit.count() == 2


def test_good_and_bad_records(lake, raw):
    lake.feed(raw([(event("g1"), 0, 1), ("bad", 0, 10), (event("g2"), 0, 2), ("bad", 0, 11)]))
    lake.ingest()
    assert ids(lake.events) == ["g1", "g2"]
    assert {r.kafkaOffset for r in lake.dead.collect()} == {10, 11}


def test_dead_letters_are_dropped_when_off(spark, raw, tmp_path):
    lake = Lake(spark, tmp_path, dlq={"enabled": False}, audit={"enabled": False})
    lake.feed(raw([event("a"), "bad"]))
    lake.ingest()
    assert ids(lake.events) == ["a"]
    assert not Folder(spark, f"{tmp_path}/events_dlq").exists()
    assert not Folder(spark, f"{tmp_path}/events_audit").exists()


def test_replay_of_the_last_batch(lake, raw):
    lake.feed(raw([event("a"), "bad"]))
    lake.feed(raw([event("b", DAY1 + 1), ("worse", 0, 7)]))
    lake.ingest()
    before = sorted(map(tuple, lake.events.collect()))
    audit = sorted(map(tuple, lake.audit.collect()))
    batch = lake.forget_last_commit()
    job = lake.ingest()
    assert job.query.lastProgress["batchId"] >= batch
    assert sorted(map(tuple, lake.events.collect())) == before
    assert lake.dead.count() == 2
    assert sorted(map(tuple, lake.audit.collect())) == audit


@pytest.mark.parametrize("broken", ["merge_dead_letters", "merge_insert"])
def test_failure_between_the_two_tables_is_healed(lake, raw, monkeypatch, broken):
    """The batch dies before one of its writes; the restarted query completes it."""
    lake.feed(raw([event("a"), ("bad", 0, 5)]))

    def fail(*args, **kwargs):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, broken, fail)
        with pytest.raises(Exception, match="executor lost"):
            lake.ingest()
    assert lake.dead.count() == 0
    lake.ingest()
    assert ids(lake.events) == ["a"]
    assert lake.dead.count() == 1


def test_half_written_batch_is_completed_by_replay(lake, raw):
    days = [DAY1 + d * 86_400_000 for d in range(5)]
    lake.feed(raw([event(f"{d}-{i}", d) for d in days for i in range(10)]))
    lake.ingest()
    before = sorted(map(tuple, lake.events.drop("ingestTime").collect()))
    folder = Folder(lake.spark, f"{lake.base}/events")
    for name in [n for n in folder.names() if n.startswith("eventDate=")][:2]:
        folder.remove(name)
    assert lake.events.count() == 30
    lake.forget_last_commit()
    lake.ingest()
    assert sorted(map(tuple, lake.events.drop("ingestTime").collect())) == before


def test_audit_counts(lake, raw):
    lake.feed(raw([event("a"), event("a"), event("b"), "bad", None]))
    lake.feed(raw([event("b"), event("c")]))
    lake.ingest()
    rows = [tuple(r)[1:8] for r in lake.audit.orderBy("batchId").collect()]
    assert rows == [(0, 5, 3, 2, 2, 2, 2), (1, 2, 2, 2, 0, 1, 0)]
    assert audit_totals(lake.audit).first() == (2, 7, 5, 2, 3)
    assert all(r.durationMs > 0 and len(r.queryId) == 36 for r in lake.audit.collect())


def test_audit_row_is_written_once_and_restored_if_incomplete(spark, tmp_path, monkeypatch):
    log = AuditLog(spark, str(tmp_path / "audit"))
    assert audit_totals(log.scan()).first() == (0, 0, 0, 0, 0)

    def crash(run, directories):
        raise OSError("crash")

    monkeypatch.setattr(log.table, "_move_in", crash)
    with pytest.raises(OSError, match="crash"):
        log.record("q", 0, BatchCounts(1, 1, 1, 0, 1, 0), 5)
    monkeypatch.undo()
    assert audit_totals(log.scan()).first() == (0, 0, 0, 0, 0)
    assert log.record("q", 0, BatchCounts(1, 1, 1, 0, 1, 0), 5)
    assert not log.record("q", 0, BatchCounts(1, 1, 1, 0, 0, 0), 5)
    assert audit_totals(log.scan()).first() == (1, 1, 1, 0, 1)


def test_upkeep_runs_inside_the_stream(spark, raw, tmp_path):
    upkeep = {"enabled": True, "every_batches": 4, "vacuum_retention_hours": 0}
    lake = Lake(spark, tmp_path, maintenance=upkeep)
    for i in range(4):
        lake.feed(raw([event(f"e{i}")]))
    lake.ingest()
    assert ids(lake.events) == ["e0", "e1", "e2", "e3"]
    assert len(Folder(spark, f"{tmp_path}/events").visible("eventDate=2024-07-03")) == 1


def test_processing_time_trigger_and_stop(spark, raw, tmp_path):
    lake = Lake(spark, tmp_path, stream={"once": False, "trigger_interval": "1 second"})
    lake.feed(raw([event("a")]))
    source = raw_file_stream(spark, f"{tmp_path}/raw")
    with ClickstreamIngest(spark, lake.settings, source) as job:
        query = job.start()
        query.processAllAvailable()
        assert query.name == "eventlake-clickstream"
        assert query.isActive
    assert not query.isActive
    assert ids(lake.events) == ["a"]


def test_progress_gauges(spark, raw, tmp_path):
    lake = Lake(spark, tmp_path, stream={"once": False, "trigger_interval": "1 second"})
    lake.feed(raw([event("a"), event("b")]))
    source = raw_file_stream(spark, f"{tmp_path}/raw")
    with ClickstreamIngest(spark, lake.settings, source) as job:
        job.start().processAllAvailable()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        snapshot = job.progress.snapshot
        assert snapshot.active
        assert (snapshot.batch_id, snapshot.input_rows) == (0, 2)
        assert snapshot.duration_ms > 0 and snapshot.rows_per_second > 0
        assert len(spark.streams._jsqm.listListeners()) == 1
    assert len(spark.streams._jsqm.listListeners()) == 0


@pytest.mark.parametrize("rate", [float("nan"), float("inf")])
def test_rate_without_a_finite_value_is_zero(rate):
    gauges = ProgressGauges("q")
    gauges.record(3, 0, 7, rate)
    assert (gauges.snapshot.batch_id, gauges.snapshot.rows_per_second) == (3, 0.0)


def test_schema_without_id_is_refused(spark, lake):
    schema = type(EVENT_SCHEMA)([f for f in EVENT_SCHEMA.fields if f.name != "eventId"])
    with pytest.raises(ValueError, match="eventId"):
        ClickstreamIngest(spark, lake.settings, None, schema)


def test_stop_is_safe_before_and_after_the_run(lake, raw, spark):
    job = ClickstreamIngest(spark, lake.settings, None)
    job.stop()
    lake.feed(raw([event("a")]))
    job = lake.ingest()
    job.stop()
    job.stop()
    assert not job.query.isActive


def test_source_that_cannot_start_reports_its_own_error(lake, spark):
    """Without the Kafka connector the error is Spark's, and stopping does not hide it."""
    with pytest.raises(Exception, match="kafka"):
        ClickstreamIngest(spark, lake.settings).run()


def test_the_feed_is_dealt_out_before_records_are_made(spark, tmp_path, monkeypatch):
    """Ranges are found by a pass over the rows, which should not make every record."""
    rows = spark.range(20).selectExpr(
        "id AS event_id",
        "timestamp_ntz'2024-01-01 13:00:00' AS ts",
        "id % 5 AS user_id",
        "element_at(array('view', 'purchase', 'error'), cast(id % 3 + 1 AS int)) AS event_type",
        "1.0D AS value",
        "'{\"k\": 1}' AS props",
    )
    rows.write.parquet(f"{tmp_path}/events.parquet")
    dealt = []

    def deal(self, *args, real=Classic.repartitionByRange):
        dealt.append(self.columns)
        return real(self, *args)

    monkeypatch.setattr(Classic, "repartitionByRange", deal)
    stream = queries._Stream(spark, str(tmp_path), "dealt")
    assert dealt and not any("offset" in columns for columns in dealt)
    written = spark.read.parquet(f"{stream.base}/raw")
    # Not fewer than cores in each batch, as far as there are rows for them.
    assert len(written.inputFiles()) > 8
    wanted = feeds.raw_clickstream(feeds.clickstream_rows(spark, str(tmp_path)))
    assert sorted(map(tuple, written.collect()), key=repr) == sorted(
        map(tuple, wanted.collect()), key=repr
    )


def test_only_the_text_of_dead_letters_is_kept(raw, events, dead, monkeypatch):
    kept = []

    def select(records, real=ingest.select_dead_letters):
        kept.extend(r["rawValue"] for r in records.collect())
        return real(records)

    monkeypatch.setattr(ingest, "select_dead_letters", select)
    land_batch(raw([event("a"), "bad", event("b"), None]), events, dead)
    assert sorted(kept, key=repr) == ["bad", None, None, None]
    assert sorted(r["errorReason"] for r in dead.scan().collect()) == [
        "null value",
        "unparseable or missing eventId",
    ]
