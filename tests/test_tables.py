"""Creating, verifying and keeping up tables."""

import datetime
import json
import os

import pytest
from helpers import DAY1, DAY2, event, ids
from pyspark.sql import functions as F

from eventlake import __main__ as command
from eventlake.operators import (
    clickstream_events,
    dead_letters,
    distinct_ids,
    exactly_once,
    rows_per_date,
    top_event_types,
)
from eventlake.operators.evidence import rows_read
from eventlake.plans import (
    compact,
    dead_letter_table,
    events_table,
    is_due,
    land_batch,
    maintain,
    merge_insert,
    recover,
    unfinished,
    vacuum,
    writing,
)
from eventlake.plans import ingest
from eventlake.plans.ingest import merge_dead_letters
from eventlake.plans.upkeep import partition_files
from eventlake.schema import DEAD_LETTER_SCHEMA
from eventlake.settings import MaintenanceSettings
from eventlake.sources import LakeTable
from eventlake.sources.lease import LeaseHeld

STORED = [
    "kafkaPartition", "kafkaOffset", "eventId", "userId", "eventType", "url", "referrer",
    "amount", "timestamp", "eventTime", "eventDate", "ingestTime",
]


def test_new_table_is_empty_and_has_the_plan_schema(events):
    assert events.scan().columns == STORED
    assert dict(events.scan().dtypes)["eventDate"] == "date"
    assert events.scan().count() == 0


def test_ensure_keeps_an_existing_table(spark, raw, events):
    land_batch(raw([event("a")]), events)
    assert ids(events_table(spark, events.path).scan()) == ["a"]


def test_dead_letter_table_schema(dead):
    assert dead.scan().schema == DEAD_LETTER_SCHEMA


def test_missing_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        LakeTable(spark, str(tmp_path / "none")).scan()


# -- reports ------------------------------------------------------------------------------


def test_verify_passes_after_a_replay(raw, events):
    for _ in range(2):
        land_batch(raw([event("a"), event("a"), event("b")]), events)
    assert exactly_once(events.scan()).first() == (2, 2, True)
    assert distinct_ids(events.scan()).count() == 2


def test_verify_fails_after_a_plain_append(raw, events):
    row = clickstream_events(raw([event("dup")]))
    for _ in range(2):
        events.append(row, 1)
    assert exactly_once(events.scan()).first() == (2, 1, False)


def test_verify_ignores_rows_without_id_and_an_empty_table(spark, events):
    assert exactly_once(events.scan()).first() == (0, 0, True)
    frame = spark.createDataFrame([(None,), ("a",)], "eventId string")
    assert exactly_once(frame).first() == (1, 1, True)


def test_reports(raw, events):
    batch = [event("a", DAY1), event("b", DAY2), event("c", DAY2, eventType="view")]
    land_batch(raw([*batch, event("n", None)]), events)
    assert [tuple(r) for r in rows_per_date(events.scan()).collect()] == [
        (None, 1), (datetime.date(2024, 7, 3), 1), (datetime.date(2024, 7, 4), 2),
    ]
    assert [tuple(r) for r in top_event_types(events.scan()).collect()] == [
        ("click", 3), ("view", 1),
    ]


def test_top_types_are_ten_with_ties_by_name(spark):
    names = [f"t{i:02}" for i in range(12)] + ["t11"]
    frame = spark.createDataFrame([(n,) for n in names], "eventType string")
    got = [tuple(r) for r in top_event_types(frame).collect()]
    assert got == [("t11", 2), *[(f"t{i:02}", 1) for i in range(9)]]


# -- upkeep -------------------------------------------------------------------------------


@pytest.fixture
def fragmented(raw, events):
    for i in range(5):
        land_batch(raw([event(f"a{i}", DAY1 + i), event(f"z{i}", DAY1 + i)]), events)
    land_batch(raw([event("other", DAY2)]), events)
    return events


def files(table):
    return {r.directory: r.files for r in partition_files(table.spark, table).collect()}


def test_compact_keeps_rows_and_merges_files(fragmented):
    before = sorted(map(tuple, fragmented.scan().collect()))
    assert files(fragmented) == {"eventDate=2024-07-03": 5, "eventDate=2024-07-04": 1}
    done = compact(fragmented, "eventId")
    assert (done.partitions, done.files_before) == (1, 5)
    assert files(fragmented) == {"eventDate=2024-07-03": 1, "eventDate=2024-07-04": 1}
    assert sorted(map(tuple, fragmented.scan().collect())) == before
    assert compact(fragmented, "eventId").partitions == 0


def test_compacted_files_are_clustered(spark, raw, events):
    for i in range(6):
        land_batch(raw([event(f"{j:04}-{i}") for j in range(200)]), events)
    size = sum(r["size"] for r in partition_files(spark, events).collect())
    compact(events, "eventId", target_file_bytes=size // 2)
    spans = (
        events.scan()
        .groupBy(F.input_file_name())
        .agg(F.min("eventId").alias("low"), F.max("eventId").alias("high"))
        .orderBy("low")
        .collect()
    )
    assert 2 <= len(spans) < 6
    assert all(a.high < b.low for a, b in zip(spans, spans[1:], strict=False))


def test_compact_by_groups_and_without_cluster_column(raw, events):
    for i in range(4):
        land_batch(raw([event(f"a{i}", DAY1), event(f"b{i}", DAY2)]), events)
    assert compact(events, None, group_bytes=1).partitions == 2
    assert set(files(events).values()) == {1}
    assert events.scan().count() == 8


def test_compact_widened_table(raw, events):
    for i in range(3):
        land_batch(raw([event(f"a{i}")]), events)
    batch = clickstream_events(raw([event("b")])).withColumn("channel", F.lit("web"))
    merge_insert(events, batch, ["eventId"])
    compact(events, "eventId")
    got = {r.eventId: r.channel for r in events.scan().collect()}
    assert got == {"a0": None, "a1": None, "a2": None, "b": "web"}


def test_maintain_then_land(raw, fragmented):
    maintain(fragmented, MaintenanceSettings(enabled=True, vacuum_retention_hours=0))
    assert fragmented.scan().count() == 11
    assert fragmented.folder.names("_old") == []
    assert land_batch(raw([event("a0"), event("new")]), fragmented).rowsInserted == 1


def test_vacuum_keeps_recent_files_and_guards_short_retention(fragmented):
    compact(fragmented, "eventId")
    assert vacuum(fragmented) == 0
    assert len(fragmented.folder.names("_old")) == 1
    with pytest.raises(ValueError, match="allow_short"):
        vacuum(fragmented, 1)
    assert vacuum(fragmented, 0, allow_short=True) == 1
    assert fragmented.scan().count() == 11


def test_vacuum_frees_runs_older_than_the_retention(fragmented):
    compact(fragmented, "eventId")
    (run,) = fragmented.folder.names("_old")
    old = (datetime.datetime.now(datetime.UTC) - datetime.timedelta(days=8)).strftime(
        "%Y%m%dT%H%M%S%fZ"
    )
    fragmented.folder.move(f"_old/{run}", f"_old/{old}-aged")
    assert vacuum(fragmented) == 1


def _stop_at_move(table, monkeypatch, n):
    """Make the n-th move of the next compaction fail, as a crash there would."""
    done = []

    def move(source, target, real=table.folder.move):
        done.append(source)
        if len(done) == n:
            raise OSError("crash")
        real(source, target)

    monkeypatch.setattr(table.folder, "move", move)
    with pytest.raises(OSError, match="crash"):
        compact(table)
    monkeypatch.undo()


def test_compact_dead_letters(raw, dead):
    for i in range(4):
        merge_dead_letters(dead_letters(raw([("bad", 0, i), ("worse", 1, i)])), dead)
    before = sorted(map(tuple, dead.scan().collect()))
    assert files(dead) == {"": 4}
    maintain(dead, MaintenanceSettings(enabled=True, vacuum_retention_hours=0))
    assert files(dead) == {"": 1}
    assert sorted(map(tuple, dead.scan().collect())) == before
    assert merge_dead_letters(dead_letters(raw([("bad", 0, 3), ("new", 0, 9)])), dead) == 1


@pytest.mark.parametrize("n", [1, 3, 4, 5])
def test_crash_while_swapping_dead_letters(spark, raw, dead, monkeypatch, n):
    """Four old files move out, one comes in; the crash comes at the n-th move."""
    for i in range(4):
        merge_dead_letters(dead_letters(raw([("bad", 0, i)])), dead)
    _stop_at_move(dead, monkeypatch, n)
    reopened = dead_letter_table(spark, dead.path)
    assert unfinished(reopened)
    recover(reopened)
    assert sorted(r.kafkaOffset for r in reopened.scan().collect()) == [0, 1, 2, 3]
    assert reopened.folder.names("_staging") == []


@pytest.mark.parametrize("n", [1, 3, 6])
def test_crash_while_swapping_loses_nothing(spark, raw, fragmented, monkeypatch, n):
    before = ids(fragmented.scan())
    _stop_at_move(fragmented, monkeypatch, n)
    reopened = events_table(spark, fragmented.path)
    assert unfinished(reopened)  # opening settles nothing, the next writer does
    assert land_batch(raw([event("a0"), event("z4")]), reopened).rowsInserted == 0
    assert reopened.folder.names("_staging") == []
    assert ids(reopened.scan()) == before
    vacuum(reopened, 0, allow_short=True)
    assert ids(reopened.scan()) == before


@pytest.mark.parametrize("keep_source", [False, True])
def test_crash_in_the_middle_of_a_copy(spark, fragmented, monkeypatch, keep_source):
    """Where a rename copies, some old files have moved, or were copied and not deleted."""
    before = ids(fragmented.scan())
    _stop_at_move(fragmented, monkeypatch, 1)
    name = "eventDate=2024-07-03"
    (run,) = unfinished(fragmented)
    manifest = json.loads(fragmented.folder.read_text(f"_staging/{run}/_manifest.json"))
    inputs = spark.read.parquet(f"{fragmented.path}/{manifest['plan']}/_inputs")
    old = f"{fragmented.path}/_old/{manifest['old']}/{name}"
    os.makedirs(old, exist_ok=True)
    for row in inputs.orderBy("name").limit(2).collect():
        os.link(f"{fragmented.path}/{name}/{row['name']}", f"{old}/{row['name']}")
        if not keep_source:
            fragmented.folder.remove(f"{name}/{row['name']}")
    recover(fragmented)
    assert ids(fragmented.scan()) == before
    assert files(fragmented)[name] == 1


def _before_swap(table, monkeypatch, action):
    """Run an action when a compaction has staged its files and is about to take the lease."""
    real, calls = table.lease.__class__.__enter__, []

    def enter(lease):
        if lease is table.lease and not lease.held:
            calls.append(lease)
            if len(calls) == 2:  # the first settles what was left
                action()
        return real(lease)

    monkeypatch.setattr(table.lease.__class__, "__enter__", enter)


def test_rows_appended_during_a_compaction_stay(spark, raw, fragmented, monkeypatch):
    other = events_table(spark, fragmented.path)
    done = []

    def land():
        done.append(land_batch(raw([event("late", DAY1 + 9)]), other).rowsInserted)

    _before_swap(fragmented, monkeypatch, land)
    compact(fragmented, "eventId")
    monkeypatch.undo()
    assert done == [1]
    assert fragmented.scan().count() == 12
    vacuum(fragmented, 0, allow_short=True)
    assert fragmented.scan().count() == 12


def test_opening_during_a_swap_disturbs_nothing(spark, fragmented, monkeypatch):
    before = ids(fragmented.scan())
    moves = []

    def move(source, target, real=fragmented.folder.move):
        moves.append(events_table(spark, fragmented.path))
        real(source, target)

    monkeypatch.setattr(fragmented.folder, "move", move)
    compact(fragmented)
    monkeypatch.undo()
    assert len(moves) == 6
    vacuum(fragmented, 0, allow_short=True)
    assert ids(fragmented.scan()) == before


def test_a_second_compaction_of_the_same_files_gives_up(spark, fragmented, monkeypatch):
    before = ids(fragmented.scan())
    other = events_table(spark, fragmented.path)
    _before_swap(fragmented, monkeypatch, lambda: compact(other))
    compact(fragmented)
    monkeypatch.undo()
    assert ids(fragmented.scan()) == before
    assert fragmented.folder.names("_staging") == []


def test_one_writer_at_a_time(spark, events):
    other = events_table(spark, events.path)
    other.lease.wait = 0.1
    with writing(events), writing(events):
        with pytest.raises(LeaseHeld, match="being written"), writing(other):
            pass
    assert other.lease.epoch == 0
    with writing(other):
        assert other.lease.epoch == events.lease.epoch + 1
        assert len(events.folder.names("_lease")) == 1


def test_lost_lease_is_taken_over_and_a_live_one_renewed(spark, events):
    name = "_lease/000000000041.json"
    events.folder.create_text(name, '{"token": "of a dead job"}')
    os.utime(f"{events.path}/{name}", (1, 1))
    events.lease.seconds = 1.0
    with writing(events):
        assert events.lease.epoch == 42
        other = events_table(spark, events.path)
        other.lease.seconds, other.lease.wait = 1.0, 2.5
        with pytest.raises(LeaseHeld), writing(other):
            pass
    with writing(other):
        assert other.lease.epoch == 43


def test_only_small_files_are_rewritten(raw, events):
    """A packed date with two tiny files: the packed files stay."""
    for i in range(3):
        land_batch(raw([event(f"{i}-{j:05}", DAY1, url=f"/{j * 7919}") for j in range(3000)]), events)
    packed = {p for p in events.folder.visible("eventDate=2024-07-03")}
    least = min(os.path.getsize(f"{events.path}/eventDate=2024-07-03/{p}") for p in packed)
    for name in ("tiny1", "tiny2"):
        land_batch(raw([event(name, DAY1)]), events)
    done = compact(events, target_file_bytes=least)
    assert done.files_before == 2 and done.bytes_before < least
    after = set(events.folder.visible("eventDate=2024-07-03"))
    assert packed < after and len(after) == len(packed) + 1
    assert events.scan().count() == 9002
    assert compact(events, target_file_bytes=least).partitions == 0


def test_two_tiny_files_are_merged(raw, events, dead):
    for i in range(2):
        land_batch(raw([event(f"e{i}")]), events)
        merge_dead_letters(dead_letters(raw([("bad", 0, i)])), dead)
    for table in (events, dead):
        compact(table)
        assert list(files(table).values()) == [1] and table.scan().count() == 2


def test_vacuum_leaves_foreign_names(fragmented):
    fragmented.folder.make("_old/notes")
    assert vacuum(fragmented, 0, allow_short=True) == 0
    assert fragmented.folder.names("_old") == ["notes"]


def test_reports_without_optional_columns(spark):
    frame = spark.createDataFrame([("a",)], "eventId string")
    assert rows_per_date(frame).collect() == [] and top_event_types(frame).collect() == []


def test_verification_refuses_an_unfinished_swap(spark, fragmented, monkeypatch, capsys):
    _stop_at_move(fragmented, monkeypatch, 3)
    monkeypatch.setenv("STORAGE_BASE_PATH", os.path.dirname(fragmented.path))
    monkeypatch.setenv("STORAGE_TABLE_NAME", os.path.basename(fragmented.path))
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    assert command.main(["verify"]) == command.UNSETTLED
    assert "NOT VERIFIED" in capsys.readouterr().out
    recover(fragmented)
    assert command.main(["verify"]) == 0


def test_cadence():
    every_third = MaintenanceSettings(enabled=True, every_batches=3)
    assert [b for b in range(9) if is_due(b, every_third)] == [2, 5, 8]
    assert not is_due(2, MaintenanceSettings(enabled=False, every_batches=3))
    assert not is_due(0, MaintenanceSettings(enabled=True, every_batches=0))


def test_job_temporary_files_are_not_read(raw, events):
    land_batch(raw([event("a")]), events)
    directory = f"{events.path}/eventDate=2024-07-03"
    (file,) = events.folder.visible("eventDate=2024-07-03")
    leftover = f"{events.path}/_temporary/0/eventDate=2024-07-03"
    os.makedirs(leftover)
    os.link(f"{directory}/{file}", f"{leftover}/{file}")
    assert ids(events.scan()) == ["a"]


def test_fresh_dead_letters_read_no_texts_of_the_table(spark, raw, dead, monkeypatch):
    """Only coordinates are read of the table, unless one of them is stored already."""
    scans = []

    def scan(real=dead.scan):
        frame = real()
        scans.append(frame)
        return frame

    monkeypatch.setattr(dead, "scan", scan)
    merge = lambda *values: merge_dead_letters(dead_letters(raw(list(values))), dead)
    assert merge(("a", 0, 1), ("b", 1, 1)) == 2
    assert merge(("c", 0, 2), ("d", 1, 3)) == 2
    assert len(scans) == 2
    assert merge(("c", 0, 2), ("e", 0, 2), ("f", 0, 4), (None, 0, 5)) == 3
    assert len(scans) == 4
    assert sorted(r.rawValue or "" for r in dead.scan().collect()) == ["", "a", "b", "c", "d", "e", "f"]


def test_rows_of_other_log_partitions_are_skipped(spark, raw, dead, monkeypatch):
    """Offsets of the log's partitions lie 10**9 apart; a batch has letters of two of the three."""
    far = 10**9
    for p in range(3):
        letters = [("bad", p, p * far + i) for i in range(50)]
        assert merge_dead_letters(dead_letters(raw(letters)), dead) == 50
    seen = []

    def stored(*args, real=ingest.stored_keys, **options):
        hits = real(*args, **options)
        seen.append(hits)
        return hits

    monkeypatch.setattr(ingest, "stored_keys", stored)
    batch = [("bad", 0, 49), ("new", 0, 51), ("bad", 2, 2 * far + 3)]
    assert merge_dead_letters(dead_letters(raw(batch)), dead) == 1
    (hits,) = seen
    hits.collect()
    assert rows_read(hits) == 100  # of 151, and 150 by one range over all
    assert dead.scan().count() == 151


def test_offset_ranges_hold_every_record(spark):
    rows = [(0, 5), (0, 9), (1, None), (None, 7), (None, None), (2, 10**12)]
    frame = spark.createDataFrame(rows, "kafkaPartition int, kafkaOffset long")
    assert frame.where(ingest.offset_ranges(frame)).count() == len(rows)
    other = spark.createDataFrame([(0, 4), (1, 5), (2, 6), (3, 7)], frame.schema)
    known = frame.where("kafkaPartition IS NOT NULL AND kafkaOffset IS NOT NULL")
    assert other.where(ingest.offset_ranges(known)).count() == 0
    assert ingest.offset_ranges(frame.limit(0)) is None
    many = spark.range(300).selectExpr("CAST(id AS INT) AS kafkaPartition", "id AS kafkaOffset")
    assert ingest.offset_ranges(many) is None
