"""A writer that has lost its table puts nothing in place."""

import os
import signal
import subprocess
import sys
from pathlib import Path

import pytest
from helpers import DAY1, event, ids

from eventlake.operators import clickstream_events
from eventlake.plans import compact, events_table, land_batch, recover, writing
from eventlake.sources.lease import Lease, LeaseHeld, LeaseLost

REPO = Path(__file__).resolve().parents[1]

CHILD = """
import sys, time
from pathlib import Path
from pyspark.sql import SparkSession
from eventlake.plans import events_table, land_batch
from eventlake.schema import RAW_SCHEMA
from eventlake.sources.lease import LeaseLost

path, value, go = sys.argv[1:]
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
table = events_table(spark, path)
table.lease.seconds = 3.0
add = table.touched.add

def stalled(directories):
    print("staged", flush=True)
    while not Path(go).exists():
        time.sleep(0.01)
    add(directories)

table.touched.add = stalled
raw = spark.createDataFrame([(bytearray(value, "utf-8"), 0, 0)], RAW_SCHEMA)
try:
    print("landed", land_batch(raw, table).rowsInserted, flush=True)
except LeaseLost as lost:
    print("lost", lost, flush=True)
"""


def take_over(table):
    """What another writer does: the next epoch."""
    newest = max(table.folder.names("_lease"))
    name = f"_lease/{int(newest.removesuffix('.json')) + 1:012d}.json"
    assert table.folder.create_text(name, '{"token": "of another"}')
    return name


def test_epochs_rise(spark, events):
    seen = []
    for table in (events, events_table(spark, events.path), events):
        with writing(table):
            seen.append(table.lease.epoch)
    assert seen == [seen[0], seen[0] + 1, seen[0] + 2]
    assert len(events.folder.names("_lease")) == 1


def test_two_processes_and_a_stalled_holder(spark, raw, events, tmp_path):
    """The first process stops between its Spark job and its commit, beyond the lease's time."""
    value, go = event("a", DAY1), tmp_path / "go"
    child = subprocess.Popen(
        [sys.executable, "-c", CHILD, events.path, value, str(go)],
        stdout=subprocess.PIPE,
        stderr=subprocess.DEVNULL,
        text=True,
        cwd=REPO,
    )
    try:
        assert child.stdout.readline().strip() == "staged"
        os.kill(child.pid, signal.SIGSTOP)
        events.lease.seconds = 3.0
        assert land_batch(raw([value]), events).rowsInserted == 1  # waits for the lease to run out
        go.touch()
        os.kill(child.pid, signal.SIGCONT)
        assert child.stdout.readline().startswith("lost epoch")
        assert child.wait(60) == 0
    finally:
        child.kill()
        child.wait()
    assert ids(events.scan()) == ["a"]
    assert land_batch(raw([value]), events).rowsInserted == 0
    assert events.folder.names("_staging") == []  # what the first had staged is gone


def test_failed_renewals_lose_the_lease(spark, raw, events, monkeypatch):
    other = events_table(spark, events.path)
    events.lease.seconds = other.lease.seconds = 1.0

    def fail(name, text):
        raise OSError("the store is away")

    rows = clickstream_events(raw([event("a")]))
    with pytest.raises(LeaseLost, match="epoch"), writing(events):
        monkeypatch.setattr(events.folder, "replace_text", fail)
        assert land_batch(raw([event("a")]), other).rowsInserted == 1
        events.append(rows, 1)
    monkeypatch.undo()
    assert ids(events.scan()) == ["a"]


def test_one_failed_renewal_is_tried_again(spark, events, monkeypatch):
    other = events_table(spark, events.path)
    events.lease.seconds = other.lease.seconds = 2.0
    other.lease.wait = 3.0
    failures = []

    def fail_once(name, text, real=events.folder.replace_text):
        if not failures:
            failures.append(name)
            raise OSError("the store is away")
        real(name, text)

    monkeypatch.setattr(events.folder, "replace_text", fail_once)
    with writing(events):
        with pytest.raises(LeaseHeld), writing(other):
            pass
        events.lease.check()
    assert failures


def test_store_that_cannot_be_asked_stops_the_writer(events, monkeypatch):
    def fail(name=""):
        raise OSError("the store is away")

    with pytest.raises(LeaseLost, match="could not be renewed"), writing(events):
        monkeypatch.setattr(events.folder, "names", fail)
        try:
            events.lease.check()
        finally:
            monkeypatch.undo()


def test_append_after_a_take_over_puts_nothing_in_place(raw, events, monkeypatch):
    rows = clickstream_events(raw([event("a")]))

    def add(directories, real=events.touched.add):
        take_over(events)
        real(directories)

    monkeypatch.setattr(events.touched, "add", add)
    with pytest.raises(LeaseLost):
        events.append(rows, 1)
    assert ids(events.scan()) == []


def test_widening_after_a_take_over_changes_nothing(raw, events):
    columns = events.scan().columns
    wider = clickstream_events(raw([event("a")])).selectExpr("*", "1 AS more").schema
    with pytest.raises(LeaseLost), writing(events):
        take_over(events)
        events.widen(wider)
    assert events.scan().columns == columns


@pytest.mark.parametrize("moves", [0, 2])
def test_swap_after_a_take_over_leaves_the_rest_to_the_next_holder(
    spark, raw, events, monkeypatch, moves
):
    for i in range(4):
        land_batch(raw([event(f"a{i}")]), events)
    before, done, taken = ids(events.scan()), [], []

    def check(real=events.lease.check):
        if len(done) == moves and events.folder.names("_staging"):
            taken.append(take_over(events))
        done.append(1)
        real()

    monkeypatch.setattr(events.lease, "check", check)
    with pytest.raises(LeaseLost):
        compact(events)
    monkeypatch.undo()
    assert taken
    os.utime(f"{events.path}/{taken[0]}", (1, 1))  # the other one has ended
    reopened = events_table(spark, events.path)
    assert land_batch(raw([event("a1"), event("a9")]), reopened).rowsInserted == 1
    assert ids(reopened.scan()) == sorted([*before, "a9"])
    recover(reopened)
    assert reopened.folder.names("_staging") == []


def test_checking_without_the_lease_is_refused(events):
    with pytest.raises(LeaseLost, match="without its lease"):
        events.lease.check()


def test_late_renewal_of_the_former_holder_is_respected(events, monkeypatch):
    """It renews after another has found it to have run out, and before that one is done."""
    events.lease.seconds = 60.0
    with writing(events):
        other = Lease(events.folder, 60.0, wait=0.2)
        answers = iter([True])  # found over once, then as it is
        monkeypatch.setattr(
            other, "_is_over", lambda e, real=other._is_over: next(answers, None) or real(e)
        )
        with pytest.raises(LeaseHeld):
            other.__enter__()
        events.lease.check()


def test_long_compaction_keeps_its_staging_directory(spark, raw, events, monkeypatch):
    """Another writer settles the table while a compaction is at work, however old its run."""
    from eventlake.plans import upkeep

    for i in range(3):
        land_batch(raw([event(f"a{i}")]), events)
    other, seen = events_table(spark, events.path), []
    monkeypatch.setattr(upkeep, "ABANDONED_HOURS", 0)

    def scan(*args, real=upkeep._scan_inputs):
        recover(other)
        seen.extend(other.folder.names("_staging"))
        return real(*args)

    monkeypatch.setattr(upkeep, "_scan_inputs", scan)
    assert compact(events).files_before == 3
    assert len(seen) == 2 and len(events.folder.visible("eventDate=2024-07-03")) == 1


def test_staging_of_ended_work_is_removed(spark, raw, events, monkeypatch):
    from eventlake.plans import upkeep

    for i in range(3):
        land_batch(raw([event(f"a{i}")]), events)

    def crash(*args):
        raise OSError("crash")

    monkeypatch.setattr(upkeep, "_scan_inputs", crash)
    with pytest.raises(OSError, match="crash"):
        compact(events)
    monkeypatch.undo()
    assert len(events.folder.names("_staging")) == 2
    recover(events_table(spark, events.path))
    assert events.folder.names("_staging") == []
