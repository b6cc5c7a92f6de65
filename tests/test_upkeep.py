"""What upkeep looks at, and how it deals its work."""

import json
import re

import pytest
from helpers import DAY1, event, ids
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame as Classic

from eventlake.operators import dead_letters
from eventlake.operators.evidence import files_read
from eventlake.plans import compact, events_table, land_batch, maintain, upkeep
from eventlake.plans.ingest import BatchCounts, merge_dead_letters
from eventlake.settings import MaintenanceSettings
from eventlake.streaming import AuditLog
from eventlake.streaming.audit import AUDIT_SCHEMA

DAY = 86_400_000
UPKEEP = MaintenanceSettings(enabled=True, vacuum_retention_hours=0)


@pytest.fixture
def listed(monkeypatch):
    """Directories listed by upkeep; None stands for the whole table."""
    seen = []

    def listing(table, directories=None, real=upkeep._listing):
        seen.append(directories)
        return real(table, directories)

    monkeypatch.setattr(upkeep, "_listing", listing)
    return seen


@pytest.fixture
def collected(monkeypatch):
    """Rows of every collect."""
    seen = []

    def collect(self, real=Classic.collect):
        rows = real(self)
        seen.append(len(rows))
        return rows

    monkeypatch.setattr(Classic, "collect", collect)
    return seen


def touch(events, raw, batch, *days):
    land_batch(raw([event(f"{batch}-{d}", DAY1 + d * DAY) for d in days]), events)


def test_cadence_upkeep_lists_only_touched_dates(spark, raw, events, listed):
    """A table of 2,499 dates, one of which has been written to since the last upkeep."""
    number = F.col("id")
    rows = spark.range(2499).select(
        F.to_json(
            F.struct(
                F.concat(F.lit("e"), number).alias("eventId"),
                (F.lit(DAY1) + number * DAY).alias("timestamp"),
            )
        )
        .cast("binary")
        .alias("value"),
        F.lit(0).alias("partition"),
        number.alias("offset"),
    )
    land_batch(rows, events)
    assert len(events.directories()) == 2499
    assert maintain(events, UPKEEP, touched_only=True).partitions == 0
    listed.clear()
    for batch in range(2):
        touch(events, raw, batch, 0)
    done = maintain(events, UPKEEP, touched_only=True)
    assert (done.partitions, done.files_before) == (1, 3)
    assert listed and all(x == ["eventDate=2024-07-03"] for x in listed)
    assert events.scan().count() == 2501
    listed.clear()
    assert maintain(events, UPKEEP, touched_only=True).partitions == 0
    assert listed == []  # nothing touched, nothing listed
    maintain(events, UPKEEP)
    assert listed == [None]


def test_dates_touched_during_upkeep_are_left_for_the_next_one(raw, events, monkeypatch):
    for batch in range(2):
        touch(events, raw, batch, 0, 1)

    def compacting(*args, real=upkeep._rewrite, **options):
        monkeypatch.undo()
        touch(events, raw, "late", 1)
        real(*args, **options)

    monkeypatch.setattr(upkeep, "_rewrite", compacting)
    maintain(events, UPKEEP, touched_only=True)
    assert events.touched.take()[0] == {"eventDate=2024-07-04"}


def test_upkeep_cut_short_is_taken_up_by_the_next_one(raw, events, monkeypatch):
    for batch in range(2):
        touch(events, raw, batch, 0)

    def crash(*args):
        raise OSError("crash")

    monkeypatch.setattr(upkeep, "_rewrite", crash)
    with pytest.raises(OSError, match="crash"):
        maintain(events, UPKEEP, touched_only=True)
    monkeypatch.undo()
    touch(events, raw, 2, 1)
    assert maintain(events, UPKEEP, touched_only=True).files_before == 2
    assert events.folder.names("_touched") == []


def test_journal_is_written_only_when_it_grows(raw, events):
    touch(events, raw, 0, 0)
    first = events.folder.names("_touched")
    touch(events, raw, 1, 0)
    assert events.folder.names("_touched") == first
    touch(events, raw, 2, 0, 5)
    (name,) = events.folder.names("_touched")
    assert name > first[0]
    assert len(json.loads(events.folder.read_text(f"_touched/{name}"))) == 2


def test_null_dates_are_touched_too(raw, events):
    for i in range(2):
        land_batch(raw([event(f"n{i}", None)]), events)
    assert maintain(events, UPKEEP, touched_only=True).files_before == 2
    assert ids(events.scan()) == ["n0", "n1"]


def sized(table):
    rows = upkeep._listing(table).collect()
    return {(r["directory"], r["name"]): r["length"] for r in rows}


def test_one_large_directory_takes_several_jobs(raw, dead, collected, monkeypatch):
    """An unpartitioned table of two groups' size; the driver sees a row per group."""
    for i in range(8):
        merge_dead_letters(dead_letters(raw([("bad", 0, i)])), dead)
    before = sorted(map(tuple, dead.scan().collect()))
    files = sized(dead)
    half = sum(files.values()) // 2
    jobs = []

    def rewrite(*args, real=upkeep._rewrite):
        jobs.append(args[2]["files"])
        real(*args)

    monkeypatch.setattr(upkeep, "_rewrite", rewrite)
    collected.clear()
    done = compact(dead, target_file_bytes=half, group_bytes=half)
    assert len(jobs) == 2 and sum(jobs) == 8 and min(jobs) >= 2
    assert collected == [2]
    assert (done.partitions, done.files_before) == (1, 8)
    assert len(sized(dead)) == 2
    assert sorted(map(tuple, dead.scan().collect())) == before


def test_small_directories_share_a_job_and_a_hot_one_has_its_own(
    raw, events, collected, monkeypatch
):
    for batch in range(2):
        touch(events, raw, batch, 1, 2, 3)
    for batch in range(2, 9):
        touch(events, raw, batch, 2)
    files = sized(events)
    group = int(2.5 * max(files.values()))
    before = ids(events.scan())
    jobs = []

    def rewrite(*args, real=upkeep._rewrite):
        jobs.append((args[2]["directories"], args[2]["files"]))
        real(*args)

    monkeypatch.setattr(upkeep, "_rewrite", rewrite)
    collected.clear()
    done = compact(events, target_file_bytes=group, group_bytes=group)
    assert done.partitions == 3 and collected[0] == len(jobs)
    assert len([j for j in jobs if j[1] >= 2]) == len(jobs) >= 4
    assert ids(events.scan()) == before


def test_only_the_files_of_a_job_are_opened(spark, raw, dead):
    """Other files of the directory are turned away by size and name."""
    for i in range(8):
        merge_dead_letters(dead_letters(raw([("bad", 0, i)])), dead)
    half = sum(sized(dead).values()) // 2
    plan = "_staging/plan"
    groups, _ = upkeep._planned(dead, plan, half, half, None)
    inputs = [upkeep._inputs(dead, {"plan": plan, **g.asDict()}) for g in groups]
    for group, names in zip(groups, inputs, strict=True):
        rows = upkeep._scan_inputs(dead, [""], names, group, half)
        assert {r["kafkaOffset"] for r in rows.collect()}
        manifest = 1  # its file is read as well
        assert files_read(rows) == group["files"] + manifest and names.count() < 8


def test_audit_log_is_compacted_and_keeps_first_figures(spark, tmp_path):
    """A thousand batches."""
    audit = AuditLog(spark, str(tmp_path / "audit"))
    assert audit.record("q", 5000, BatchCounts(rowsRead=7), 1)
    values = [("q", i, i, 0, 0, 0, 0, 0, 1) for i in range(1000)]
    rows = spark.createDataFrame(values, AUDIT_SCHEMA).repartition(1000, "batchId")
    with upkeep.writing(audit.table):
        rows.write.mode("append").parquet(audit.table.path)
        audit.table.touched.add([""])
    files = len(sized(audit.table))
    assert files > 500
    maintain(audit.table, UPKEEP, touched_only=True)
    assert len(sized(audit.table)) < 20
    assert not audit.record("q", 500, BatchCounts(rowsRead=1), 1)
    assert not audit.record("q", 5000, BatchCounts(rowsRead=1), 1)
    assert audit.record("other", 500, BatchCounts(rowsRead=1), 1)
    found = audit.scan().where("queryId = 'q' AND batchId IN (500, 5000)").orderBy("batchId")
    assert [r["rowsRead"] for r in found.collect()] == [500, 7]
    assert audit.scan().count() == 1002


def test_audit_record_reads_its_key_range(spark, tmp_path, monkeypatch):
    audit, scans = AuditLog(spark, str(tmp_path / "audit")), []
    audit.record("q", 1, BatchCounts(), 1)
    from eventlake.plans import merge

    def within(target, *args, real=merge._within_key_range):
        found = real(target, *args)
        scans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(merge, "_within_key_range", within)
    audit.record("q", 2, BatchCounts(), 1)
    (plan,) = scans
    assert "GreaterThanOrEqual(batchId,2), LessThanOrEqual(batchId,2)" in plan.replace("`", "")


def test_small_directories_are_dealt_over_tasks_and_never_cut(spark, raw, events, monkeypatch):
    """A file per date, from more than one task: a single one would sort the whole group."""
    for batch in range(2):
        touch(events, raw, batch, *range(6))
    before = ids(events.scan())
    monkeypatch.setattr(upkeep, "TASK_BYTES", sum(sized(events).values()) // 3)
    compact(events, "eventId")
    files = list(sized(events))
    assert len(files) == len({directory for directory, _ in files}) == 6
    tasks = {re.search(r"-(\d{5})-", name)[1] for _, name in files}
    assert len(tasks) > 1
    assert ids(events.scan()) == before


def test_large_and_small_directories_are_merged_apart(raw, events, monkeypatch):
    """A directory of several files' size is cut by keys, the others stay whole."""
    for batch in range(8):
        touch(events, raw, batch, *(1, 2, 3) if batch < 2 else (2,))
    before, files = ids(events.scan()), sized(events)
    target = int(2.5 * max(files.values()))
    groups = []

    def rewrite(*args, real=upkeep._rewrite):
        groups.append((args[2]["directories"], args[2]["largest"] < 2 * target))
        real(*args)

    monkeypatch.setattr(upkeep, "_rewrite", rewrite)
    done = compact(events, target_file_bytes=target)
    assert sorted(groups) == [(1, False), (2, True)]
    assert (done.partitions, done.files_before) == (3, 12)
    assert ids(events.scan()) == before
