"""The reports of one pass, what plans have read, and how wide they shuffle."""

import datetime
import re

import pytest
from helpers import DAY1, DAY2, event

from eventlake import __main__ as command
from eventlake.operators import (
    clickstream_events,
    exactly_once,
    rows_per_date,
    top_event_types,
    verify,
)
from eventlake.operators.evidence import files_read, scan_count
from eventlake.plans import land_batch, merge_insert
from eventlake.session import WIDTHS, input_bytes, sized_shuffles

REPORTS = [
    (exactly_once, verify.exactly_once_of),
    (rows_per_date, verify.rows_per_date_of),
    (top_event_types, verify.top_event_types_of),
]


@pytest.fixture
def table(raw, events):
    batch = [event("a", DAY1), event("b", DAY2), event("c", DAY2, eventType="view")]
    land_batch(raw([*batch, event("n", None), event("t", DAY1, eventType=None)]), events)
    return events


def test_one_scan_gives_the_three_reports(raw, table):
    table.append(clickstream_events(raw([event("a", DAY1)])), 1)  # stored twice
    verified = verify.verification(table.scan()).persist()
    verified.count()
    assert scan_count(verified) == 1
    for plain, of in REPORTS:
        assert of(verified).collect() == plain(table.scan()).collect()
        assert of(verified).columns == plain(table.scan()).columns
    assert verify.exactly_once_of(verified).first() == (6, 5, False)
    verified.unpersist()


def test_rows_without_id_and_empty_tables(spark, events):
    verified = verify.verification(events.scan())
    assert [of(verified).collect() for _, of in REPORTS] == [[(0, 0, True)], [], []]
    frame = spark.createDataFrame([(None, "x"), ("a", "x"), ("a", None)], "eventId string, eventType string")
    verified = verify.verification(frame)
    assert verify.exactly_once_of(verified).first() == (2, 1, False)
    assert verify.rows_per_date_of(verified).collect() == []
    assert verify.top_event_types_of(verified).collect() == [("x", 2), (None, 1)]


def test_tables_without_optional_columns(spark):
    frame = spark.createDataFrame([("a",), ("b",)], "eventId string")
    verified = verify.verification(frame)
    assert verify.exactly_once_of(verified).first() == (2, 2, True)
    assert verify.rows_per_date_of(verified).collect() == []
    dated = frame.selectExpr("*", "DATE'2024-07-03' AS eventDate")
    verified = verify.verification(dated)
    assert verify.rows_per_date_of(verified).collect() == [(datetime.date(2024, 7, 3), 2)]


def test_files_read_by_a_match(spark, raw, events):
    for i in range(4):
        land_batch(raw([event(f"a{i}", DAY1 + i * 86_400_000)]), events)
    late = clickstream_events(raw([event("a3", DAY1 + 3 * 86_400_000)]))
    outcome = merge_insert(events, late, ["eventId"])
    assert (outcome.matched_rows, outcome.files_read) == (1, 1)
    outcome = merge_insert(events, late, ["eventId"], scope="table")
    assert outcome.files_read == 4
    everything = clickstream_events(raw([event("a0", DAY1), event("a3", DAY1 + 3 * 86_400_000)]))
    assert merge_insert(events, everything, ["eventId"]).files_read == 4
    frame = events.scan().persist()
    frame.count()
    assert files_read(frame) == 4
    frame.unpersist()


def reducers(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [int(n) for n in re.findall(r"hashpartitioning\([^)]*?, (\d+)\)", plan)]


def test_shuffles_are_as_wide_as_the_files(spark, table):
    before = [spark.conf.get(name, None) for name in WIDTHS]
    size = input_bytes(table.scan())
    assert size > 0
    with sized_shuffles(spark, size, bytes_per_task=size // 20) as width:
        assert width >= 20
        verified = verify.verification(table.scan())
        assert max(reducers(verified)) == width
    with sized_shuffles(spark, size) as width:  # never below the session's own
        assert width == max(int(w) for w in before if w)
    assert [spark.conf.get(name, None) for name in WIDTHS] == before


def test_pruned_directories_are_not_counted(spark, table):
    whole = input_bytes(table.scan())
    assert 0 < input_bytes(table.scan_window("2024-07-03", "2024-07-03", False)) < whole
    assert input_bytes(spark.range(5)) >= 0


def test_job_sizes_its_shuffles(spark, table, monkeypatch, capsys):
    widths = []

    def sized(session, size, real=sized_shuffles):
        widths.append(size)
        return real(session, size)

    monkeypatch.setattr(command, "sized_shuffles", sized)
    monkeypatch.setenv("STORAGE_BASE_PATH", table.path.rpartition("/")[0])
    monkeypatch.setenv("STORAGE_TABLE_NAME", table.path.rpartition("/")[2])
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    assert command.main(["verify"]) == 0
    assert widths == [input_bytes(table.scan())]
    out = capsys.readouterr().out
    assert "rows with an id: 5, distinct ids: 5" in out and "PASS" in out
