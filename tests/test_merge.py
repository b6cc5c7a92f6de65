"""Insert-only merge and landing of whole batches."""

import pytest
from helpers import DAY1, DAY2, DAY3, event, ids
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake import session
from eventlake.operators import clickstream_events, dead_letters
from eventlake.plans import events_table, land_batch, merge, merge_insert
from eventlake.plans.ingest import BatchCounts, merge_dead_letters
from eventlake.plans.merge import MergeOutcome
from eventlake.schema import EVENT_SCHEMA
from eventlake.settings import MergeSettings
from eventlake.sources import SchemaConflict
from eventlake.sources import table as table_module

TABLE_SCOPE = MergeSettings(scope="table")
SHUFFLED = MergeSettings(broadcast_bytes=0)


def test_unique_insert(raw, events):
    counts = land_batch(raw([event("a"), event("b")]), events)
    assert counts == BatchCounts(2, 2, 2, 0, 2, 0)
    assert ids(events.scan()) == ["a", "b"]


@pytest.mark.parametrize("merge", [MergeSettings(), TABLE_SCOPE, SHUFFLED])
def test_replay_changes_nothing(raw, events, merge):
    batch = raw([event("x"), event("y")])
    inserted = [land_batch(batch, events, merge=merge).rowsInserted for _ in range(3)]
    assert inserted == [2, 0, 0]
    assert ids(events.scan()) == ["x", "y"]


@pytest.mark.parametrize("merge", [MergeSettings(), TABLE_SCOPE, SHUFFLED])
def test_overlap_inserts_only_new_ids(raw, events, merge):
    land_batch(raw([event("1"), event("2", url="/kept")]), events, merge=merge)
    counts = land_batch(raw([event("2", url="/ignored"), event("3")]), events, merge=merge)
    assert counts.rowsInserted == 1
    assert ids(events.scan()) == ["1", "2", "3"]
    assert events.scan().where("eventId = '2'").first().url == "/kept"


def test_window_of_a_batch(raw, events):
    batch = clickstream_events(raw([event("a", DAY1), event("b", DAY2)]))
    outcome = merge_insert(events, batch, ["eventId"])
    assert outcome == MergeOutcome(2, 0, 2, ("2024-07-03", "2024-07-04"))


def test_empty_batch(raw, events):
    assert merge_insert(events, clickstream_events(raw([])), ["eventId"]) == MergeOutcome(0, 0, 0)
    assert land_batch(raw([]), events) == BatchCounts()
    assert events.scan().count() == 0


def test_batch_without_dates_matches_the_whole_table(raw, events):
    land_batch(raw([event("a", DAY1)]), events)
    outcome = merge_insert(events, clickstream_events(raw([event("a", None)])), ["eventId"])
    assert outcome == MergeOutcome(1, 1, 0, None)


def test_pruned_merge(raw, events):
    land_batch(raw([event("a", DAY1), event("b", DAY2)]), events)
    second = raw([event("b", DAY2), event("c", DAY3)])
    land_batch(second, events)
    land_batch(second, events)
    assert ids(events.scan()) == ["a", "b", "c"]


def test_window_lists_only_its_own_dates(raw, events):
    days = {"a": DAY1, "b": DAY2, "c": DAY3, "n": None}
    land_batch(raw([event(name, day) for name, day in days.items()]), events)
    window = events.scan_window("2024-07-04", "2024-07-05", with_null=False)
    assert ids(window) == ["b", "c"]
    assert all("2024-07-03" not in f for f in window.inputFiles())
    assert ids(events.scan_window("2024-07-04", "2024-07-04", with_null=True)) == ["b", "n"]
    assert events.scan_window("2025-01-01", "2025-01-02", with_null=True) is not None
    assert events.scan_window("2025-01-01", "2025-01-02", with_null=False) is None


def test_null_dates_are_matched_on_replay(raw, events):
    batch = raw([event("dated", DAY1), event("undated", None)])
    for _ in range(2):
        land_batch(batch, events)
    assert ids(events.scan()) == ["dated", "undated"]


def test_id_resent_outside_the_window(raw, events):
    land_batch(raw([event("a", DAY1)]), events)
    later = raw([event("a", DAY3)])
    assert land_batch(later, events, merge=TABLE_SCOPE).rowsInserted == 0
    assert land_batch(later, events).rowsInserted == 1
    assert ids(events.scan()) == ["a", "a"]


def test_id_resent_on_another_date_inside_the_window(raw, events):
    land_batch(raw([event("a", DAY1)]), events)
    counts = land_batch(raw([event("a", DAY2), event("b", DAY1)]), events)
    assert counts.rowsInserted == 1
    assert ids(events.scan()) == ["a", "b"]


def test_years_beyond_9999_and_below_zero(raw, events):
    batch = raw([event("far", 1_600_000_000_000_000), event("old", -1_600_000_000_000_000)])
    assert [land_batch(batch, events).rowsInserted for _ in range(2)] == [2, 0]
    dates = events.scan().selectExpr("cast(eventDate as string) d").collect()
    assert sorted(r.d for r in dates) == ["+52671-12-25", "-48732-01-07"]


def test_duplicate_source_keys_are_refused(raw, events):
    batch = clickstream_events(raw([event("a")]))
    with pytest.raises(ValueError, match="several rows for one key"):
        merge_insert(events, batch.union(batch), ["eventId"])
    assert events.scan().count() == 0


def test_unknown_scope_is_refused(raw, events):
    with pytest.raises(ValueError, match="scope"):
        merge_insert(events, clickstream_events(raw([])), ["eventId"], scope="all")


@pytest.mark.parametrize("merge", [MergeSettings(), SHUFFLED])
def test_hot_stored_key(raw, events, merge):
    """A stored id with many copies still counts as one match."""
    land_batch(raw([event("hot")]), events)
    row = events.scan().first()
    copies = events.scan().withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(5000)))).drop("n")
    events.append(copies, 5000)
    assert row.eventId == "hot"
    counts = land_batch(raw([event("hot"), event("new")]), events, merge=merge)
    assert (counts.rowsUnique, counts.rowsInserted) == (2, 1)


def test_partial_append_is_completed(raw, events):
    """Files of a batch that went missing are filled in by a replay, and only those."""
    batch = raw([event(f"{d}-{i}", d) for d in (DAY1, DAY2, DAY3) for i in range(20)])
    land_batch(batch, events)
    events.folder.remove("eventDate=2024-07-04")
    assert events.scan().count() == 40
    assert land_batch(batch, events).rowsInserted == 20
    assert land_batch(batch, events).rowsInserted == 0
    assert len(set(ids(events.scan()))) == events.scan().count() == 60


def test_hot_date_is_split_over_files(spark, raw, tmp_path):
    table = events_table(spark, str(tmp_path / "small-files"), rows_per_file=100)
    land_batch(raw([event(f"a{i:04}", DAY1) for i in range(1000)] + [event("b", DAY2)]), table)
    files = table.folder.visible("eventDate=2024-07-03")
    assert 8 <= len(files) <= 14
    path = f"{table.path}/eventDate=2024-07-03"
    spans = (
        spark.read.parquet(path)
        .groupBy(F.input_file_name())
        .agg(F.min("eventId").alias("low"), F.max("eventId").alias("high"))
        .orderBy("low")
        .collect()
    )
    assert all(a.high < b.low for a, b in zip(spans, spans[1:], strict=False))


def test_broadcast_merge_does_not_shuffle_the_table(raw, events):
    from eventlake.plans.merge import _stored_keys

    land_batch(raw([event("a"), event("b")]), events)
    source = clickstream_events(raw([event("a")])).select("eventId")
    window = events.scan_window("2024-07-03", "2024-07-03", with_null=False).select("eventId")
    plan = _stored_keys(window, source, ["eventId"], True, False)._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "LeftSemi, BuildRight" in physical
    join = physical[physical.index("BroadcastHashJoin") :]
    target = join[: join.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in target
    assert "ReadSchema: struct<eventId:string>" in physical


def test_shuffled_merge_shuffles_the_table_once(raw, events):
    from eventlake.plans.merge import _stored_keys

    land_batch(raw([event("a"), event("b")]), events)
    events.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source = clickstream_events(raw([event("a")])).select("eventId")
        target = events.scan().select("eventId")
        plan = _stored_keys(target, source, ["eventId"], False, False)
        text = plan._jdf.queryExecution().toString()
    finally:
        events.spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    physical = text[text.index("== Physical Plan ==") :]
    # One exchange for the table's keys and one for the source's own deduplication.
    assert physical.count("Exchange hashpartitioning(eventId") == 2


# -- dead letters -------------------------------------------------------------------------


def test_dead_letters_land_once(raw, events, dead):
    batch = raw([(event("g1"), 0, 1), ("bad", 0, 10), (event("g2"), 0, 2), ("bad", 0, 11)])
    first, second = (land_batch(batch, events, dead) for _ in range(2))
    assert first == BatchCounts(4, 2, 2, 2, 2, 2)
    assert second == BatchCounts(4, 2, 2, 2, 0, 0)
    assert {r.kafkaOffset for r in dead.scan().collect()} == {10, 11}


def test_no_dead_letters_writes_no_file(raw, events, dead):
    land_batch(raw([event("a")]), events, dead)
    assert dead.folder.visible() == []


def test_repeated_offset_in_one_batch_is_stored_once(raw, dead):
    letters = dead_letters(raw([("bad", 0, 1), ("bad", 0, 1), ("bad", 1, 1)]))
    assert merge_dead_letters(letters, dead) == 2


@pytest.mark.parametrize("broadcast_bytes", [0, 1_000_000])
def test_letters_with_odd_coordinates_are_kept_apart_and_land_once(raw, dead, broadcast_bytes):
    batch = [("x", None, 1), ("y", None, 1), ("z", None, None), (None, None, None), ("x", 0, 1)]
    letters = dead_letters(raw([*batch, ("same place", 0, 1), (None, 0, 1)]))
    landed = [merge_dead_letters(letters, dead, broadcast_bytes) for _ in range(2)]
    assert landed == [7, 0]
    assert dead.scan().count() == 7


def test_dead_letter_match_reads_only_its_offset_range(raw, dead):
    from eventlake.plans.merge import SourceProfile, _within_key_range

    profile = SourceProfile(1, first_key=5, last_key=9)
    plan = _within_key_range(dead.scan(), "kafkaOffset", profile, True)._jdf.queryExecution()
    assert "GreaterThanOrEqual(kafkaOffset,5), LessThanOrEqual(kafkaOffset,9)" in plan.toString()


def test_shuffled_dead_letter_merge(raw, dead):
    letters = dead_letters(raw(["a", "b", ("c", None, 5)]))
    assert [merge_dead_letters(letters, dead, broadcast_bytes=0) for _ in range(2)] == [3, 0]


def test_whole_text_is_kept(raw, events, dead):
    text = "word " * 200_000
    land_batch(raw([text]), events, dead)
    assert dead.scan().first().rawValue == text


# -- schema ------------------------------------------------------------------------------


def test_new_column_widens_the_table(raw, events):
    land_batch(raw([event("e1")]), events)
    batch = clickstream_events(raw([event("e2")])).withColumn("channel", F.lit("mobile"))
    merge_insert(events, batch, ["eventId"])
    land_batch(raw([event("e3")]), events)
    got = {r.eventId: r.channel for r in events.scan().collect()}
    assert got == {"e1": None, "e2": "mobile", "e3": None}


def test_longer_payload_flows_from_json_to_table(raw, events):
    longer = T.StructType([*EVENT_SCHEMA.fields, T.StructField("channel", T.StringType())])
    land_batch(raw([event("e1", channel="lost")]), events)
    land_batch(raw([event("e2", channel="web")]), events, payload=longer)
    assert {r.eventId: r.channel for r in events.scan().collect()} == {"e1": None, "e2": "web"}


def test_type_conflict_is_refused_and_leaves_the_table_alone(raw, events):
    land_batch(raw([event("e1")]), events)
    batch = clickstream_events(raw([event("e2")])).withColumn("AMOUNT", F.lit("12"))
    with pytest.raises(SchemaConflict, match="AMOUNT"):
        merge_insert(events, batch, ["eventId"])
    assert ids(events.scan()) == ["e1"]


def test_column_names_match_without_case(raw, events):
    batch = clickstream_events(raw([event("e1", url="/a")])).withColumnRenamed("url", "URL")
    merge_insert(events, batch, ["eventId"])
    assert "URL" not in events.scan().columns
    assert events.scan().first().url == "/a"


def test_narrower_number_is_stored_in_the_wider_type(raw, events):
    batch = clickstream_events(raw([event("e1", amount=2)]))
    narrow = batch.withColumn("amount", F.col("amount").cast("int"))
    merge_insert(events, narrow, ["eventId"])
    assert dict(events.scan().dtypes)["amount"] == "double"
    assert events.scan().first().amount == 2.0
    with pytest.raises(SchemaConflict):
        merge_insert(events, batch.withColumn("kafkaPartition", F.lit(1).cast("long")), ["eventId"])


def test_table_under_a_uri(spark, raw, tmp_path):
    table = events_table(spark, f"file://{tmp_path}/a,b/events/")
    batch = raw([event("a", DAY1), event("b", DAY2)])
    assert [land_batch(batch, table).rowsInserted for _ in range(2)] == [2, 0]
    assert table.directories() == ["eventDate=2024-07-03", "eventDate=2024-07-04"]


def test_shuffled_match_filters_the_table_by_the_batch(spark, raw, events, monkeypatch):
    """Spark's Bloom filter of the batch's keys is on the table's side, under its shuffle."""
    land_batch(raw([event(f"a{i}", DAY1) for i in range(200)]), events)
    plans = []

    def stored(*args, real=merge._stored_keys):
        hits = real(*args)
        plans.append(hits._jdf.queryExecution().optimizedPlan().toString())
        return hits

    monkeypatch.setattr(merge, "_stored_keys", stored)
    batch = raw([event("a7"), event("a9"), event("b1")])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session.settings(spark, {"spark.sql.autoBroadcastJoinThreshold": -1}):  # as if large
        counts = land_batch(batch, events, merge=MergeSettings(broadcast_bytes=0))
    assert (counts.rowsUnique, counts.rowsInserted) == (3, 1)
    (plan,) = plans
    table_side, _, _ = plan.partition("InMemoryRelation")
    assert "might_contain" in table_side and "bloom_filter_agg" in plan
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    land_batch(batch, events)
    assert "might_contain" not in plans[1]  # a broadcast match needs none


def test_shuffled_merge_into_an_empty_table_with_sparks_own_width(spark, raw, events):
    width = "spark.sql.shuffle.partitions"
    before = spark.conf.get(width)
    spark.conf.unset(width)  # as in a session that leaves Spark's default
    try:
        default = int(spark.conf.get(width))
        with session.sized_shuffles(spark, 0) as now:
            assert now == default and spark.conf.get(width) == str(default)
        settings = MergeSettings(scope="table", broadcast_bytes=0)
        for inserted in (2, 0):
            counts = land_batch(raw([event("e1"), event("e2", DAY2)]), events, merge=settings)
            assert counts.rowsInserted == inserted
    finally:
        spark.conf.set(width, before)
    assert ids(events.scan()) == ["e1", "e2"]


def test_too_many_keys_are_not_filtered(spark):
    name = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = spark.conf.get(name)
    with session.runtime_key_filter(spark, session.MOST_FILTERED_KEYS + 1):
        assert spark.conf.get(name) == before
    with session.runtime_key_filter(spark, 5):
        assert spark.conf.get(name) == "0"
    assert spark.conf.get(name) == before


def test_long_rows_are_written_by_more_tasks(raw, dead, monkeypatch):
    """Their number alone would send whole documents to one task."""
    monkeypatch.setattr(table_module, "TEXT_BYTES_PER_FILE", 1_000)
    letters = dead_letters(raw([("x" * 500 + str(i), 0, i) for i in range(12)]))
    assert merge_dead_letters(letters, dead) == 12
    assert len(dead.scan().inputFiles()) > 3
    assert merge_dead_letters(letters, dead) == 0
    assert dead.scan().count() == 12
