"""Settings, session options, the Kafka source's options and the command line."""

import pytest
from helpers import event

from eventlake import __main__ as cli
from eventlake import session
from eventlake.operators import clickstream_events
from eventlake.plans import events_table, land_batch
from eventlake.session import object_store_conf, scratch_path, tune_cached_batches
from eventlake.settings import ENVIRONMENT, Settings, StorageSettings
from eventlake.sources import kafka_options, kafka_stream


def test_defaults():
    s = Settings()
    assert s.kafka.max_offsets_per_trigger == 100_000
    assert s.stream.trigger_interval == "10 seconds"
    assert (s.stream.shuffle_partitions, s.stream.once) == (8, False)
    assert (s.dlq.enabled, s.dlq.table_name) == (False, "events_dlq")
    assert (s.maintenance.enabled, s.maintenance.every_batches) == (False, 50)
    assert (s.maintenance.zorder_column, s.maintenance.vacuum_retention_hours) == ("eventId", 168)
    assert s.merge.scope == "window"


def test_environment_overrides():
    env = {
        "KAFKA_TOPIC": "clicks",
        "KAFKA_MAX_OFFSETS_PER_TRIGGER": "500",
        "STREAM_ONCE": "TRUE",
        "DLQ_ENABLED": "yes",
        "MAINTENANCE_ZORDER_COLUMN": "",
        "UNRELATED": "x",
    }
    s = Settings.from_env(env)
    assert (s.kafka.topic, s.kafka.max_offsets_per_trigger) == ("clicks", 500)
    assert s.stream.once and s.dlq.enabled
    assert s.maintenance.zorder_column == ""
    assert Settings.from_env({}) == Settings()


def test_every_environment_variable_names_a_setting():
    for section, name in ENVIRONMENT.values():
        assert hasattr(getattr(Settings(), section), name)


def test_mapping_with_dashes():
    s = Settings.from_mapping({"storage": {"base-path": "file:///x/", "table-name": "t"}})
    assert s.storage.table_path == "file:///x/t"


@pytest.mark.parametrize(
    "values",
    [{"nope": {}}, {"kafka": {"nope": 1}}, {"stream": {"once": "maybe"}},
     {"kafka": {"max_offsets_per_trigger": "many"}}],
)
def test_bad_settings_are_refused(values):
    with pytest.raises(ValueError):
        Settings.from_mapping(values)


def test_paths_trim_the_trailing_slash():
    s = StorageSettings(base_path="s3a://b/delta/", checkpoint_path="s3a://b/ckpt/")
    assert s.table_path == "s3a://b/delta/events"
    assert s.checkpoint_for("events") == "s3a://b/ckpt/events"


def test_keys_are_not_printed():
    assert "secret" not in repr(StorageSettings(access_key="secret1", secret_key="secret2"))


def test_object_store_options():
    assert object_store_conf(StorageSettings()) == {}
    conf = object_store_conf(
        StorageSettings(endpoint="http://localhost:9000", access_key="a", secret_key="b")
    )
    assert conf["fs.s3a.endpoint"] == "http://localhost:9000"
    assert conf["fs.s3a.path.style.access"] == "true"
    assert conf["fs.s3a.connection.ssl.enabled"] == "false"
    assert (conf["fs.s3a.access.key"], conf["fs.s3a.secret.key"]) == ("a", "b")
    no_keys = object_store_conf(StorageSettings(endpoint="https://store"))
    assert "fs.s3a.access.key" not in no_keys
    assert no_keys["fs.s3a.connection.ssl.enabled"] == "true"


def test_kafka_options(spark):
    kafka = Settings.from_env({"KAFKA_TOPIC": "t", "KAFKA_BOOTSTRAP_SERVERS": "k:1"}).kafka
    assert kafka_options(kafka) == {
        "kafka.bootstrap.servers": "k:1",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "100000",
        "failOnDataLoss": "false",
    }
    # The connector is not installed here; the call must get as far as looking for it.
    with pytest.raises(Exception, match="kafka"):
        kafka_stream(spark, kafka)


def test_scratch_paths_lie_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = (scratch_path(spark, "x") for _ in range(2))
    assert first.startswith(f"{root}/eventlake/x-") and first != second


def test_small_cached_batch_does_not_keep_the_full_shuffle_width(spark):
    width = "spark.sql.shuffle.partitions"
    before = spark.conf.get(width)
    spark.conf.set(width, "64")
    tune_cached_batches(spark)
    try:
        batch = spark.range(1000).groupBy("id").count().persist()
        assert batch.count() == 1000
        assert batch.rdd.getNumPartitions() < 16
        batch.unpersist()
    finally:
        spark.conf.set(width, before)


@pytest.fixture
def command(spark, tmp_path, monkeypatch):
    """Run a command on the test session, which it must not stop."""
    monkeypatch.setenv("STORAGE_BASE_PATH", str(tmp_path))
    monkeypatch.setenv("MAINTENANCE_VACUUM_RETENTION_HOURS", "0")
    monkeypatch.setattr(cli, "build_session", lambda *a, **k: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    return lambda job: cli.main([job])


def test_commands(spark, raw, tmp_path, command, capsys):
    table = events_table(spark, f"{tmp_path}/events")
    for i in range(4):
        land_batch(raw([event(f"e{i}")]), table)
    assert command("verify") == 0
    assert "PASS" in capsys.readouterr().out
    assert command("maintain") == 0
    assert len(table.folder.visible("eventDate=2024-07-03")) == 1
    table.append(clickstream_events(raw([event("e0")])), 1)
    assert command("verify") == 1
    assert "FAIL" in capsys.readouterr().out


def test_object_store_committer_needs_endpoint_and_classes(spark, monkeypatch):
    before = {name: spark.conf.get(name, None) for name in session.COMMITTER_CONF}
    assert not session.use_object_store_committer(spark, StorageSettings())
    store = StorageSettings(endpoint="http://store:9000")
    assert not session.use_object_store_committer(spark, store)  # no cloud classes here
    assert {name: spark.conf.get(name, None) for name in before} == before
    monkeypatch.setattr(session, "COMMIT_PROTOCOL", "java.lang.String")
    monkeypatch.setattr(session, "PARQUET_COMMITTER", "java.lang.String")
    monkeypatch.setattr(session, "COMMITTER_CONF", {"spark.sql.example": "set"})
    try:
        assert session.use_object_store_committer(spark, store)
        assert spark.conf.get("spark.sql.example") == "set"
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        assert hadoop.get("fs.s3a.committer.name") == "magic"
    finally:
        spark.conf.unset("spark.sql.example")
