"""Spark session set-up."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from eventlake.settings import StorageSettings


def object_store_conf(storage: StorageSettings) -> dict[str, str]:
    """Hadoop S3A settings; empty without an endpoint, leaving the platform's own access."""
    if not storage.endpoint:
        return {}
    # Hadoop's S3A option names and classes.
    conf = {
        "fs.s3a.endpoint": storage.endpoint,
        "fs.s3a.path.style.access": str(storage.path_style_access).lower(),
        "fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "fs.s3a.connection.ssl.enabled": str(storage.endpoint.startswith("https:")).lower(),
    }
    if storage.access_key:
        conf |= {
            "fs.s3a.access.key": storage.access_key,
            "fs.s3a.secret.key": storage.secret_key,
            "fs.s3a.aws.credentials.provider": (
                "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider"
            ),
        }
    return conf


# Spark's and Hadoop's options and classes for writing to S3A without renames.
COMMIT_PROTOCOL = "org.apache.spark.internal.io.cloud.PathOutputCommitProtocol"
PARQUET_COMMITTER = "org.apache.spark.internal.io.cloud.BindingParquetOutputCommitter"
COMMITTER_CONF = {
    "spark.sql.sources.commitProtocolClass": COMMIT_PROTOCOL,
    "spark.sql.parquet.output.committer.class": PARQUET_COMMITTER,
}
COMMITTER_HADOOP_CONF = {"fs.s3a.committer.name": "magic", "fs.s3a.committer.magic.enabled": "true"}


def use_object_store_committer(spark: SparkSession, storage: StorageSettings) -> bool:
    """Let jobs commit to the object store by finishing uploads instead of renaming, which copies.

    Only with an endpoint set, and where the platform has Spark's cloud classes; False otherwise.
    """
    if not storage.endpoint:
        return False
    try:
        for name in (COMMIT_PROTOCOL, PARQUET_COMMITTER):
            spark._jvm.java.lang.Class.forName(name)
    except Py4JJavaError:
        return False
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for name, value in COMMITTER_HADOOP_CONF.items():
        hadoop.set(name, value)
    for name, value in COMMITTER_CONF.items():
        spark.conf.set(name, value)
    return True


def build_session(
    app_name: str,
    storage: StorageSettings | None = None,
    shuffle_partitions: int = 8,
    master: str | None = None,
) -> SparkSession:
    """A session for ingest, verification and upkeep.

    ``shuffle_partitions`` is the least width of a shuffle. Adaptive execution starts from twice
    the cluster's cores where that is more, merges small partitions and splits skewed ones.
    Memory and executor counts belong to spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.schemaInference", "false")
        # Every micro-batch builds its plans anew; recording a stack trace for each column
        # expression would be a good part of that time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in object_store_conf(storage or StorageSettings()).items():
        builder = builder.config(f"spark.hadoop.{key}", value)
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    width = max(shuffle_partitions, 2 * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", width)
    tune_cached_batches(spark)
    use_object_store_committer(spark, storage or StorageSettings())
    return spark


def tune_cached_batches(spark: SparkSession) -> None:
    """Let adaptive execution size the partitions of cached frames too.

    Otherwise a cached batch keeps the full width of its shuffle, and every later step of a small
    batch on a large cluster runs thousands of tasks over next to nothing.
    """
    spark.conf.set("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")


# Bytes on file that one reducer is meant for, and the settings that say how many there are.
SHUFFLE_BYTES = 64 * 1024 * 1024
WIDTHS = (
    "spark.sql.shuffle.partitions",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
)
# Spark's size of a plan it knows nothing of, and of anything built on one.
_UNKNOWN_BYTES = 1 << 60


def input_bytes(frame: DataFrame) -> int:
    """Bytes of the files a frame reads after partition pruning, from the listing its plan holds;
    0 if Spark cannot tell."""
    leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(size for size in sizes if 0 <= size < _UNKNOWN_BYTES)


@contextlib.contextmanager
def sized_shuffles(
    spark: SparkSession, size: int, bytes_per_task: int = SHUFFLE_BYTES
) -> Iterator[int]:
    """Queries run in this block shuffle to a reducer per ``bytes_per_task`` of ``size``, and never
    to fewer than the session says; adaptive execution merges what turns out small.

    The width a session starts with knows its cores and not its data.
    """
    # Spark's own default holds for the first where the session leaves it unset; the second has none.
    now = [spark.conf.get(WIDTHS[0]), spark.conf.get(WIDTHS[1], None)]
    width = max([-(-size // bytes_per_task), *(int(w) for w in now if w)])
    with settings(spark, dict.fromkeys(WIDTHS, width)):
        yield width


# Keys of a batch that Spark's Bloom filter is sized for by default.
MOST_FILTERED_KEYS = 4_000_000


@contextlib.contextmanager
def runtime_key_filter(spark: SparkSession, keys: int) -> Iterator[None]:
    """Shuffled joins planned in this block filter their large side's scan by a Bloom filter of the
    small side's keys, of which there are ``keys``. Spark wants a condition on the small side.

    Spark's own rule waits for a large side of 10 GB and a small one of 10 MB. Beyond the keys its
    filter is made for nothing changes.
    """
    prefix = "spark.sql.optimizer.runtime.bloomFilter."
    wanted = {"enabled": "true", "applicationSideScanSizeThreshold": "0"}
    wanted["creationSideThreshold"] = str(_UNKNOWN_BYTES)
    use = keys <= MOST_FILTERED_KEYS
    with settings(spark, {prefix + k: v for k, v in wanted.items()} if use else {}):
        yield


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict) -> Iterator[None]:
    """The session with these settings, put back at the end of the block."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder named in ``spark.checkpoint.dir``.

    Where that is unset the warehouse directory takes its place, which executors share too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/eventlake/{label}-{uuid.uuid4().hex}"
