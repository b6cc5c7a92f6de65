"""Table upkeep between batches: rewrite small files, reclaim space, and when to do so."""

from __future__ import annotations

import contextlib
import datetime
import functools
import itertools
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.settings import MaintenanceSettings
from eventlake.sources.folder import Folder
from eventlake.sources.lease import Lease
from eventlake.sources.table import APPEND_RUN, RUN_FORMAT, STAGING_DIR, LakeTable, new_run

OLD_DIR = "_old"
TARGET_FILE_BYTES = 256 * 1024 * 1024
GROUP_BYTES = 1024**4
# What a task takes of directories that become one file each; sorting needs several times as much.
TASK_BYTES = 16 * 1024 * 1024
SAFE_RETENTION_HOURS = 168
# A staging directory that is not known to be anyone's work any more may be removed after that.
ABANDONED_HOURS = 48
MANIFEST = "_manifest.json"
INPUTS = "_inputs"
MOVES_AT_ONCE = 10_000
COMPACTED_PREFIX = "compact-"


@dataclass(frozen=True)
class Compaction:
    partitions: int = 0
    files_before: int = 0
    bytes_before: int = 0


def is_due(batch_id: int, maintenance: MaintenanceSettings) -> bool:
    """True after every ``every_batches``-th batch; read off the batch id, so restarts keep it."""
    every = maintenance.every_batches
    return maintenance.enabled and every > 0 and (batch_id + 1) % every == 0


@contextlib.contextmanager
def writing(table: LakeTable) -> Iterator[None]:
    """Hold the table's lease. Whoever gets it first settles a swap that its holder left undone."""
    table.lease.on_taken = lambda: recover(table)
    with table.lease:
        yield


def leased(step):
    """A step on a table, run with the table's lease."""

    @functools.wraps(step)
    def run(table: LakeTable, *args, **options):
        with writing(table):
            return step(table, *args, **options)

    return run


def maintain(
    table: LakeTable, maintenance: MaintenanceSettings, *, touched_only: bool = False
) -> Compaction:
    """Compact, clustered on the configured column if the table has it, then reclaim space.

    With ``touched_only`` only the directories written to since the last such upkeep are listed, so
    its cost follows the batches in between and not the table's history.

    A retention below a week is taken from the settings as it stands: someone set it on purpose.
    May run beside an ingest: see ``compact``.
    """
    column = maintenance.zorder_column
    column = column if column in table.schema().fieldNames() else None
    if touched_only:
        with writing(table):
            directories, taken = table.touched.take()
        done = compact(table, column, directories=sorted(directories))
        with writing(table):
            table.lease.check()
            table.touched.settle(taken)
    else:
        done = compact(table, column)
    vacuum(table, maintenance.vacuum_retention_hours, allow_short=True)
    return done


def partition_files(spark: SparkSession, table: LakeTable) -> DataFrame:
    """Data files and bytes per partition directory, from the file listing alone.

    The directory of an unpartitioned table is the empty name.
    """
    return (
        _listing(table)
        .groupBy("directory")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("size"))
    )


def compact(
    table: LakeTable,
    cluster_column: str | None = None,
    *,
    target_file_bytes: int = TARGET_FILE_BYTES,
    group_bytes: int = GROUP_BYTES,
    directories: Sequence[str] | None = None,
) -> Compaction:
    """Merge the small files of every partition that has two or more of them.

    Files from half the target size on are left alone, so what is rewritten is never more than
    what came in small. Rows are range-partitioned by (partition column, cluster column) and
    sorted, so each new file covers a narrow key range and a lookup skips the others. Without a
    cluster column the table's own cluster columns are used. ``directories`` are the only ones
    looked at, if given.

    A directory of less than two target sizes becomes one file. Such directories are never cut, and
    a task takes ``TASK_BYTES`` of them or a single one; of larger ones it takes a file's worth.

    The files are dealt over groups of about ``group_bytes``, each a Spark job: several small
    directories, or a part of a large one. File names stay in a manifest that tasks write; the
    driver sees a row per group. A group reads the files of its manifest while others may append.
    Only its swap holds the table's lease: it retires exactly the files it read, or gives up if one
    of them is gone.
    """
    with writing(table):
        pass  # settles what an earlier compaction left
    if directories is not None:
        directories = sorted(set(directories) & set(table.directories()))
        if not directories:
            return Compaction()
    group_bytes = max(group_bytes, target_file_bytes)  # so that a part has two files or more
    plan = f"{STAGING_DIR}/{new_run()}-plan"
    with Lease(Folder(table.spark, f"{table.path}/{plan}")):
        groups, totals = _planned(table, plan, target_file_bytes, group_bytes, directories)
        for group in groups:
            _rewrite(table, plan, group, cluster_column, target_file_bytes)
    table.folder.remove(plan)
    return totals


def unfinished(table: LakeTable) -> list[str]:
    """Compactions whose swap has begun and not ended: until then rows may be out of sight."""
    runs = table.folder.names(STAGING_DIR)
    return [r for r in runs if table.folder.exists(_join(STAGING_DIR, r, MANIFEST))]


def recover(table: LakeTable) -> None:
    """Settle compactions that were cut short, with the table's lease.

    One with a manifest had all its files staged and is finished. One without has changed
    nothing; it may still be at work, and then it holds a lease on its staging directory. Files of
    appends go when their writer has lost the table.
    """
    with table.lease:
        done = set(unfinished(table))
        for run in done:
            _swap(table, run)
        for run in set(table.folder.names(STAGING_DIR)) - done:
            if _is_abandoned(table, run):
                table.folder.remove(_join(STAGING_DIR, run))


def _is_abandoned(table: LakeTable, run: str) -> bool:
    """True if nobody can still use what is staged: an append of an epoch that is over, or work
    whose own lease has run out."""
    stamp, _, rest = run.partition("-")
    _, _, kind = rest.partition("-")
    kind, _, epoch = kind.partition("-")
    if kind == APPEND_RUN and epoch.isdigit():
        return int(epoch) < table.lease.epoch
    lease = Lease(Folder(table.spark, f"{table.path}/{_join(STAGING_DIR, run)}"))
    if lease.ever_held():
        return lease.is_over()
    began = _stamp_of(stamp)
    limit = _now() - datetime.timedelta(hours=ABANDONED_HOURS)
    return began is not None and began <= limit


def vacuum(
    table: LakeTable, retention_hours: float = SAFE_RETENTION_HOURS, *, allow_short: bool = False
) -> int:
    """Delete files replaced more than ``retention_hours`` ago; returns the number of runs freed.

    The age counts from the swap. A query that began before it may still read the replaced
    files, hence the week. Names that no compaction gave are left alone.
    """
    if retention_hours < SAFE_RETENTION_HOURS and not allow_short:
        raise ValueError(
            f"retention of {retention_hours} h is below {SAFE_RETENTION_HOURS} h; "
            "pass allow_short=True if no reader can be that old"
        )
    with writing(table):
        limit = _now() - datetime.timedelta(hours=retention_hours)
        stamps = {run: _stamp_of(run) for run in table.folder.names(OLD_DIR)}
        expired = [run for run, at in stamps.items() if at is not None and at <= limit]
        for run in expired:
            table.folder.remove(f"{OLD_DIR}/{run}")
    return len(expired)


def _listing(table: LakeTable, directories: Sequence[str] | None = None) -> DataFrame:
    """(directory, name, length) of every data file, or of those in some directories."""
    paths = [table.path]
    if directories is not None:
        paths = [_join(table.path, d) for d in directories]
    listing = (
        table.spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(paths)
    )
    directory, name = _place(table, F.col("path"))
    return listing.select(directory.alias("directory"), name.alias("name"), "length")


def _place(table: LakeTable, path: Column) -> tuple[Column, Column]:
    """Partition directory and name of a data file."""
    parts = F.split(path, "/")
    directory = F.element_at(parts, -2) if table.partition_column else F.lit("")
    return directory, F.element_at(parts, -1)


def _planned(
    table: LakeTable,
    plan: str,
    target_bytes: int,
    group_bytes: int,
    directories: Sequence[str] | None,
) -> tuple[list[Row], Compaction]:
    """Deal the small files over groups: one row per group, and the totals.

    A directory of more than a group is cut by the running sum of its files; smaller ones share a
    group by the running sum of directories, of which there is a row each. Those that become one
    file have groups of their own, with even numbers.
    """
    spark, inputs = table.spark, f"{table.path}/{plan}/{INPUTS}"
    small = _listing(table, directories).where(F.col("length") * 2 < target_bytes)
    whole = Window.partitionBy("directory")
    ordered = whole.orderBy("name")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    files = small.select(
        "*",
        F.count(F.lit(1)).over(whole).alias("files"),
        F.sum("length").over(whole).alias("bytes"),
        F.coalesce(F.sum("length").over(before), F.lit(0)).alias("before"),
        F.row_number().over(ordered).alias("place"),
    ).where("files > 1")
    large = F.col("bytes") > group_bytes
    earlier = Window.orderBy("directory").rowsBetween(Window.unboundedPreceding, -1)
    shared = F.coalesce(F.sum("bytes").over(earlier), F.lit(0))
    sharing = (
        files.where(~large & (F.col("place") == 1))
        .select("directory", F.floor(shared / group_bytes).alias("shared"))
    )
    files.join(F.broadcast(sharing), "directory", "left").select(
        "directory",
        "name",
        "length",
        F.when(large, F.col("directory")).alias("only"),
        F.when(large, F.floor(F.col("before") / group_bytes))
        .otherwise(F.col("shared") * 2 + (F.col("bytes") >= 2 * target_bytes).cast("long"))
        .alias("part"),
        F.col("bytes").alias("directory_bytes"),
    ).write.parquet(inputs)
    groups = (
        spark.read.parquet(inputs)
        .groupBy("only", "part")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("length").alias("bytes"),
            F.count_distinct("directory").alias("directories"),
            F.max("directory_bytes").alias("largest"),
            F.min("directory").alias("first"),
            F.max("directory").alias("last"),
            F.min("name").alias("first_name"),
            F.max("name").alias("last_name"),
        )
        .where("files > 1")
        .orderBy("first", "first_name")
        .collect()
    )
    partitions = sum(g["directories"] for g in groups if g["only"] is None)
    partitions += len({g["only"] for g in groups if g["only"] is not None})
    totals = Compaction(
        partitions, sum(g["files"] for g in groups), sum(g["bytes"] for g in groups)
    )
    return groups, totals


def _rewrite(
    table: LakeTable, plan: str, group: Row, cluster_column: str | None, target_file_bytes: int
) -> None:
    spark, run = table.spark, new_run()
    staging = f"{table.path}/{STAGING_DIR}/{run}"
    cluster = [cluster_column] if cluster_column else table.cluster_columns
    order = [c for c in (table.partition_column, *cluster) if c]
    if table.partition_column and group["largest"] < 2 * target_file_bytes:
        tasks, ranges = -(-group["bytes"] // TASK_BYTES), [table.partition_column]
    else:
        # Rounded down: new files reach the target, so they are not small again.
        tasks, ranges = max(1, group["bytes"] // target_file_bytes), order
    manifest = {"plan": plan, "only": group["only"], "part": group["part"], "old": new_run()}
    inputs = _inputs(table, manifest)
    with Lease(Folder(spark, staging)) as at_work:
        directories = [d for d in table.directories() if group["first"] <= d <= group["last"]]
        writer = (
            _scan_inputs(table, directories, inputs, group, target_file_bytes)
            .repartitionByRange(tasks, *ranges)
            .sortWithinPartitions(*order)
            .write.mode("append")
            .option("mapreduce.output.basename", _file_prefix(run))
        )
        if table.partition_column:
            writer = writer.partitionBy(table.partition_column)
        writer.parquet(staging)
        with writing(table):
            there = _listing(table, directories).join(inputs, ["directory", "name"], "left_semi")
            at_work.check()
            if there.count() < group["files"]:  # another run has merged some of them
                table.folder.remove(_join(STAGING_DIR, run))
                return
            table.lease.check()
            table.folder.write_new_text(_join(STAGING_DIR, run, MANIFEST), json.dumps(manifest))
            _swap(table, run)


def _inputs(table: LakeTable, manifest: dict) -> DataFrame:
    """(directory, name) of the files that a run merges, from the plan that tasks have written."""
    planned = table.spark.read.parquet(f"{table.path}/{manifest['plan']}/{INPUTS}")
    mine = F.col("only").eqNullSafe(F.lit(manifest["only"])) & (F.col("part") == manifest["part"])
    return planned.where(mine).select("directory", "name")


def _scan_inputs(
    table: LakeTable, directories: list[str], inputs: DataFrame, group: Row, target_bytes: int
) -> DataFrame:
    """The rows of the group's files.

    Size and, in a group of one directory, the range of names turn other files away before any is
    opened; the join with the manifest makes it exact, as files may have come in since.
    """
    file = F.col("_metadata")
    wanted = file.file_size * 2 < target_bytes
    if group["directories"] == 1:
        wanted &= file.file_name.between(group["first_name"], group["last_name"])
    # The path in the metadata is that of a URI.
    path = F.url_decode(F.replace(file.file_path, F.lit("+"), F.lit("%2B")))
    directory, name = _place(table, path)
    rows = table.scan_directories(directories).where(wanted)
    columns = rows.columns
    rows = rows.select("*", directory.alias("_directory"), name.alias("_name"))
    same = (rows["_directory"] == inputs["directory"]) & (rows["_name"] == inputs["name"])
    return rows.join(inputs, same, "left_semi").select(*columns)


def _swap(table: LakeTable, run: str) -> None:
    """Retire the run's input files, then move its new ones in. Can be repeated from any point.

    The manifest is there only when every new file is, and it goes last.
    """
    manifest = json.loads(table.folder.read_text(_join(STAGING_DIR, run, MANIFEST)))
    # Streamed, a directory after the other as the plan was written.
    names = _inputs(table, manifest).toLocalIterator()
    for directory, rows in itertools.groupby(names, lambda r: r["directory"]):
        for some in itertools.batched((r["name"] for r in rows), MOVES_AT_ONCE):
            table.lease.check()
            _move_files(table, directory, _join(OLD_DIR, manifest["old"], directory), some)
    for directory in table.staged(run):
        source = _join(STAGING_DIR, run, directory)
        names = [n for n in table.folder.visible(source) if n.endswith(".parquet")]
        table.lease.check()
        _move_files(table, source, directory, names)
    table.folder.remove(_join(STAGING_DIR, run))


def _move_files(table: LakeTable, source: str, target: str, names: Sequence[str]) -> None:
    """Move the files that have not moved. Two listings tell; on an object store, where a rename
    copies, a finished copy is not made again."""
    folder = table.folder
    here, there = set(folder.names(source)), set(folder.names(target))
    folder.make(target)
    for name in names:
        if name not in here:
            if name not in there:
                raise FileNotFoundError(f"{table.path}/{_join(source, name)}")
        elif name in there:
            folder.remove(_join(source, name))
        else:
            folder.move(_join(source, name), _join(target, name))


def _join(*names: str) -> str:
    return "/".join(n for n in names if n)


def _file_prefix(run: str) -> str:
    return f"{COMPACTED_PREFIX}{run}"


def _stamp_of(run: str) -> datetime.datetime | None:
    try:
        stamp = datetime.datetime.strptime(run.split("-")[0], RUN_FORMAT)
    except ValueError:
        return None
    return stamp.replace(tzinfo=datetime.UTC)


def _now() -> datetime.datetime:
    return datetime.datetime.now(datetime.UTC)
