"""A Parquet table kept under one path: create, scan, widen, append.

Layout::

    <path>/eventDate=2024-01-31/part-*.parquet   data, read by any Spark reader
    <path>/_schema/000001.json                   the table's columns, newest file wins
    <path>/_staging/<run>/                       files of a write that is not in place yet
    <path>/_old/<run>/                           files that a compaction has replaced
    <path>/_lease/<epoch>.json                   the writer at work, or the last one
    <path>/_touched/                             directories written to since upkeep

Spark readers skip names that start with an underscore. A table has one writer at a time, the one
that holds its lease (``eventlake.plans.upkeep.writing``).

Files are written to a staging directory and moved in after the lease has been checked: a writer
that was stalled during its Spark job and has lost the table puts nothing in place. Where a rename
copies (object stores) the job writes in place, and the lease is checked right before it.
"""

from __future__ import annotations

import datetime
import json
import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.sources.folder import Folder
from eventlake.sources.journal import TouchedDirectories
from eventlake.sources.lease import Lease

SCHEMA_DIR = "_schema"
STAGING_DIR = "_staging"
# The run of an append carries the epoch of its writer, which no other writer has.
APPEND_RUN = "append"
RUN_FORMAT = "%Y%m%dT%H%M%S%fZ"
# The directory name Spark gives to rows whose partition value is null.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
ROWS_PER_FILE = 500_000
# Text of the rows of a task, where they are long.
TEXT_BYTES_PER_FILE = 128 * 1024 * 1024
DATES_PER_TASK = 8


class SchemaConflict(ValueError):
    """A source column has another type than the table's column of that name."""


class LakeTable:
    """Handle on a table; holds no data and no cached state but its lease while writing."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        partition_column: str | None = None,
        cluster_columns: Sequence[str] = (),
        rows_per_file: int = ROWS_PER_FILE,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_column = partition_column
        self.cluster_columns = list(cluster_columns)
        self.rows_per_file = rows_per_file
        self.folder = Folder(spark, self.path)
        self.lease = Lease(self.folder)
        self.touched = TouchedDirectories(self.folder)

    # -- schema ---------------------------------------------------------------------------

    def exists(self) -> bool:
        return bool(self._schema_versions())

    def schema(self) -> T.StructType:
        versions = self._schema_versions()
        if not versions:
            raise FileNotFoundError(f"no table at {self.path}")
        return T.StructType.fromJson(json.loads(self.folder.read_text(versions[-1])))

    def ensure(self, schema: T.StructType) -> LakeTable:
        """Create the table if it is absent; an existing table is left as it is."""
        if not self.exists():
            with self.lease:
                if not self.exists():
                    self.folder.make(SCHEMA_DIR)
                    self._publish(schema, 1)
        return self

    def widen(self, source: T.StructType) -> T.StructType:
        """Add the source's new columns to the table and return the table's schema.

        Names match without regard to case, as in Spark. A narrower number is stored in the
        table's wider type; any other difference of type is a conflict. The schema file is written
        before data with the new columns, so a reader never meets a column it does not know.
        """
        current = self.schema()
        known = {f.name.lower(): f for f in current.fields}
        added = []
        for f in source.fields:
            old = known.get(f.name.lower())
            if old is None:
                added.append(T.StructField(f.name, _nullable(f.dataType), True))
            elif not _fits(_nullable(f.dataType), _nullable(old.dataType)):
                raise SchemaConflict(
                    f"column {f.name} is {old.dataType.simpleString()} in the table "
                    f"but {f.dataType.simpleString()} in the source"
                )
        if not added:
            return current
        widened = T.StructType([*current.fields, *added])
        with self.lease:
            self._publish(widened, len(self._schema_versions()) + 1)
        return widened

    def _schema_versions(self) -> list[str]:
        names = self.folder.visible(SCHEMA_DIR)
        return [f"{SCHEMA_DIR}/{n}" for n in names if n.endswith(".json")]

    def _publish(self, schema: T.StructType, version: int) -> None:
        self.lease.check()
        nullable = _nullable(schema)
        name = f"{SCHEMA_DIR}/{version:06d}.json"
        if not self.folder.write_new_text(name, json.dumps(nullable.jsonValue())):
            raise FileExistsError(f"another writer has just changed {self.path}")

    # -- reading --------------------------------------------------------------------------

    def scan(self) -> DataFrame:
        """The whole table, columns in table order.

        The schema is given, so no file footer is opened to find it; files written before a
        column was added read as null there, and an empty table reads as no rows.
        """
        return self._read([self.path])

    def scan_window(self, low: str, high: str, with_null: bool) -> DataFrame | None:
        """The rows whose partition value is in [low, high], or null if ``with_null``.

        Only the directories in the window are listed, so the cost of a match does not grow with
        the table's history. None when the table has no such directory.
        """
        names = self._window_directories(low, high, with_null)
        return self.scan_directories(names) if names else None

    def scan_directories(self, names: Sequence[str]) -> DataFrame:
        """The rows of the named partition directories."""
        return self._read([f"{self.path}/{name}".rstrip("/") for name in names])

    def scan_files(self, names: Sequence[str]) -> DataFrame:
        """The rows of the named data files."""
        return self._read([f"{self.path}/{name}" for name in names])

    def directories(self) -> list[str]:
        """The partition directories; the table itself, as an empty name, if unpartitioned."""
        if not self.partition_column:
            return [""]
        return [n for n in self.folder.names() if n.startswith(f"{self.partition_column}=")]

    def _window_directories(self, low: str, high: str, with_null: bool) -> list[str]:
        chosen = []
        for name in self.directories():
            value = name.removeprefix(f"{self.partition_column}=")
            if value == NULL_PARTITION:
                if with_null:
                    chosen.append(name)
            elif _date_key(low) <= _date_key(value) <= _date_key(high):
                chosen.append(name)
        return chosen

    def _read(self, paths: list[str]) -> DataFrame:
        schema = self.schema()
        reader = self.spark.read.schema(schema).option("basePath", self.path)
        return reader.parquet(*paths).select(*schema.fieldNames())

    # -- writing --------------------------------------------------------------------------

    def append(self, rows: DataFrame, count: int, dates: int = 1, text_bytes: int = 0) -> None:
        """Append ``count`` rows that lie in ``dates`` partitions and hold ``text_bytes`` of text.

        Rows are range-partitioned by (partition column, cluster columns): a task gets about
        ``rows_per_file`` rows, fewer if they are long, so a date that holds most of the batch is split over many tasks,
        while small dates share one, and every file covers a narrow range of the cluster key.
        """
        with self.lease:
            self.lease.check()
            schema = self.schema()
            aligned = rows.select(*_aligned(rows, schema))
            order = [c for c in (self.partition_column, *self.cluster_columns) if c]
            if order:
                tasks = max(
                    math.ceil(count / self.rows_per_file),
                    math.ceil(dates / DATES_PER_TASK),
                    math.ceil(text_bytes / TEXT_BYTES_PER_FILE),
                    1,
                )
                aligned = aligned.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
            writer = aligned.write
            if self.partition_column:
                writer = writer.partitionBy(self.partition_column)
            if self.folder.rename_copies:
                self.touched.add(self._directories_of(rows))
                self.lease.check()
                writer.mode("append").parquet(self.path)
                return
            run = f"{new_run()}-{APPEND_RUN}-{self.lease.epoch}"
            writer.parquet(f"{self.path}/{STAGING_DIR}/{run}")
            staged = self.staged(run)
            self.touched.add(staged)
            self.lease.check()
            self._move_in(run, staged)

    def staged(self, run: str) -> list[str]:
        """The partition directories a run has files for; the empty name if unpartitioned."""
        if not self.partition_column:
            return [""]
        names = self.folder.names(f"{STAGING_DIR}/{run}")
        return [n for n in names if n.startswith(f"{self.partition_column}=")]

    def _move_in(self, run: str, directories: Sequence[str]) -> None:
        staging = f"{STAGING_DIR}/{run}"
        for directory in directories:
            if directory and not self.folder.exists(directory):
                self.folder.move(f"{staging}/{directory}", directory)
                continue
            source = f"{staging}/{directory}".rstrip("/")
            for name in self.folder.visible(source):
                self.folder.move(f"{source}/{name}", f"{directory}/{name}".lstrip("/"))
        self.folder.remove(staging)

    def _directories_of(self, rows: DataFrame) -> list[str]:
        if not self.partition_column:
            return [""]
        value = F.coalesce(F.col(self.partition_column).cast("string"), F.lit(NULL_PARTITION))
        name = F.concat(F.lit(f"{self.partition_column}="), value)
        return [r["name"] for r in rows.select(name.alias("name")).distinct().collect()]


def new_run() -> str:
    """A name for a staging directory; sorts by time."""
    return f"{datetime.datetime.now(datetime.UTC).strftime(RUN_FORMAT)}-{uuid.uuid4().hex[:8]}"


def _aligned(rows: DataFrame, schema: T.StructType) -> list[Column]:
    """The table's columns in order; a column the rows lack is null."""
    present = {c.lower(): c for c in rows.columns}
    return [
        (F.col(present[f.name.lower()]) if f.name.lower() in present else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in schema.fields
    ]


# Number types and the wider ones that hold each of their values exactly.
_WIDER = {
    T.ByteType(): (T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()),
    T.ShortType(): (T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()),
    T.IntegerType(): (T.LongType(), T.DoubleType()),
    T.FloatType(): (T.DoubleType(),),
}


def _fits(source: T.DataType, table: T.DataType) -> bool:
    return source == table or table in _WIDER.get(source, ())


def _nullable(data_type: T.DataType) -> T.DataType:
    """The type with every nested field nullable, as Parquet files read back."""
    if isinstance(data_type, T.StructType):
        return T.StructType(
            [T.StructField(f.name, _nullable(f.dataType), True) for f in data_type.fields]
        )
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(_nullable(data_type.elementType), True)
    if isinstance(data_type, T.MapType):
        return T.MapType(_nullable(data_type.keyType), _nullable(data_type.valueType), True)
    return data_type


def _date_key(text: str) -> tuple[int, int, int]:
    """Order dates written as text, including years beyond 9999 and below 0."""
    sign = -1 if text.startswith("-") else 1
    year, month, day = text.lstrip("+-").split("-")
    return sign * int(year), int(month), int(day)
