"""Tables and arrays in the shared folder, and small helpers that the operators have in common."""

from __future__ import annotations

import contextlib
import functools
import io
import os
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bounds of one Arrow batch: Python sees about this much of a text table at a time.
ARROW_ROWS, ARROW_BYTES = 20_000, "4m"
# Largest table that is broadcast, by the measured size of its rows.
BROADCAST_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Session settings the operators count on, and this package for the Python workers."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        context.addPyFile(_zipped_package(scratch(spark, "package")))
        _shipped.add(context.applicationId)


def _zipped_package(folder: str) -> str:
    """The library as a zip file in the shared folder, for ``addPyFile``."""
    top = Path(__file__).resolve().parents[1]
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for file in sorted(top.rglob("*.py")):
            archive.write(file, file.relative_to(top.parent))
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/{top.name}.zip") as out:
        out.write(buffer.getbuffer())
    return f"{folder}/{top.name}.zip"


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, as in tests, the warehouse directory takes its place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written as Parquet to the shared folder and read back: a cut in the lineage."""
    spark = frame.sparkSession
    path = scratch(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def measured_bytes(frame: DataFrame) -> int:
    """About the bytes of all rows, by a pass over them. The frame should be a stored one."""
    row = F.length(F.to_json(F.struct("*"))) + 64
    return frame.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


def broadcast_if_small(frame: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The frame, marked for broadcast if it measures up to ``limit`` bytes.

    Beyond that Spark's own choice of join holds.
    """
    return F.broadcast(frame) if measured_bytes(frame) <= limit else frame


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; null stays null.

    ``lower`` does the same on texts of ASCII alone and is many times faster.
    """
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def file_system(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    if not urlparse(uri).scheme:
        return arrow_fs.LocalFileSystem(), uri
    return arrow_fs.FileSystem.from_uri(uri)


def save_array(folder: str, name: str, array: np.ndarray) -> None:
    """Write one array under ``folder``; a repeated task attempt replaces it by the same bytes."""
    buffer = io.BytesIO()
    np.save(buffer, array)
    with appended(folder, f"{name}.npy") as out:
        out.write(buffer.getbuffer())


@contextlib.contextmanager
def appended(folder: str, name: str) -> Iterator[pa.NativeFile]:
    """A file under ``folder`` to write piece by piece; it is there once the block has ended well."""
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    draft = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        yield out
    system.move(draft, f"{path}/{name}")


@functools.lru_cache(maxsize=8192)
def load_bytes(folder: str, name: str) -> np.ndarray:
    """Memory-map the bytes of a file where the shared folder is mounted; else read them."""
    system, path = file_system(folder)
    file = f"{path}/{name}"
    if isinstance(system, arrow_fs.LocalFileSystem):
        return np.asarray(np.memmap(file, dtype=np.uint8, mode="r"))
    with system.open_input_stream(file) as source:
        return np.frombuffer(source.read(), dtype=np.uint8)


@functools.lru_cache(maxsize=4096)
def load_array(folder: str, name: str) -> np.ndarray:
    """Memory-map an array where the shared folder is mounted; else read it."""
    system, path = file_system(folder)
    file = f"{path}/{name}.npy"
    if isinstance(system, arrow_fs.LocalFileSystem):
        if os.path.getsize(file) > 128:
            try:
                return np.load(file, mmap_mode="r")
            except ValueError:  # an array of no elements cannot be mapped
                pass
        return np.load(file)
    with system.open_input_stream(file) as source:
        return np.load(io.BytesIO(source.read()))
