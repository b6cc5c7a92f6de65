"""Names, renames and small text files through Hadoop's FileSystem, as Spark itself sees them."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


# Stores on which a rename copies the whole file.
COPYING_SCHEMES = ("s3a", "s3", "s3n", "gs", "oss")


class Folder:
    """A directory on any file system Spark can reach. Only metadata passes through here."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        # Looked up once: every part of a dotted name is a call to the JVM.
        jvm = spark._jvm.org.apache
        self._new_path = jvm.hadoop.fs.Path
        self._file_util = jvm.hadoop.fs.FileUtil
        self._array_utils = jvm.commons.lang3.ArrayUtils
        self._io_utils = jvm.commons.io.IOUtils
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._hadoop("").getFileSystem(conf)
        self.rename_copies = self._fs.getUri().getScheme() in COPYING_SCHEMES

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._hadoop(name))

    def names(self, name: str = "") -> list[str]:
        """Direct children in name order; none when the directory is absent."""
        if not self.exists(name):
            return []
        path = self._hadoop(name)
        paths = self._file_util.stat2Paths(self._fs.listStatus(path))
        # One string for the whole listing: asking the JVM for each entry would take seconds
        # on a table with years of dates.
        listing = self._array_utils.toString(paths)[1:-1]
        base = self._fs.makeQualified(path).toString()
        return sorted(f",{listing}".split(f",{base}/")[1:])

    def visible(self, name: str = "") -> list[str]:
        """Children that Spark's readers do not skip."""
        return [n for n in self.names(name) if not n.startswith(("_", "."))]

    def make(self, name: str = "") -> None:
        self._fs.mkdirs(self._hadoop(name))

    def move(self, source: str, target: str) -> None:
        """Rename; the caller knows that the target is free and its parent there."""
        if not self._fs.rename(self._hadoop(source), self._hadoop(target)):
            raise OSError(f"cannot move {self.path}/{source} to {target}")

    def remove(self, name: str) -> None:
        self._fs.delete(self._hadoop(name), True)

    def write_new_text(self, name: str, text: str) -> bool:
        """Put a small text file in place whole; False when the name is already taken.

        For the holder of the table's lease: the rename itself may replace a file.
        """
        if self.exists(name):
            return False
        self.replace_text(f"{name}.partial", text)
        return self._fs.rename(self._hadoop(f"{name}.partial"), self._hadoop(name))

    def create_text(self, name: str, text: str) -> bool:
        """Create a file that must not exist; False when it does. Decided by the file system."""
        try:
            stream = self._fs.create(self._hadoop(name), False)
        except Py4JJavaError:
            if self.exists(name):
                return False
            raise
        self._write(stream, text)
        return True

    def replace_text(self, name: str, text: str) -> None:
        self._write(self._fs.create(self._hadoop(name), True), text)

    def modified(self, name: str) -> float | None:
        """Seconds since 1970 of the last change; None if the file is absent."""
        try:
            return self._fs.getFileStatus(self._hadoop(name)).getModificationTime() / 1000
        except Py4JJavaError:
            return None

    def _write(self, stream, text: str) -> None:
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._hadoop(name))
        try:
            return self._io_utils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _hadoop(self, name: str):
        return self._new_path(f"{self.path}/{name}" if name else self.path)
