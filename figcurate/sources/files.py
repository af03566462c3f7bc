"""Small control files and listings on whatever file system a path names (local, HDFS, object stores), through Hadoop's API.

Only control files (snapshots, tokens) and listings pass through the driver; data files are read and written by executors.
"""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import SparkSession


def on_any_files(place: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address and the path in it, for work in Python tasks, which have no access to Hadoop's API."""
    return fs.FileSystem.from_uri(place) if ":/" in place else (fs.LocalFileSystem(), place)


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self._fs = self._path("").getFileSystem(self._conf)
        self._fs.setVerifyChecksum(False)  # control files are replaced by renames

    def _path(self, relative: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{relative}" if relative else self.root)

    def path(self, relative: str) -> str:
        return f"{self.root}/{relative}"

    def exists(self, relative: str) -> bool:
        return self._fs.exists(self._path(relative))

    def names(self, folder: str) -> list[str]:
        """Names of the files of a folder, in order; none if there is no such folder."""
        if not self.exists(folder):
            return []
        found = (s.getPath().getName() for s in self._fs.listStatus(self._path(folder)))
        return sorted(n for n in found if not n.startswith("."))

    def walk(self, folder: str, suffix: str) -> dict[str, int]:
        """Relative paths below a folder that end with ``suffix``, with their sizes."""
        if not self.exists(folder):
            return {}
        base = self._fs.getFileStatus(self._path("")).getPath().toUri().getPath().rstrip("/") + "/"
        found, out = self._fs.listFiles(self._path(folder), True), {}
        while found.hasNext():
            status = found.next()
            name = status.getPath().toUri().getPath()
            if name.endswith(suffix):
                out[name.removeprefix(base)] = status.getLen()
        return out

    def read(self, relative: str) -> str:
        stream = self._fs.open(self._path(relative))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def create(self, relative: str, text: str) -> bool:
        """Write a file that must not exist yet; False if it does, in which case nothing changes."""
        if self.exists(relative):
            return False
        try:
            stream = self._fs.create(self._path(relative), False)
        except Exception as e:
            if self.exists(relative):
                return False
            raise OSError(str(e)) from e
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        return True

    def replace(self, relative: str, text: str) -> None:
        stream = self._fs.create(self._path(relative), True)
        stream.write(bytearray(text, "utf-8"))
        stream.close()

    def delete(self, relative: str, recursive: bool = False) -> None:
        self._fs.delete(self._path(relative), recursive)
