"""Small driver-side file operations on the file system that holds a table (HDFS, an object store or a local folder)."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """A folder, reached through Hadoop's file system API as Spark's own readers and writers do."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self.path = path.rstrip("/")
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def names(self) -> list[str]:
        """What the folder holds, in order; nothing if there is no such folder."""
        if not self._fs.exists(self._root):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._root))

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def write(self, name: str, text: str) -> None:
        """Write a small text file: first beside its place, then renamed into it, so that no reader sees half of it."""
        part = self._at(f"{name}.part")
        out = self._fs.create(part, True)
        out.write(bytearray(text.encode()))
        out.close()
        self._fs.delete(self._at(name), False)
        self._fs.rename(part, self._at(name))

    def read(self, name: str) -> str | None:
        """A small text file, or None where there is none."""
        if not self.exists(name):
            return None
        data = self._fs.open(self._at(name))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(data)).decode()
        finally:
            data.close()
