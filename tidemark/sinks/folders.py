"""Names of files and folders, on any file system that the session reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folders:
    """What lies below one folder: names and notes. Rows are read and written by Spark."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root = root
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._text = spark._jvm.org.apache.commons.io.IOUtils
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        if not self.exists(name):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._at(name)))

    def bytes(self, name: str) -> int:
        return self._fs.getContentSummary(self._at(name)).getLength()

    def changed_ms(self, name: str) -> int:
        return self._fs.getFileStatus(self._at(name)).getModificationTime()

    def text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._text.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """A small file that is not there yet."""
        stream = self._fs.create(self._at(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)
