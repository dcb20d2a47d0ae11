"""The few file-system calls that tables need."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The file system that holds ``root``, through Spark's Hadoop client."""

    def __init__(self, spark: SparkSession, root: str):
        self._new_path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._new_path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._new_path(path))

    def children(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(self._new_path(path))]

    def delete(self, path: str) -> None:
        self._fs.delete(self._new_path(path), True)

    def size(self, path: str) -> int:
        """Bytes of all files below ``path``."""
        if not self.exists(path):
            return 0
        return self._fs.getContentSummary(self._new_path(path)).getLength()

    def write_text(self, path: str, text: str) -> None:
        """A small file that is there as a whole or not at all."""
        parent, _, name = path.rpartition("/")
        partial = self._new_path(f"{parent}/.{name}.part")
        stream = self._fs.create(partial, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self._fs.delete(self._new_path(path), False)
        self._fs.rename(partial, self._new_path(path))
