"""What sources and sinks share: defaults, and the few file-system calls that Spark has no function for."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULT_FORMAT = "parquet"
TARGET_FILE_BYTES = 256 * 1024 * 1024


class Files:
    """Sizes, moves and deletions on the file system of a path, whichever Spark uses for it."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def name(self, path: str) -> str:
        """The full name of a path, always spelled the same way."""
        return self._fs.makeQualified(self._path(path)).toString()

    def bytes(self, path: str) -> int:
        return int(self._fs.getContentSummary(self._path(path)).getLength())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def move(self, source: str, target: str) -> None:
        parent = self._path(target).getParent()
        made = self._fs.exists(parent) or self._fs.mkdirs(parent)
        if not made or not self._fs.rename(self._path(source), self._path(target)):
            raise RuntimeError(f"could not move {source} to {target}")

    def delete(self, path: str) -> None:
        if self.exists(path):
            self._fs.delete(self._path(path), True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes under ``path`` on whatever file system Spark uses for it."""
    return Files(spark, path).bytes(path)
