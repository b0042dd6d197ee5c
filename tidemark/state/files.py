"""Small text files on whatever file system the path names (local, HDFS, object store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


class SharedFiles:
    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._jvm = jvm
        self._fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(
            spark.sparkContext._jsc.hadoopConfiguration()
        )

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def matches(self, glob: str) -> bool:
        return len(self._fs.globStatus(self._path(glob)) or []) > 0

    def qualified(self, path: str) -> str:
        return self._fs.makeQualified(self._path(path)).toString()

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(path))]

    def sizes(self, path: str, suffix: str = "") -> list[int]:
        """Bytes of the files of a folder whose names end so."""
        found = self._fs.listStatus(self._path(path)) if self.exists(path) else []
        return [s.getLen() for s in found if s.isFile() and s.getPath().getName().endswith(suffix)]

    def move(self, source: str, target: str) -> None:
        """Rename a file or folder, so that it arrives whole; what is there already is not replaced."""
        self._fs.mkdirs(self._path(target).getParent())
        if self.exists(target) or not self._fs.rename(self._path(source), self._path(target)):
            raise FileExistsError(target)

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish_text(self, path: str, text: str) -> None:
        """Create `path` with its whole content, or fail if it is already there. Between the check and the rename
        another writer could publish the same path: a table or export has one writer at a time."""
        draft = self._path(f"{path}.draft")
        out = self._fs.create(draft, True)
        out.write(bytearray(text, "utf-8"))
        out.close()
        if self.exists(path) or not self._fs.rename(draft, self._path(path)):
            raise FileExistsError(path)
