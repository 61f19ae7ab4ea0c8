"""Small files and folders through Hadoop's file systems, on the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """Names, texts and deletion under any path that Spark itself can read."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str) -> tuple:
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self._conf)

    def names(self, path: str) -> list[str]:
        """What a folder holds; nothing if there is none."""
        place, files = self._at(path)
        if not files.exists(place):
            return []
        return sorted(status.getPath().getName() for status in files.listStatus(place))

    def read(self, path: str) -> str:
        place, files = self._at(path)
        stream = files.open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """Write a file that must not be there yet."""
        place, files = self._at(path)
        stream = files.create(place, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        place, files = self._at(path)
        files.delete(place, True)

    def delete_at_exit(self, path: str) -> None:
        place, files = self._at(path)
        files.deleteOnExit(place)

    def raw_path(self, path: str) -> str:
        """The path without its scheme, as it appears in file URIs."""
        place, files = self._at(path)
        return files.makeQualified(place).toUri().getRawPath()
