"""The few file operations that Spark's readers and writers lack, on the file system a path names.

All of them go through the JVM of a classic session and are only here; a Spark Connect client has no
such JVM and cannot load months.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Store:
    """The file system of ``path``. Meant for folders and small text files, never for data."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        context = spark.sparkContext
        self._jvm = context._jvm
        self._files = self._path(path).getFileSystem(context._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._files.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names of what is in a folder; none if there is no such folder."""
        try:
            listed = self._files.listStatus(self._path(path))
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() == "FileNotFoundException":
                return []
            raise
        return sorted(status.getPath().getName() for status in listed)

    def read(self, path: str) -> str:
        stream = self._files.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """A small file that is there as a whole or not at all."""
        folder, _, name = path.rpartition("/")
        unseen = f"{folder}/.{name}.{uuid.uuid4().hex}"
        stream = self._files.create(self._path(unseen), False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        self.rename(unseen, path)

    def rename(self, old: str, new: str) -> None:
        if not self._files.rename(self._path(old), self._path(new)):
            raise OSError(f"could not rename {old} to {new}")

    def make(self, path: str) -> None:
        self._files.mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        """Delete a file or folder, if it is there."""
        self._files.delete(self._path(path), True)
