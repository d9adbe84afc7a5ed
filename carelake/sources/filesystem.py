"""Small files that jobs keep beside their tables, on whatever file system the tables are on."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class AlreadyThere(Exception):
    """A file that was to be new exists."""


@dataclass(frozen=True)
class Entry:
    name: str
    is_folder: bool
    length: int
    #: Milliseconds since the epoch.
    modified: int


class FileSystem:
    """The session's Hadoop file systems, called from the driver; no Spark job runs."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _path(self, path: str):
        found = self._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self._conf), found

    def entries(self, folder: str) -> list[Entry]:
        """What lies in a folder, by name; nothing if there is no such folder."""
        system, path = self._path(folder)
        if not system.exists(path):
            return []
        found = (
            Entry(s.getPath().getName(), s.isDirectory(), s.getLen(), s.getModificationTime())
            for s in system.listStatus(path)
        )
        return sorted(found, key=lambda e: e.name)

    def read(self, file: str) -> str:
        system, path = self._path(file)
        stream = system.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, file: str, text: str) -> None:
        """Write a file that must be new; others see all of it or none.

        It is written under another name and renamed, which fails if the file
        exists.  The file system's rename has to be atomic for that, as on HDFS.
        """
        folder, _, name = file.rpartition("/")
        system, hidden = self._path(f"{folder}/.{name}.{uuid.uuid4().hex}")
        stream = system.create(hidden)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        target = self._jvm.org.apache.hadoop.fs.Path(file)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(hidden.toUri(), self._conf)
        options = self._jvm.org.apache.hadoop.fs.Options.Rename
        no_overwrite = self._jvm.java.lang.reflect.Array.newInstance(options.NONE.getClass(), 0)
        try:
            context.rename(hidden, target, no_overwrite)
        except Py4JJavaError as error:
            system.delete(hidden, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise AlreadyThere(file) from error
            raise

    def delete(self, path: str) -> None:
        """Remove a file or folder; one that is not there is no error."""
        system, found = self._path(path)
        system.delete(found, True)
