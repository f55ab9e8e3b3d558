"""A log of versions with compare-and-set, kept as small files in a shared folder.

Version ``n`` is the file ``n`` of the folder, in JSON.  An entry is written
under a temporary name and renamed without overwriting, through Hadoop's file
system: of two writers that started from one version exactly one gets the next
number, where the store renames atomically (HDFS and its like do).  Entries are
never changed, so whoever holds a version reads it undisturbed.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has published since this one looked."""


class CommitLog:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._jvm = spark._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _file(self, version: int) -> str:
        return f"{self.folder}/{version:012d}.json"

    def versions(self) -> list[int]:
        """All versions, ascending.  A folder with anything else in it is an error, an absent one has none."""
        if not self._fs.exists(self._path(self.folder)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder))]
        names = [n for n in names if not n.startswith((".", "_"))]
        if strange := [n for n in names if not (n.endswith(".json") and n[:-5].isdigit())]:
            raise ValueError(f"{self.folder} is no version log: it holds {strange[0]}")
        return sorted(int(n[:-5]) for n in names)

    def read(self, version: int) -> dict:
        stream = self._fs.open(self._path(self._file(version)))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def head(self) -> tuple[int, dict | None]:
        """The latest version and its entry; (0, None) before the first."""
        found = self.versions()
        return (found[-1], self.read(found[-1])) if found else (0, None)

    def commit(self, parent: int, entry: dict) -> int:
        """Publish ``entry`` as the version after ``parent``; raise :class:`Conflict` if there is one already."""
        if (self.versions() or [0])[-1] != parent:
            raise Conflict(f"{self.folder}: version {parent} is no longer the latest")
        held = f"{self.folder}/_{uuid.uuid4().hex}"
        out = self._fs.create(self._path(held), False)
        out.write(bytearray(json.dumps(entry).encode("utf-8")))
        out.close()
        target = self._path(self._file(parent + 1))
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.NONE
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            files.rename(self._path(held), target, how)
        except Py4JJavaError as exc:
            self._fs.delete(self._path(held), False)
            if "FileAlreadyExists" in exc.java_exception.getClass().getName():
                raise Conflict(f"{self.folder}: version {parent + 1} exists already") from exc
            raise
        return parent + 1

    def forget(self, version: int) -> None:
        self._fs.delete(self._path(self._file(version)), False)
