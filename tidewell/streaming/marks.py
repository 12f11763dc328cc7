"""Small durable records of a feed on Spark's own file system: each is one file that appears whole, by rename, or not at all."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Marks:
    """Records by name in a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        jvm = spark._jvm
        self._path, self.folder = jvm.org.apache.hadoop.fs.Path, folder.rstrip("/")
        self._root = self._path(self.folder)
        self._files = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str) -> object:
        return self._path(f"{self.folder}/{name}")

    def names(self) -> list[str]:
        if not self._files.exists(self._root):
            return []
        return sorted(n for s in self._files.listStatus(self._root) if not (n := s.getPath().getName()).startswith("."))

    def read(self, name: str) -> dict:
        at = self._at(name)
        f = self._files.open(at)
        try:
            data = bytearray(self._files.getFileStatus(at).getLen())
            return json.loads(bytes(f.readAllBytes()) if len(data) else b"{}")
        finally:
            f.close()

    def add(self, name: str, record: dict) -> bool:
        """The record appears under name; False if there is one already."""
        to = self._at(name)
        if self._files.exists(to):
            return False
        draft = self._at(f".{uuid.uuid4().hex}")
        f = self._files.create(draft, True)
        f.write(bytearray(json.dumps(record).encode()))
        f.close()
        if self._files.rename(draft, to):
            return True
        self._files.delete(draft, False)
        return False

    def remove(self, name: str) -> None:
        self._files.delete(self._at(name), True)
