"""A commit log: numbered small files in one folder of the shared storage.

An entry becomes visible by renaming a finished file to its number, which every
supported file system does as a whole; nothing is ever overwritten.  Whoever reads
the entry of the highest number sees all of a commit or none of it."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

#: Entries that are left in the folder; readers of older ones have finished.
KEPT = 8


class Files:
    """The Hadoop file system of a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._utils = spark._jvm.org.apache.hadoop.io.IOUtils
        self._bytes = spark._jvm.java.io.ByteArrayOutputStream
        self.folder = folder.rstrip("/")
        self.fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._path(f"{self.folder}/{name}" if name else self.folder)

    def names(self, name: str = "") -> list[str]:
        at = self.path(name)
        return [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def newest(self) -> int:
        """Latest modification time of the folder's files, 0 without any."""
        at = self.path("")
        return max((s.getModificationTime() for s in self.fs.listStatus(at)), default=0) if self.fs.exists(at) else 0

    def read(self, name: str) -> str:
        source, sink = self.fs.open(self.path(name)), self._bytes()
        self._utils.copyBytes(source, sink, 4096, True)
        return sink.toString("UTF-8")

    def write(self, name: str, text: str, overwrite: bool = False) -> None:
        out = self.fs.create(self.path(name), overwrite)
        out.write(bytearray(text.encode()))
        out.close()

    def rename(self, old: str, new: str) -> bool:
        return self.fs.rename(self.path(old), self.path(new))

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


class CommitLog:
    def __init__(self, spark: SparkSession, folder: str):
        self.files = Files(spark, folder)

    def numbers(self) -> list[int]:
        return sorted(int(n) for n in self.files.names() if n.isdigit())

    def latest(self) -> tuple[int, dict]:
        """The highest committed number and its entry; (-1, {}) before any commit."""
        numbers = self.numbers()
        return (numbers[-1], json.loads(self.files.read(str(numbers[-1])))) if numbers else (-1, {})

    def add(self, number: int, entry: dict) -> None:
        draft = f".{number}-{uuid.uuid4().hex}"
        self.files.write(draft, json.dumps(entry))
        if number in self.numbers() or not self.files.rename(draft, str(number)):
            self.files.delete(draft)
            raise RuntimeError(f"commit {number} exists in {self.files.folder}")
        for old in self.numbers()[:-KEPT]:
            self.files.delete(str(old))
