"""Versions of a stored table: one small file says which folders make it up.

A writer adds folders that no reader knows, then commits: the next version's
file is written aside and renamed into ``<path>/_manifests``. That one rename is
the whole change, so a reader sees the version before or the one after, whatever
a crash leaves behind; folders without a version are removed by the next writer.
A table has one writer at a time; a second one finds its version taken.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from ..session import filesystem

FOLDER = "_manifests"


class ConcurrentCommit(RuntimeError):
    pass


class Manifests:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _file(self, version: int) -> str:
        return f"{self.path}/{FOLDER}/{version:012d}.json"

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        cls, fs = filesystem(self.spark, self.path)
        found = fs.globStatus(cls(f"{self.path}/{FOLDER}/[0-9]*.json")) or []
        return sorted(int(st.getPath().getName().split(".")[0]) for st in found)

    def load(self, version: int) -> dict:
        cls, fs = filesystem(self.spark, self.path)
        stream = fs.open(cls(self._file(version)))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> tuple[int, dict | None]:
        """The newest version and what it says; (0, None) before the first."""
        versions = self.versions()
        return (versions[-1], self.load(versions[-1])) if versions else (0, None)

    def commit(self, base: int, state: dict) -> int:
        """Make ``state`` the version after ``base``."""
        cls, fs = filesystem(self.spark, self.path)
        aside, final = cls(f"{self.path}/{FOLDER}/.{uuid.uuid4().hex}"), cls(self._file(base + 1))
        out = fs.create(aside, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if fs.exists(final) or not fs.rename(aside, final):
            fs.delete(aside, False)
            raise ConcurrentCommit(f"version {base + 1} of {self.path} was committed by another writer")
        return base + 1

    def forget(self, retain: int) -> list[dict]:
        """Drop all but the newest ``retain`` + 1 versions; returns what those say."""
        cls, fs = filesystem(self.spark, self.path)
        versions = self.versions()
        for v in versions[:-1 - retain]:
            fs.delete(cls(self._file(v)), False)
        return [self.load(v) for v in versions[-1 - retain:]]


def children(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob."""
    cls, fs = filesystem(spark, pattern)
    return [st.getPath().toString() for st in fs.globStatus(cls(pattern)) or []]
