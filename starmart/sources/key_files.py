"""Which files of a Parquet source hold given keys (J3 without reading every line).

The index has one row per distinct (key, file). It follows the source: files
that are new, or whose size or time changed, are read once (the key column
only), and rows of files that are gone or changed no longer count. With keys
that have nothing to do with dates, minima and maxima of files prune nothing;
files that arrived together still hold few of the wanted keys.

Versions of the index are committed like those of a table (one rename).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.manifest import Manifests, children
from ..plans.joins import join_small
from ..session import remove

_SEEN = "path string, size long, changed timestamp"


class KeyFiles:
    """Index of ``key`` over the Parquet files at ``source``, kept at ``path``."""

    def __init__(self, spark: SparkSession, source: str, path: str, key: str):
        self.spark, self.source, self.path, self.key = spark, source, path.rstrip("/"), key
        self.schema = spark.read.parquet(source).schema

    def _listed(self) -> DataFrame:
        """The source's files as they are now (a listing; no file is opened)."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(self.source)
        return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
                            F.col("_metadata.file_modification_time").alias("changed"))

    def _table(self, kind: str, commits: list[str], schema: str) -> DataFrame:
        base = f"{self.path}/{kind}"
        return self.spark.read.schema(f"{schema}, commit string").option("basePath", base).parquet(*[f"{base}/commit={c}" for c in commits])

    def _live(self, commits: list[str]) -> DataFrame:
        """(path, commit): indexed files that are still what was indexed."""
        return self._table("seen", commits, _SEEN).join(self._listed(), ["path", "size", "changed"]).select("path", "commit")

    def files(self) -> int:
        return self._listed().count()

    def refresh(self) -> int:
        """Index the files that are not; returns how many these were. Once half of
        the indexed files have gone, the index is built anew."""
        manifests = Manifests(self.spark, self.path)
        base, state = manifests.current()
        commits = state["commits"] if state else []
        fresh = self._listed()
        if commits:
            known = self._table("seen", commits, _SEEN)
            if 2 * self._live(commits).count() < known.count():
                commits = []
            else:
                fresh = fresh.join(known, ["path", "size", "changed"], "left_anti")
        if not fresh.limit(1).count():
            return 0
        commit = uuid.uuid4().hex
        fresh.write.parquet(f"{self.path}/seen/commit={commit}")
        paths = [r.path for r in self._table("seen", [commit], _SEEN).select("path").collect()]  # a row per new file
        rows = self.spark.read.schema(self.schema).parquet(*paths).select(F.col(self.key).alias("key"), F.col("_metadata.file_path").alias("path"))
        rows.filter("key IS NOT NULL").distinct().write.parquet(f"{self.path}/keys/commit={commit}")
        manifests.commit(base, {"commits": [*commits, commit]})
        live = {c for s in manifests.forget(0) for c in s["commits"]}
        for f in children(self.spark, f"{self.path}/[sk]*/commit=*"):
            if f.rsplit("=", 1)[1] not in live:
                remove(self.spark, f)
        return len(paths)

    def holding(self, keys: DataFrame, rows: int | None = None) -> list[str]:
        """Files with a row whose key is in the one column of ``keys`` (``rows``: how
        many there are, if counted), and files that are not indexed yet."""
        listed, (_, state) = self._listed().select("path"), Manifests(self.spark, self.path).current()
        if state is not None:
            live = self._live(state["commits"])
            index = self._table("keys", state["commits"], f"key {self.schema[self.key].dataType.simpleString()}, path string")
            hits = join_small(index, keys.toDF("key").distinct(), "key", "left_semi", rows=rows).select("path", "commit").distinct()
            listed = hits.join(live, ["path", "commit"], "left_semi").select("path") \
                .unionByName(listed.join(live, "path", "left_anti"))
        return sorted(r.path for r in listed.distinct().collect())  # metadata: at most a row per file

    def read(self, keys: DataFrame, rows: int | None = None) -> DataFrame:
        """The rows of the files that hold ``keys`` (rows with other keys among them)."""
        paths = self.holding(keys, rows)
        reader = self.spark.read.schema(self.schema)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)
