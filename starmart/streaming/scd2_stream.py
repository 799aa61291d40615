"""STR1: type-2 history fed by a stream of change files.

Files landing in a folder (a CDC export or complete extracts) are read with
``readStream``; each micro-batch appends its dated states to a change log
(``foreachBatch``, one folder per batch id, so a batch Spark replays after a
failure replaces its own folder). The history is derived from the log, every
dated state becoming a version. It depends on the states alone: on neither the
number of files a trigger takes, nor the order in which they arrive. A state
that arrives late takes its place between the others.

* CDC deltas: keys absent from a batch stay as they are; a row whose
  ``is_deleted`` is true closes its key's version.
The log does not grow without end, nor is it replayed for every reader:
:meth:`ChangeLog.compact` folds it into runs of equal states (the values of each
run once, other states as dates), and :meth:`ChangeLog.history` takes the runs of
the last compaction and replays the keys only that changed after it. A late state
may fall into the middle of a run; nothing about a run's dates is lost, so the
history is the same at every compaction point. Compactions are committed by one
rename (see :mod:`..operators.manifest`).

* Complete extracts: a date counts once its extract is whole, which a marker
  says (an empty file ``<marker_dir>/<YYYY-MM-DD>``); a key missing from the next
  whole extract is closed at that date. Half-arrived extracts wait in the log.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from ..operators.history import CUSTOMER_KEY, CUSTOMER_TRACKED, replay_history, run_versions, state_runs
from ..operators.manifest import Manifests, children
from ..plans.joins import join_small
from ..session import filesystem, remove
from ..sources.contracts import CUSTOMER_FEED_SCHEMA

DELETED_COL = "is_deleted"


def complete_dates(spark: SparkSession, marker_dir: str) -> list[dt.date]:
    """Dates whose extract is whole: one marker each, so as many as extracts."""
    cls, fs = filesystem(spark, marker_dir)
    found = []
    for st in fs.globStatus(cls(f"{marker_dir.rstrip('/')}/*")) or []:
        try:
            found.append(dt.date.fromisoformat(st.getPath().getName()))
        except ValueError:
            continue
    return sorted(found)


def _ranges(pieces: list[list[int]]) -> list[list[int]]:
    """Closed ranges of batch ids, joined where they meet."""
    out: list[list[int]] = []
    for a, b in sorted(pieces):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


class ChangeLog:
    """The dated states a stream has brought, and the history they make."""

    def __init__(self, spark: SparkSession, path: str, schema: str = CUSTOMER_FEED_SCHEMA, key: str = CUSTOMER_KEY,
                 tracked=CUSTOMER_TRACKED, effective_col: str = "effective_date"):
        self.spark, self.path, self.key, self.tracked = spark, path.rstrip("/"), key, tuple(tracked)
        self.effective_col = effective_col
        self.schema = StructType.fromDDL(schema)
        if DELETED_COL not in self.schema.names:
            self.schema = self.schema.add(DELETED_COL, BooleanType())

    # -------------------------------------------------------------- the log

    def _manifest(self) -> dict:
        return Manifests(self.spark, self.path).current()[1] or {"folded": [], "trimmed": False, "folder": None, "extracts": None}

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Store one micro-batch under its id (again: the same rows). A batch that is
        folded into a compaction and replayed stays folded."""
        if any(a <= batch_id <= b for a, b in self._manifest()["folded"]):
            return
        if DELETED_COL not in batch.columns:
            batch = batch.withColumn(DELETED_COL, F.lit(False))
        rows = batch.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path}/batch={batch_id}")

    def _batches(self) -> list[int]:
        return sorted(int(f.rsplit("=", 1)[1]) for f in children(self.spark, f"{self.path}/batch=*"))

    def _logged(self, batches: list[int]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/batch={b}" for b in batches])

    def _compacted(self, folder: str) -> tuple[DataFrame, DataFrame]:
        """Runs and repeated dates of a compaction."""
        t, fields = self.effective_col, {f.name: f for f in self.schema}
        key, date = fields[self.key], fields[t]
        runs = StructType([key, date, StructField("_gone", BooleanType()), *(fields[c] for c in self.tracked),
                           StructField(f"_next_{t}", date.dataType)])
        repeats = StructType([key, date, StructField("_run", date.dataType)])
        return tuple(self.spark.read.schema(s).parquet(f"{self.path}/_compacted/{folder}/{name}")
                     for name, s in (("runs", runs), ("repeats", repeats)))

    def _unfolded(self, runs: DataFrame, repeats: DataFrame) -> DataFrame:
        """The states that runs and repeated dates stand for, as a feed."""
        t = self.effective_col
        more = repeats.join(runs.drop(f"_next_{t}").withColumnRenamed(t, "_run"), [self.key, "_run"]).drop("_run")
        every = runs.drop(f"_next_{t}").unionByName(more)
        return every.withColumnRenamed("_gone", DELETED_COL)

    def states(self) -> DataFrame:
        """Every state of the log; those of removed batches without what is not tracked."""
        state = self._manifest()
        logged = self._logged(self._batches())
        if not state["trimmed"]:
            return logged
        folded = [b for b in self._batches() if any(a <= b <= z for a, z in state["folded"])]
        rest = self._logged([b for b in self._batches() if b not in folded])
        return rest.unionByName(self._unfolded(*self._compacted(state["folder"])), allowMissingColumns=True).select(*self.schema.names)

    # ------------------------------------------------------------ the history

    def history(self, extracts: list[dt.date] | None = None) -> DataFrame:
        """Versions of all states (CDC), or of the complete extracts of the given
        dates: then a key that the next extract lacks is deleted at its date."""
        since = self._since(extracts)
        if since is None:
            states = self.states() if extracts is None else self._with_deletions(self.states(), sorted(extracts))
            return replay_history(states, self.key, self.tracked, self.effective_col, DELETED_COL)
        runs, _, feed = self._split(*since)
        replayed = replay_history(feed, self.key, self.tracked, self.effective_col, DELETED_COL)
        return run_versions(runs, self.key, self.tracked, self.effective_col).unionByName(replayed)

    def _since(self, extracts: list[dt.date] | None) -> tuple[str, DataFrame] | None:
        """The last compaction's folder and the states after it; None where the
        compaction is of no use (none, of the other kind, or an extract that it
        counted as whole was added to, left out or put between)."""
        state = self._manifest()
        if state["folder"] is None or (extracts is None) != (state["extracts"] is None):
            return None
        new = [b for b in self._batches() if not any(a <= b <= z for a, z in state["folded"])]
        if extracts is None:
            return state["folder"], self._logged(new)
        dates, done = sorted(extracts), [dt.date.fromisoformat(d) for d in state["extracts"]]
        t = self.effective_col
        if not done or dates[:len(done)] != done or self._logged(new).filter(F.col(t).isin(done)).limit(1).count():
            return None
        later = dates[len(done) - 1:]
        return state["folder"], self._with_deletions(self.states().filter(F.col(t) >= later[0]), later).filter(F.col(t) > later[0])

    def _split(self, folder: str, tail: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Runs and repeats of the keys that the tail leaves alone, and the whole feed
        of those it touches."""
        runs, repeats = self._compacted(folder)
        touched = tail.select(self.key).filter(F.col(self.key).isNotNull()).distinct()
        mine = [join_small(x, touched, self.key, "left_semi") for x in (runs, repeats)]
        others = [join_small(x, touched, self.key, "left_anti") for x in (runs, repeats)]
        feed = self._unfolded(*mine)
        return others[0], others[1], feed.unionByName(tail.select(*feed.columns))

    def compact(self, extracts: list[dt.date] | None = None, trim: bool = False) -> None:
        """Fold the log into runs; what was folded before and is not touched is
        copied. ``trim`` also removes the folded batches (not with extracts, whose
        halves must wait in the log)."""
        if trim and extracts is not None:
            raise ValueError("batches of extracts stay in the log")
        manifests = Manifests(self.spark, self.path)
        number, batches, since = manifests.current()[0], self._batches(), self._since(extracts)
        state, folder = self._manifest(), uuid.uuid4().hex
        if since is None:
            others = []
            feed = self.states() if extracts is None else self._with_deletions(self.states(), sorted(extracts))
        else:
            *others, feed = self._split(*since)
        folded = state_runs(feed, self.key, self.tracked, self.effective_col, DELETED_COL)
        for name, new, old in zip(("runs", "repeats"), folded, others or (None, None)):
            (new if old is None else new.unionByName(old)).write.parquet(f"{self.path}/_compacted/{folder}/{name}")
        ranges = state["folded"] if extracts is None or state["trimmed"] else []
        manifests.commit(number, {"folder": folder, "folded": _ranges([*ranges, *([b, b] for b in batches)]), "trimmed": trim or state["trimmed"],
                                  "extracts": None if extracts is None else [d.isoformat() for d in sorted(extracts)]})
        kept = {s["folder"] for s in manifests.forget(0)}
        for f in children(self.spark, f"{self.path}/_compacted/*"):
            if f.rsplit("/", 1)[1] not in kept:
                remove(self.spark, f)
        if trim:
            for b in batches:
                remove(self.spark, f"{self.path}/batch={b}")

    def _with_deletions(self, states: DataFrame, dates: list[dt.date]) -> DataFrame:
        t, key = self.effective_col, self.key
        states = states.filter(F.col(t).isin(dates)) if dates else states.limit(0)
        states = states.filter(F.col(key).isNotNull())
        following = F.create_map(*[F.lit(x) for pair in zip(dates, dates[1:]) for x in pair]) if len(dates) > 1 else None
        if following is None:
            return states
        here = states.select(key, t).distinct()
        expected = here.select(key, F.try_element_at(following, F.col(t)).alias(t)).filter(F.col(t).isNotNull())
        missing = expected.join(here, [key, t], "left_anti")
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema if f.name not in (key, t, DELETED_COL)]
        gone = missing.select(key, t, *empty, F.lit(True).alias(DELETED_COL))
        return states.unionByName(gone)


def stream_scd2(spark: SparkSession, feed_dir: str, state_path: str, checkpoint_location: str,
                fmt: str = "csv", schema: str = CUSTOMER_FEED_SCHEMA, available_now: bool = True,
                max_files: int = 1000, key: str = CUSTOMER_KEY, tracked=CUSTOMER_TRACKED,
                compact_every: int | None = None) -> StreamingQuery:
    """Start the stream into the change log at ``state_path``. ``max_files`` only
    bounds the work of a trigger. ``schema`` may have a boolean ``is_deleted``.
    ``compact_every`` batches of a CDC feed, the log is compacted and trimmed. A log
    belongs to one checkpoint, which numbers its batches."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        reader = reader.option("header", True)
    source = reader.format(fmt).load(feed_dir)
    log = ChangeLog(spark, state_path, schema, key, tracked)

    def bring(df: DataFrame, batch_id: int) -> None:
        log.append(df, batch_id)
        if compact_every and (batch_id + 1) % compact_every == 0:
            log.compact(trim=True)

    writer = (source.writeStream.option("checkpointLocation", checkpoint_location)
              .foreachBatch(bring))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
