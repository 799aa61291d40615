"""Type-2 history (SCD1-SCD5, PRJ16, FIL2-3, J9).

* :func:`apply_scd2` - the check-strategy snapshot: compare the tracked columns
  of each key's open version with the current-state feed; changed -> close the
  open version at the run time and open a new one; new key -> open; key gone
  from the feed -> close (hard delete); unchanged -> nothing. One full outer
  join of *open* versions with the feed on the key (both sides at most one row
  per key, so no fan-out and no hot key); closed versions pass through.
* :class:`Scd2Table` - the same on storage, laid out so a run never rewrites
  closed history, with a run ledger: a run commits as a whole or not at all, and
  none may precede the newest one.
* :func:`customer_history` - the history view (valid_to_or_max, is_current).
* :func:`as_of` / :func:`as_of_join` - point-in-time lookup, half-open
  ``[valid_from, valid_to)``; the join is an equi-join on the key with the
  range as a residual predicate.
* :func:`as_of_merge` - the same by sorting facts and versions of a key together.
* :func:`replay_history` - history from a dated change feed (several rows per
  key with an effective date), with no-op changes dropped.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import open_end_ts, surrogate_key
from ..functions.ordered import ordered_neighbors, pick_first, running_max
from ..plans.joins import join_small
from ..session import remove
from .manifest import Manifests, children

# The tracked attributes of the customer snapshot.
CUSTOMER_KEY = "customer_key"
CUSTOMER_TRACKED = ("customer_name", "market_segment", "account_balance", "phone", "address", "nation_key")
#: Rows of one key up to which a window over the key is plain.
MAX_PLAIN_ROWS = 10_000
META = ("version_key", "updated_at", "valid_from", "valid_to")


def _ts(run_ts: dt.datetime | str) -> Column:
    return F.lit(str(run_ts)).cast("timestamp_ntz")


def version_key(key: str, valid_from: Column) -> Column:
    """SCD3: per-version key = md5 of the natural key and the version start."""
    return surrogate_key(F.col(key), valid_from.cast("string"))


def _changed(a: str, b: str, cols: Sequence[str]) -> Column:
    """Null-safe difference of any tracked column between prefixes a and b."""
    return reduce(lambda x, y: x | y, [~F.col(f"{a}{c}").eqNullSafe(F.col(f"{b}{c}")) for c in cols])


def open_versions(feed: DataFrame, key: str, tracked: Sequence[str], run_ts) -> DataFrame:
    """First run (empty state): every feed row opens a version."""
    ts = _ts(run_ts)
    return feed.select(key, *tracked, version_key(key, ts).alias("version_key"), ts.alias("updated_at"),
                       ts.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"))


def apply_scd2(state: DataFrame | None, feed: DataFrame, run_ts: dt.datetime | str,
               key: str = CUSTOMER_KEY, tracked: Sequence[str] = CUSTOMER_TRACKED,
               close_missing: bool = True) -> DataFrame:
    """SCD1 + SCD2 + SCD3: the full new state after one snapshot run.

    ``feed`` must hold one row per key (current state). ``run_ts`` is a
    parameter so reruns are deterministic; rerunning with an unchanged feed
    yields the same state.
    """
    feed = feed.select(key, *tracked)
    if state is None:
        return open_versions(feed, key, tracked, run_ts)
    cols = [key, *tracked, *META]
    state = state.select(*cols)
    closed = state.filter(F.col("valid_to").isNotNull())
    current = state.filter(F.col("valid_to").isNull())
    ts = _ts(run_ts)
    o = current.select(*[F.col(c).alias(f"o_{c}") for c in cols])
    f = feed.select(*[F.col(c).alias(f"f_{c}") for c in (key, *tracked)])
    j = o.join(f, F.col(f"o_{key}") == F.col(f"f_{key}"), "full")
    has_o, has_f = F.col(f"o_{key}").isNotNull(), F.col(f"f_{key}").isNotNull()
    changed = has_o & has_f & _changed("o_", "f_", tracked)
    close_now = changed | (has_o & ~has_f & F.lit(close_missing))
    old_row = F.when(has_o, F.struct(
        *[F.col(f"o_{c}").alias(c) for c in (key, *tracked, "version_key", "updated_at", "valid_from")],
        F.when(close_now, ts).otherwise(F.col("o_valid_to")).alias("valid_to")))
    new_row = F.when(has_f & (~has_o | changed), F.struct(
        *[F.col(f"f_{c}").alias(c) for c in (key, *tracked)],
        version_key(f"f_{key}", ts).alias("version_key"), ts.alias("updated_at"), ts.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to")))
    applied = (j.select(F.explode(F.filter(F.array(old_row, new_row), lambda x: x.isNotNull())).alias("v"))
               .select("v.*"))
    return closed.unionByName(applied)


def customer_history(state: DataFrame, key: str = CUSTOMER_KEY,
                     tracked: Sequence[str] = CUSTOMER_TRACKED) -> DataFrame:
    """SCD4 / PRJ16: history dimension over the snapshot state."""
    order = ("customer_name", "market_segment", "account_balance", "phone", "address", "nation_key")
    attrs = [c for c in order if c in tracked] + [c for c in tracked if c not in order]
    return state.select(
        F.col("version_key").alias("customer_history_key"), key, *attrs,
        "valid_from", "valid_to",
        F.coalesce(F.col("valid_to"), open_end_ts()).alias("valid_to_or_max"),
        F.coalesce(F.col("valid_to").isNull(), F.lit(False)).alias("is_current"),
    )


def current(history: DataFrame) -> DataFrame:
    """FIL2."""
    return history.filter(F.col("is_current"))


def as_of(history: DataFrame, when: dt.date | dt.datetime | str) -> DataFrame:
    """FIL3: versions valid at ``when`` (valid_from <= when < valid_to_or_max)."""
    t = F.lit(str(when)).cast("timestamp_ntz")
    return history.filter((t >= F.col("valid_from")) & (t < F.col("valid_to_or_max")))


def as_of_join(facts: DataFrame, history: DataFrame, key: str = CUSTOMER_KEY, date_col: str = "order_date",
               columns: Sequence[str] | None = None, how: str = "left", bucket: str | None = None) -> DataFrame:
    """J9: attach the version of ``key`` valid at each fact's ``date_col``.

    Plans as a sort-merge (or size-checked broadcast) equi-join on ``key`` with
    the half-open range as residual condition: each fact row meets only the
    few versions of its own key. A hot key is split by AQE's skew handling.

    ``bucket`` ("year", "month", ...) adds the range-join bucketing for keys with
    many versions: each version is listed once per time bucket it overlaps
    (open versions up to the facts' newest date, one scalar), the join becomes
    equi on (key, bucket), and a fact row meets only the versions overlapping
    its own bucket.
    """
    cols = list(columns) if columns is not None else [c for c in history.columns if c != key]
    h = history.select(F.col(key).alias("_h_key"), "valid_from", "valid_to_or_max",
                       *[F.col(c).alias(f"_h_{c}") for c in cols if c not in ("valid_from", "valid_to_or_max")])
    t = F.col(date_col).cast("timestamp_ntz")
    cond = (F.col(key) == F.col("_h_key")) & (t >= F.col("valid_from")) & (t < F.col("valid_to_or_max"))
    if bucket is not None:
        horizon = facts.agg(F.max(t)).first()[0]
        if horizon is not None:
            h = h.filter(F.col("valid_from") < F.col("valid_to_or_max"))  # a version of no length covers no date
            last = F.least(F.col("valid_to_or_max") - F.expr("INTERVAL 1 MICROSECOND"),
                           F.lit(horizon).cast("timestamp_ntz"))
            first = F.date_trunc(bucket, F.col("valid_from")).cast("timestamp_ntz")
            span = F.sequence(first, F.date_trunc(bucket, last).cast("timestamp_ntz"),
                              F.expr(f"INTERVAL 1 {bucket.upper()}"))
            h = (h.filter(F.col("valid_from") <= F.lit(horizon).cast("timestamp_ntz"))
                 .withColumn("_h_bucket", F.explode(span)))
            facts_b = facts.withColumn("_f_bucket", F.date_trunc(bucket, t).cast("timestamp_ntz"))
            joined = facts_b.join(h, cond & (F.col("_f_bucket") == F.col("_h_bucket")), how)
            out = [F.col(c) for c in facts.columns]
            for c in cols:
                out.append(F.col(c) if c in ("valid_from", "valid_to_or_max") else F.col(f"_h_{c}").alias(c))
            return joined.select(*out)
    joined = facts.join(h, cond, how)
    out = [F.col(c) for c in facts.columns]
    for c in cols:
        out.append(F.col(c) if c in ("valid_from", "valid_to_or_max") else F.col(f"_h_{c}").alias(c))
    return joined.select(*out)


def as_of_merge(facts: DataFrame, history: DataFrame, key: str = CUSTOMER_KEY, date_col: str = "order_date",
                columns: Sequence[str] | None = None, how: str = "left", rows_per_task: int = 1_000_000) -> DataFrame:
    """J9 by a merge in place of a range condition: facts and versions of a key are
    sorted by time together, and a fact takes the last version before it if that is
    still valid then. A key's work is its facts plus its versions, not their product.
    Same result as :func:`as_of_join` where the versions of a key do not overlap
    (which a stored history guarantees).

    A key with more than ``rows_per_task`` facts is dealt over as many salts as that
    takes, by a hash of the whole row (a task that runs again deals alike; rows equal
    in every column stay together), and its versions are copied to each. The table of such keys has at most
    facts / ``rows_per_task`` rows and is broadcast if that is proven small.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"a merge is a left or an inner join, not {how!r}")
    cols = list(columns) if columns is not None else [c for c in history.columns if c != key]
    t = F.col(date_col).cast("timestamp_ntz")
    placed = F.col(key).isNotNull() & t.isNotNull()
    hot = facts.filter(placed).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_per_task) \
        .select(F.col(key).alias("_hot"), F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_salts"))
    n_hot = hot.count()
    one = F.coalesce(F.col("_salts"), F.lit(1))

    def salted(df: DataFrame) -> DataFrame:
        return join_small(df, hot, F.col(key) == F.col("_hot"), "left", rows=n_hot) if n_hot else df.withColumn("_salts", F.lit(1))

    version = F.struct(F.col("valid_to_or_max").alias("_until"), *[F.col(c).alias(f"_v_{c}") for c in cols])
    versions = salted(history.filter(F.col(key).isNotNull() & (F.col("valid_from") < F.col("valid_to_or_max")))).select(
        key, F.explode(F.sequence(F.lit(0), one - 1)).alias("_salt"), F.col("valid_from").alias("_t"), version.alias("_version"))
    rows = salted(facts.filter(placed)).select(
        *facts.columns, F.when(one > 1, F.pmod(F.xxhash64(*facts.columns), one)).otherwise(0).cast("int").alias("_salt"),
        t.alias("_t"), F.lit(True).alias("_fact"))
    both = rows.unionByName(versions, allowMissingColumns=True)
    # at one time the version goes first: it is valid from then on
    upto = Window.partitionBy(key, "_salt").orderBy("_t", F.col("_fact").asc_nulls_first()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("_last", F.last("_version", ignorenulls=True).over(upto)).filter("_fact")
    valid = F.col("_t") < F.col("_last._until")
    out = found.select(*[F.col(c) for c in facts.columns],
                       *[F.when(valid, F.col(f"_last._v_{c}")).alias(c) for c in cols], F.coalesce(valid, F.lit(False)).alias("_valid"))
    if how == "inner":
        return out.filter("_valid").drop("_valid")
    types = dict(history.dtypes)
    rest = facts.filter(~placed).select("*", *[F.lit(None).cast(types[c]).alias(c) for c in cols])
    return out.drop("_valid").unionByName(rest)


def replay_history(feed: DataFrame, key: str = CUSTOMER_KEY, tracked: Sequence[str] = CUSTOMER_TRACKED,
                   effective_col: str = "effective_date", deleted_col: str | None = None,
                   max_plain: int = MAX_PLAIN_ROWS) -> DataFrame:
    """SCD5: type-2 history from a dated change feed.

    Rows equal to the key's previous row (null-safe on every tracked column)
    are no-op changes and dropped; each remaining row is valid from its
    effective date to the next one's (open for the last). Several rows of one
    key and date are resolved to one, deterministically. With ``deleted_col``, a
    row where it is true ends the key's version and starts none (a state wins
    over a deletion of the same date). Rows without a key or date have no place in
    a history and are dropped.

    The rows per key are counted first. If none has more than ``max_plain``, lag
    and lead are plain windows on one partitioning; else they run in the two-level
    bucketed form, which spreads a key with a very long history over many tasks
    (see :mod:`starmart.functions.ordered`). Both give the same history.
    """
    states, plain = dated_states(feed, key, tracked, effective_col, deleted_col, max_plain)
    kept = states.filter("_starts").drop("_starts")
    return run_versions(_with_next(kept, key, effective_col, plain), key, tracked, effective_col)


def dated_states(feed: DataFrame, key: str, tracked: Sequence[str], effective_col: str, deleted_col: str | None,
                 max_plain: int = MAX_PLAIN_ROWS) -> tuple[DataFrame, bool]:
    """One state per key and date (key, date, ``_gone``, tracked; a deletion has no
    values), with ``_starts``: whether it differs from the key's state before. And
    whether no key has more than ``max_plain`` rows."""
    gone = F.coalesce(F.col(deleted_col), F.lit(False)) if deleted_col else F.lit(False)
    one = feed.filter(F.col(key).isNotNull() & F.col(effective_col).isNotNull()).select(
        key, effective_col, gone.alias("_gone"), *[F.when(~gone, F.col(c)).alias(c) for c in tracked])
    one = pick_first(one, [key, effective_col], [F.col("_gone")])
    compared = ("_gone", *tracked)
    longest = feed.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    plain = longest <= max_plain
    if plain:
        by = Window.partitionBy(key).orderBy(effective_col)
        prev = one.select("*", *[F.lag(c).over(by).alias(f"_prev_{c}") for c in compared], F.row_number().over(by).alias("_rn"))
    else:
        prev = ordered_neighbors(one, key, effective_col, lag_cols=compared, row_number=True)
    starts = (F.col("_rn") == 1) | _changed("", "_prev_", compared)
    return prev.select(key, effective_col, *compared, starts.alias("_starts")), plain


def _with_next(starts: DataFrame, key: str, effective_col: str, plain: bool) -> DataFrame:
    """Add ``_next_<date>``: when the key's next state begins."""
    if plain:
        by = Window.partitionBy(key).orderBy(effective_col)
        return starts.withColumn(f"_next_{effective_col}", F.lead(effective_col).over(by))
    return ordered_neighbors(starts, key, effective_col, lead_t=True)


def state_runs(feed: DataFrame, key: str, tracked: Sequence[str], effective_col: str, deleted_col: str | None,
               max_plain: int = MAX_PLAIN_ROWS) -> tuple[DataFrame, DataFrame]:
    """A feed without loss, each state's values once: runs of equal states (key, date
    of the first, ``_gone``, tracked, ``_next_<date>``), and the dates of the other
    states of each run (key, date, ``_run``: the run's first date)."""
    states, plain = dated_states(feed, key, tracked, effective_col, deleted_col, max_plain)
    runs = _with_next(states.filter("_starts").drop("_starts"), key, effective_col, plain)
    marked = states.select(key, effective_col, "_starts", F.when(F.col("_starts"), F.col(effective_col)).alias("_run"))
    if plain:
        by = Window.partitionBy(key).orderBy(effective_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        marked = marked.withColumn("_max__run", F.max("_run").over(by))
    else:
        marked = running_max(marked, key, effective_col, "_run")
    return runs, marked.filter("NOT _starts").select(key, effective_col, F.col("_max__run").alias("_run"))


def run_versions(runs: DataFrame, key: str, tracked: Sequence[str], effective_col: str) -> DataFrame:
    """The history that runs of states make: a version each, but for deletions."""
    start = F.col(effective_col).cast("timestamp_ntz")
    versions = runs.filter(~F.col("_gone")).select(
        key, *tracked, start.alias("valid_from"), F.col(f"_next_{effective_col}").cast("timestamp_ntz").alias("valid_to"),
        version_key(key, start).alias("version_key"))
    return customer_history(versions, key, tracked)


# ---------------------------------------------------------------------------
# Stored state
# ---------------------------------------------------------------------------

class Scd2Table:
    """SCD2 state on storage (SNK4): versions closed by run ``r`` lie in the folder
    ``_state=closed-r`` for good, open ones in ``_state=open-r`` until the next run.

    A manifest (see :mod:`.manifest`) names the folders and keeps the run ledger:
    the runs applied and the high-water mark, which no later run may precede. A
    run writes both folders beside those of the last one, checks what it wrote and
    commits with one rename; before it the table is as it was, after it the run is
    applied. The mark covers closed versions too: a key closed by a run cannot be
    opened again at a time before that run.
    """

    STATE_COL = "_state"

    def __init__(self, spark: SparkSession, path: str, key: str = CUSTOMER_KEY,
                 tracked: Sequence[str] = CUSTOMER_TRACKED):
        self.spark, self.path, self.key, self.tracked = spark, path.rstrip("/"), key, tuple(tracked)

    def _ledger(self) -> tuple[int, dict | None]:
        """The newest version. A table from before there were manifests is taken
        over: its folders, its run markers, and the newest time in it."""
        number, state = Manifests(self.spark, self.path).current()
        if state is not None:
            return number, state
        folders = [f.rsplit("=", 1)[1] for f in children(self.spark, f"{self.path}/{self.STATE_COL}=*")]
        runs = [f.rsplit("=", 1)[1] for f in children(self.spark, f"{self.path}/_runs/run=*")]
        if not runs:
            return 0, None
        opened = [f for f in folders if f == "open"]
        state = {"open": opened[0] if opened else None, "closed": [f for f in folders if f.startswith("closed-")], "runs": runs, "mark": None}
        rows = self._read([*opened, *state["closed"]])
        if rows is not None:
            state["mark"] = rows.agg(F.max(F.greatest("valid_from", "valid_to")).cast("string")).first()[0]
        return 0, state

    def _read(self, folders: Sequence[str]) -> DataFrame | None:
        if not folders:
            return None
        paths = [f"{self.path}/{self.STATE_COL}={f}" for f in folders]
        return self.spark.read.option("mergeSchema", "false").parquet(*paths)

    def exists(self) -> bool:
        state = self._ledger()[1]
        return state is not None and bool(state["closed"] or state["open"])

    def read(self) -> DataFrame | None:
        state = self._ledger()[1] or {"closed": [], "open": None}
        return self._read([*state["closed"], *filter(None, [state["open"]])])

    def read_open(self) -> DataFrame | None:
        """The open versions (no closed one is read); None before the first run."""
        state = self._ledger()[1]
        if state is None:
            return None
        if state["open"] is not None:
            return self._read([state["open"]])
        return self._read(state["closed"][:1]).limit(0) if state["closed"] else None

    def has_run(self, run_id: str | int) -> bool:
        state = self._ledger()[1]
        return state is not None and str(run_id) in state["runs"]

    def _refuse(self, result: DataFrame, state: dict | None, run_ts, allow_empty: bool) -> None:
        """Checks on the written result, before it is committed: one pass for the
        sums and one for repeated keys."""
        key, is_open = F.col(self.key), F.col("valid_to").isNull()
        sums = result.agg(F.count_if(key.isNull()).alias("no_key"), F.count_if(is_open).alias("open"),
                          F.count_if(F.col("valid_to") <= F.col("valid_from")).alias("backward"),
                          F.first(_ts(run_ts) < _ts((state or {}).get("mark") or run_ts)).alias("older")).first()
        if sums["no_key"]:
            raise ValueError(f"feed holds {sums['no_key']} row(s) without {self.key}")
        dup = (result.filter(is_open).groupBy(self.key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect())
        if dup:
            raise ValueError(f"feed holds several rows for {self.key} = {dup[0][self.key]!r}; "
                             "dedupe it (e.g. newest per key) before the snapshot run")
        if state is None:
            return
        if sums["backward"] or sums["older"]:
            raise ValueError(f"run {run_ts} is not after the newest run or version ({state['mark']}); replay a dated feed instead")
        if not sums["open"] and state["open"] is not None and not allow_empty:
            raise ValueError("the feed would close every version; pass allow_empty=True if it is meant to be empty")

    def apply(self, feed: DataFrame, run_ts, run_id: str | int, close_missing: bool = True,
              allow_empty: bool = False) -> bool:
        """Apply one snapshot run; returns False (and does nothing) if ``run_id``
        was already applied. Refused, with the table untouched: a feed with a
        repeated or null key, a run before the newest one (or before any version's
        beginning or end), and a feed that closes everything unless ``allow_empty``."""
        number, state = self._ledger()
        if state is not None and str(run_id) in state["runs"]:
            return False
        if state is not None and state["mark"] is not None and \
                self.spark.range(1).select(_ts(run_ts) < _ts(state["mark"])).first()[0]:
            raise ValueError(f"run {run_ts} is not after the newest run or version ({state['mark']}); replay a dated feed instead")
        opened = self.read_open()
        result = apply_scd2(opened, feed, run_ts, self.key, self.tracked, close_missing)
        names = {kind: f"{kind}-{run_id}" for kind in ("open", "closed")}
        folder = F.when(F.col("valid_to").isNull(), F.lit(names["open"])).otherwise(F.lit(names["closed"]))
        paths = {kind: f"{self.path}/{self.STATE_COL}={name}" for kind, name in names.items()}
        for p in paths.values():  # of a run that broke off
            remove(self.spark, p)
        try:
            result.withColumn(self.STATE_COL, folder).write.mode("append").partitionBy(self.STATE_COL).parquet(self.path)
            found = {kind: children(self.spark, f"{p}/*.parquet") for kind, p in paths.items()}
            written = self._read([names[kind] for kind in names if found[kind]])
            self._refuse(written if written is not None else result.limit(0), state, run_ts, allow_empty)
        except BaseException:
            for p in paths.values():
                remove(self.spark, p)
            raise
        before = state or {"open": None, "closed": [], "runs": []}
        Manifests(self.spark, self.path).commit(number, {
            "open": names["open"] if found["open"] else None,
            "closed": [*before["closed"], *([names["closed"]] if found["closed"] else [])],
            "runs": [*before["runs"], str(run_id)], "mark": str(run_ts)})
        self._clean()
        return True

    def _clean(self) -> None:
        """Remove the last run's open versions and folders that no run committed."""
        kept = Manifests(self.spark, self.path).forget(0)
        live = {f for s in kept for f in (*s["closed"], s["open"])}
        for f in children(self.spark, f"{self.path}/{self.STATE_COL}=*"):
            if f.rsplit("=", 1)[1] not in live:
                remove(self.spark, f)
