"""Subscription history (SCD type 2, "check" strategy) and point-in-time reads.

A new version of a subscription opens only when one of the checked columns
changes (NULL-safe compare); the open version is then closed at the batch's
timestamp. Keys missing from a batch stay open (no hard deletes). Columns
that are stored but not checked (end date, trial flag, billing frequency,
start date, stamp) keep the values of the row that opened the version.

Each merge is one full outer join of the batch with the *open* versions on
the unique key; closed versions pass through untouched. On storage
(:class:`HistoryStore`) closed versions are appended once and never
rewritten, only the open set is rewritten per batch, and states are tracked
in an append-only log, so a history is never read and overwritten in place.

:func:`merge_batch` takes batches in the order of their times. The store takes
them in any order: a late one is inserted into the chains of the keys it
changes (:func:`rebuild`), with the result of all batches in order.
"""

from __future__ import annotations

import datetime as dt
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType, TimestampType

from tidemark.sources.schemas import BRONZE_SCHEMAS, STAMP

KEY = "subscription_id"

# The columns whose change opens a new version.
CHECK_COLUMNS = [
    "plan_tier", "mrr_amount", "arr_amount", "seats",
    "churn_flag", "upgrade_flag", "downgrade_flag", "auto_renew_flag",
]

SNAPSHOT_COLUMNS = [
    "subscription_id", "account_id", "start_date", "end_date", "plan_tier", "seats",
    "mrr_amount", "arr_amount", "is_trial", "upgrade_flag", "downgrade_flag", "churn_flag",
    "billing_frequency", "auto_renew_flag", STAMP,
]
VERSION_COLUMNS = ["valid_from", "valid_to", "version_id"]
HISTORY_COLUMNS = SNAPSHOT_COLUMNS + VERSION_COLUMNS


def _ts(value: dt.datetime | str) -> Column:
    text = value.strftime("%Y-%m-%d %H:%M:%S") if isinstance(value, dt.datetime) else value
    return F.to_timestamp(F.lit(text))


def version_id(key: Column, valid_from: Column) -> Column:
    return F.sha2(F.concat_ws("|", key, valid_from.cast("string")), 256)


def open_versions(batch: DataFrame, batch_ts: dt.datetime | str) -> DataFrame:
    """Every batch row with a key as a newly opened version (as in a merge, rows without one are left out)."""
    vf = _ts(batch_ts)
    return batch.filter(F.col(KEY).isNotNull()).select(*SNAPSHOT_COLUMNS).select(
        *SNAPSHOT_COLUMNS,
        vf.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        version_id(F.col(KEY), vf).alias("version_id"),
    )


def _same_checked(left: str, right: str) -> Column:
    """NULL-safe equality of the checked columns, named by two prefixes."""
    same = F.lit(True)
    for c in CHECK_COLUMNS:
        same = same & F.col(f"{left}{c}").eqNullSafe(F.col(f"{right}{c}"))
    return same


def rebuild(delivered: DataFrame) -> DataFrame:
    """The history of ``delivered`` rows (SNAPSHOT_COLUMNS, ``batch_ts``, ``seq``), whatever the order they came in.

    Per key the rows are sorted by time; a row that equals the one before it in
    all checked columns opens no version, and a version ends where the next
    begins. Of rows with one key and time the one applied first counts. A
    key has at most one row a batch, so its window is bounded by the batches.
    """
    rows = delivered.filter(F.col(KEY).isNotNull()).groupBy(KEY, "batch_ts").agg(
        F.min_by(F.struct(*SNAPSHOT_COLUMNS), "seq").alias("now"))
    by_time = Window.partitionBy(KEY).orderBy("batch_ts")
    marked = rows.withColumn("before", F.lag("now").over(by_time))
    opened = marked.filter(F.col("before").isNull() | ~_same_checked("before.", "now."))
    return opened.select(
        "now.*", F.col("batch_ts").alias("valid_from"), F.lead("batch_ts").over(by_time).alias("valid_to"),
        version_id(F.col(KEY), F.col("batch_ts")).alias("version_id")).select(*HISTORY_COLUMNS)


def merge_batch(history: DataFrame, batch: DataFrame, batch_ts: dt.datetime | str) -> DataFrame:
    """Apply one batch, newer than all before it, to a history; returns the new history (lazy)."""
    ts = _ts(batch_ts)
    closed = history.filter(F.col("valid_to").isNotNull())
    current = history.filter(F.col("valid_to").isNull())

    h = current.select(*[F.col(c).alias(f"h_{c}") for c in HISTORY_COLUMNS])
    b = batch.select(*[F.col(c).alias(f"b_{c}") for c in SNAPSHOT_COLUMNS])
    j = h.join(b, F.col(f"h_{KEY}") == F.col(f"b_{KEY}"), "full_outer")

    has_h, has_b = F.col(f"h_{KEY}").isNotNull(), F.col(f"b_{KEY}").isNotNull()
    changed = has_h & has_b & ~_same_checked("h_", "b_")
    opens = (has_b & ~has_h) | changed

    kept = F.struct(
        *[F.col(f"h_{c}").alias(c) for c in SNAPSHOT_COLUMNS],
        F.col("h_valid_from").alias("valid_from"),
        F.when(changed, ts).otherwise(F.col("h_valid_to")).alias("valid_to"),
        F.col("h_version_id").alias("version_id"),
    )
    opened = F.struct(
        *[F.col(f"b_{c}").alias(c) for c in SNAPSHOT_COLUMNS],
        ts.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        version_id(F.col(f"b_{KEY}"), ts).alias("version_id"),
    )
    rows = F.array_compact(F.array(F.when(has_h, kept), F.when(opens, opened)))
    merged = j.select(F.explode(rows).alias("v")).select("v.*")
    return closed.select(*HISTORY_COLUMNS).unionByName(merged)


def as_of(history: DataFrame, ts: dt.datetime | str) -> DataFrame:
    """The version of every key that was valid at ``ts``."""
    t = _ts(ts)
    return history.filter(
        (F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t))
    )


def _schemas() -> dict[str, StructType]:
    known = {f.name: f for f in BRONZE_SCHEMAS["subscriptions"].fields} | {STAMP: StructField(STAMP, TimestampType())}
    snapshot = [StructField(c, known[c].dataType) for c in SNAPSHOT_COLUMNS]
    merge = StructField("merge", StringType())
    return {
        "data": StructType([*snapshot, StructField("valid_from", TimestampType()), StructField("valid_to", TimestampType()),
                            StructField("version_id", StringType()), merge, StructField("_open", BooleanType())]),
        "delivered": StructType([*snapshot, StructField("batch_ts", TimestampType()), merge]),
        "replaced": StructType([StructField(KEY, known[KEY].dataType), merge]),
    }


SCHEMAS = _schemas()


class LogEntry(NamedTuple):
    seq: int
    merge: str
    batch_ts: str
    late: bool


class HistoryStore:
    """A history kept under ``root`` so that each batch in time costs O(open versions + batch).

    Layout, all append-only and partitioned by ``merge`` (one id per applied batch):

    * ``root/data`` -- ``_open=false`` holds the versions that the merge
      closed, the history's bulk; ``_open=true`` every version still open
      after that merge. A partition is written once and never rewritten.
    * ``root/delivered`` -- the batch's own rows with its time.
    * ``root/replaced`` -- of a late batch, the keys whose chains it rebuilt.
    * ``root/log`` -- one small file per merge, named by its sequence number.

    The history is the closed part of all merges plus the open part of the
    newest one; partition pruning reads only those files. A merge joins the
    batch with the current open versions only (one full outer join on the
    key) and appends its result.

    A late batch (its time is not after all others') is compared with the
    versions that cover its time. Keys that agree with theirs keep their
    chains. The chains of all others are rebuilt from the delivered rows of
    these keys, written with the merge, and older closed versions of such
    keys are left out on read. So batches in any order give the history of
    the batches in order; a late batch costs a scan of the delivered rows and
    of the history. Of two deliveries with one time, the one applied first
    counts for a key that both have.

    A merge counts from the moment its log file is there: the file is written
    under another name and renamed to the next free number, which fails if
    that number is taken. Of two writers that read the same state one fails
    instead of losing the other's batch, and a writer that dies leaves
    nothing but partitions that are never read (:meth:`remove_orphans`).
    A log that cannot be read is an error, never an empty history.

    A batch must have one row per key and no NULL key: anything else is refused
    before a row is written.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def _log(self) -> str:
        return f"{self.root}/log"

    def _data(self) -> str:
        return f"{self.root}/data"

    def _file(self, path: str):
        """(file system, path) of the session's Hadoop configuration."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def entries(self) -> list[LogEntry]:
        """The applied batches in the order they were applied: one line each, metadata only."""
        fs, log = self._file(self._log())
        if not fs.exists(log):
            return []
        if odd := [f.getPath().getName() for f in fs.listStatus(log) if f.isDirectory()]:
            raise ValueError(f"not a log file: {odd}")
        lines = [r["value"].split("|") for r in self.spark.read.text(self._log()).collect()]
        return sorted(LogEntry(int(seq), merge, ts, late == "late") for seq, merge, ts, late in lines)

    def state(self) -> tuple[int, list[str]] | None:
        """(sequence, merge ids oldest first) of the latest state, or None when no merge was logged yet."""
        log = self.entries()
        return (log[-1].seq, [e.merge for e in log]) if log else None

    def _next_number(self) -> int:
        """One more than the largest number that any log file has, also one without content."""
        fs, log = self._file(self._log())
        names = [f.getPath().getName() for f in fs.listStatus(log)] if fs.exists(log) else []
        return max((int(n) for n in names if n.isdigit()), default=0) + 1

    def _claim(self, seq: int, merge: str, batch_ts: str = "", late: bool = False) -> None:
        """Log ``merge`` as number ``seq``; fails if that number is taken."""
        jvm = self.spark._jvm
        fs, draft = self._file(f"{self.root}/draft/{merge}")
        _, path = self._file(f"{self._log()}/{seq:09d}")
        out = fs.create(draft, True)
        out.write(bytearray(f"{seq}|{merge}|{batch_ts}|{'late' if late else 'in time'}\n".encode()))
        out.close()
        fs.mkdirs(path.getParent())
        no_overwrite = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        uri = fs.makeQualified(draft).toUri()
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, self.spark._jsc.hadoopConfiguration()).rename(
            fs.makeQualified(draft), fs.makeQualified(path), no_overwrite)

    def _check(self, batch: DataFrame) -> None:
        bad = (batch.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
               .filter(F.col(KEY).isNull() | (F.col("n") > 1)).limit(5).collect())
        if bad:
            raise ValueError(f"a batch needs one row per {KEY} and no NULL: {[(r[KEY], r['n']) for r in bad]}")

    def _append(self, df: DataFrame, part: str, merge: str, *by: str) -> None:
        df.withColumn("merge", F.lit(merge)).write.format(self.fmt).mode("append").partitionBy("merge", *by).save(f"{self.root}/{part}")

    def _part(self, part: str, merges: list[str]) -> DataFrame:
        # The schema is given: a table of empty batches has no file to take it from.
        return self.spark.read.format(self.fmt).schema(SCHEMAS[part]).load(f"{self.root}/{part}").filter(F.col("merge").isin(merges))

    def _numbers(self, log: list[LogEntry]) -> DataFrame:
        # Broadcast: shuffled by merge, each batch as a whole would be one task's.
        return F.broadcast(self.spark.createDataFrame([(e.merge, e.seq) for e in log], "merge string, seq long"))

    def _closed(self, log: list[LogEntry]) -> DataFrame:
        """Closed versions, without those of keys that a later late batch rebuilt."""
        closed = self._part("data", [e.merge for e in log]).filter(~F.col("_open")).select(*HISTORY_COLUMNS, "merge")
        if late := [e for e in log if e.late]:
            numbers = self._numbers(log)
            newest = (self._part("replaced", [e.merge for e in late]).join(numbers, "merge")
                      .groupBy(KEY).agg(F.max("seq").alias("rebuilt")))
            closed = (closed.join(numbers, "merge").join(newest, KEY, "left")
                      .filter(F.col("rebuilt").isNull() | (F.col("seq") >= F.col("rebuilt"))))
        return closed.select(*HISTORY_COLUMNS)

    def _current(self, log: list[LogEntry]) -> DataFrame:
        return self._part("data", [log[-1].merge]).filter(F.col("_open")).select(*HISTORY_COLUMNS)

    def _read(self, log: list[LogEntry]) -> DataFrame:
        return self._closed(log).unionByName(self._current(log))

    def read(self) -> DataFrame | None:
        log = self.entries()
        return self._read(log) if log else None

    def _insert(self, log: list[LogEntry], batch: DataFrame, batch_ts: str, merge: str) -> DataFrame:
        """Chains of the keys that a late batch changes, and the other keys' open versions."""
        ts = _ts(batch_ts)
        covering = self._read(log).filter((F.col("valid_from") <= ts) & (F.col("valid_to").isNull() | (F.col("valid_to") > ts)))
        covering = covering.select(F.col(KEY), *[F.col(c).alias(f"h_{c}") for c in CHECK_COLUMNS], F.lit(True).alias("covered"))
        agrees = F.col("covered").isNotNull() & _same_checked("", "h_")
        self._append(batch.join(covering, KEY, "left").filter(~agrees).select(KEY), "replaced", merge)
        keys = self._part("replaced", [merge]).select(KEY)
        numbers = self._numbers([*log, LogEntry(log[-1].seq + 1, merge, batch_ts, True)])
        delivered = self._part("delivered", [e.merge for e in log] + [merge]).join(keys, KEY, "left_semi").join(numbers, "merge")
        return rebuild(delivered).unionByName(self._current(log).join(keys, KEY, "left_anti"))

    def apply(self, batch: DataFrame, batch_ts: dt.datetime | str) -> DataFrame:
        """Apply one batch, late or not, and return the new history."""
        self._check(batch)
        stamp = batch_ts.strftime("%Y-%m-%d %H:%M:%S") if isinstance(batch_ts, dt.datetime) else batch_ts
        log, seq = self.entries(), self._next_number()
        merge = "m" + uuid.uuid4().hex  # never parsed as a number by partition discovery
        self._append(batch.select(*SNAPSHOT_COLUMNS, _ts(stamp).alias("batch_ts")), "delivered", merge)
        batch = self._part("delivered", [merge]).select(*SNAPSHOT_COLUMNS)
        late = any(e.batch_ts >= stamp for e in log)
        if not log:
            merged = open_versions(batch, stamp)
        elif late:
            merged = self._insert(log, batch, stamp, merge)
        else:
            merged = merge_batch(self._current(log), batch, stamp)
        self._append(merged.withColumn("_open", F.col("valid_to").isNull()), "data", merge, "_open")
        self._claim(seq, merge, stamp, late)
        return self.read()

    def remove_orphans(self) -> list[str]:
        """Remove what writers that died have left; call it while no batch is being applied. Returns the removed paths."""
        known, removed = {f"merge={e.merge}" for e in self.entries()}, []
        for part in ("data", "delivered", "replaced", "draft"):
            fs, path = self._file(f"{self.root}/{part}")
            for f in fs.listStatus(path) if fs.exists(path) else []:
                name = f.getPath().getName()
                if part == "draft" or name.startswith("merge=") and name not in known:
                    fs.delete(f.getPath(), True)
                    removed.append(f"{part}/{name}")
        return removed
