"""Run context and session helpers.

Every model that reads "today" or stamps "now" takes a :class:`RunContext`
instead of calling ``current_date()`` / ``current_timestamp()``, so a run is
reproducible: the same inputs and the same context give the same tables.
"""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed clock used by tests, the query catalogue and the oracle SQL.
PINNED_AS_OF = dt.date(2001, 12, 1)
PINNED_RUN_TS = dt.datetime(2001, 12, 1, 0, 0, 0)


@dataclass(frozen=True)
class RunContext:
    """``as_of_date`` replaces current_date(); ``run_ts`` replaces current_timestamp()."""

    as_of_date: dt.date
    run_ts: dt.datetime

    @classmethod
    def pinned(cls) -> "RunContext":
        return cls(PINNED_AS_OF, PINNED_RUN_TS)

    @classmethod
    def now(cls) -> "RunContext":
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
        return cls(now.date(), now)

    def today(self) -> Column:
        return F.lit(self.as_of_date)

    def stamp(self) -> Column:
        # Parsed in the session time zone, like a SQL TIMESTAMP literal.
        return F.to_timestamp(F.lit(self.run_ts.strftime("%Y-%m-%d %H:%M:%S")))


def build_session(
    master: str | None = None,
    app_name: str = "tidemark",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the pipeline is designed for.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` for the
    data (AQE coalesces small partitions and splits skewed ones at run time).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        # Broadcast only what the planner (or AQE, from real shuffle sizes)
        # measures below this bound; everything else is a sort-merge join.
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for materialized tables and lineage cuts.

    Taken from the session's ``spark.checkpoint.dir`` (on a cluster it names a
    shared file system). Only a local-mode session without one -- a bare test
    session -- gets a folder of its own; on a cluster a machine-local folder
    would not survive the loss of that machine, so it is an error instead.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on a shared file system")
        path = tempfile.mkdtemp(prefix="tidemark-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique location under the shared folder, removed when the application ends."""
    path = "/".join([shared_dir(spark).rstrip("/"), "tidemark", *parts, uuid.uuid4().hex])
    sc = spark.sparkContext
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path
