"""Where a job may put intermediate data, and what it may broadcast."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MADE: list[str] = []  # folders named by this process


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may go
    without, because there the driver's disk is every executor's disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="assaymill-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def new_scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def pinned(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: rows keep their partition and order on every later read."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def dealt(df: DataFrame) -> DataFrame:
    """A computed, narrow side (keys, counts) that will be joined with many uneven rows.

    An aggregate that feeds a join straight away leaves it no exchange of its own, and then
    Spark can neither split a heavy key of the other side nor swap the join for a
    broadcast once it knows the real bytes. Dealing the few columns out again gives it both
    choices at run time; nothing is computed or counted before the query runs.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


ROWS_PER_TASK = 1_000_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    """How many tasks share ``rows`` rows that each task holds in a hash table: what a task holds stays the same at any size."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // ROWS_PER_TASK + 1)


def bounded(df: DataFrame) -> DataFrame:
    """Broadcast hint for a side whose row count has a fixed bound.

    Only for: lookup literals, the few lines of a report, and at most two rows per
    shuffle partition. Other sides get no hint and Spark decides by their size.
    """
    return F.broadcast(df)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes, on leaving, every folder that ``new_scratch_path`` has named inside."""
    before = len(_MADE)
    try:
        yield
    finally:
        for path in _MADE[before:]:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        del _MADE[before:]
