"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaymill.runtime import new_scratch_path

# Texts are handled in groups of about this many characters, so that a task's memory
# depends neither on the number of rows in an Arrow batch nor on one long text.
GROUP_CHARS = 1 << 20
BATCH_ROWS = 1000


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds


def small_batches(spark: SparkSession) -> None:
    """Texts travel to Python in Arrow batches of ``BATCH_ROWS`` rows, unless the session says otherwise.

    Spark's default of 10,000 rows is meant for numbers; with texts, batches of that size
    and their copies are most of what a Python worker holds.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once into the shared scratch folder and read it back.

    Cuts the lineage, survives lost executors, and lets the planner see real sizes.
    """
    spark: SparkSession = df.sparkSession
    path = new_scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def groups(sizes: Sequence[int] | np.ndarray, limit: int = GROUP_CHARS, rows: int = 1 << 15) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of about ``limit`` in total size; a larger row is a range of its own."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i - start >= rows or total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def text_groups(column: pa.Array, limit: int = GROUP_CHARS) -> Iterator[tuple[int, list[str | None]]]:
    """The texts of a column, some at a time, with the row at which they begin."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for i, j in groups(sizes, limit):
        yield i, column.slice(i, j - i).to_pylist()
