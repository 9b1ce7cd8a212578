"""Distinct counts that add up: which ids occur, as bitmaps, kept per slice of the data.

Distinct counts cannot be summed, but sets can be united. ``presence`` keeps for each slice (a day, a
category) the ids that occur as bitmaps of 32,768 ids each; ``distinct_counts`` unites them
for any coarser grouping and counts bits. The result is exact, a row of the fact is read
once and never multiplied. Meant for dense whole-number ids (surrogate keys): a bitmap takes 4 KB
however few ids it holds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def presence(df: DataFrame, by: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """(by, counted, bucket, bits): ``columns`` maps a name to the id column it counts; null ids count for nothing.

    One pass: every task unites its rows before the shuffle. Several columns become rows of
    (counted, id), narrow ones, only within the task.
    """
    pairs = F.array(*[F.struct(F.lit(name).alias("counted"), F.col(c).cast("bigint").alias("id")) for name, c in columns.items()])
    ids = df.select(*by, F.inline(pairs)).where("id IS NOT NULL")
    return ids.groupBy(*by, "counted", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def distinct_counts(kept: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The distinct counts ``names`` per group of ``by``, from kept presence of finer slices."""
    united = kept.where(F.col("counted").isin(list(names))).groupBy(*by, "counted", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("ids"))
    return united.groupBy(*by).agg(*[
        F.coalesce(F.sum(F.when(F.col("counted") == n, F.col("ids"))), F.lit(0)).alias(n) for n in names])
