"""Series of days, months and numbers.

The bounds are columns of a frame, usually a one-row aggregate, so a spine can
follow the data without its bounds passing through the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaymill.functions import dates


def day_series(bounds: DataFrame, start: Column, end: Column, name: str = "date") -> DataFrame:
    return bounds.select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias(name))


def month_series(bounds: DataFrame, start: Column, end: Column, name: str = "month_start"):
    first, last = dates.month_start(start), dates.month_start(end)
    return bounds.select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias(name))


def with_date_key(spine: DataFrame, name: str = "date") -> DataFrame:
    return spine.select(dates.date_key(F.col(name)).alias("datekey"), name)


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    return with_date_key(day_series(spark.range(1), F.lit(start), F.lit(end)))


def spine_over(df: DataFrame, day: str, whole_years: bool = False) -> DataFrame:
    """One row per day from the first to the last ``day`` in ``df``."""
    bounds = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    lo, hi = F.col("lo"), F.col("hi")
    if whole_years:
        lo = F.trunc(lo, "YEAR")
        hi = F.make_date(F.year(hi), F.lit(12), F.lit(31))
    return with_date_key(day_series(bounds, lo, hi))


BLOCK = 1 << 16


def numbers_up_to(df: DataFrame, upper: Column, name: str = "n") -> DataFrame:
    """Each row repeated for 1 .. ``upper``; none where that is below 1 or null.

    Two levels: blocks of numbers first, dealt out over the tasks, then the numbers of each block. So
    no array is longer than a block, however long one row's series is.
    """
    kind = df.select(upper.alias("_upper")).schema["_upper"].dataType
    last = df.withColumn("_upper", upper.cast("long")).where("_upper >= 1")
    blocks = last.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_upper") - 1) / BLOCK))))
    blocks = blocks.hint("rebalance")
    within = F.sequence(F.col("_block") * BLOCK + 1, F.least(F.col("_upper"), (F.col("_block") + 1) * BLOCK))
    return blocks.withColumn(name, F.explode(within)).withColumn(name, F.col(name).cast(kind)).drop("_upper", "_block")


def powers_up_to(df: DataFrame, bound: Column, base: int = 2, name: str = "power") -> DataFrame:
    """1, base, base**2, ... up to the first power that reaches ``bound``."""
    top = 0
    while base ** (top + 1) < 2**62:
        top += 1
    every = F.transform(F.sequence(F.lit(0), F.lit(top)), lambda e: F.pow(F.lit(base), e).cast("long"))
    return df.select(F.explode(F.filter(every, lambda p: p < bound * base)).alias(name))
