"""Joins of dated events with validity intervals, in time buckets instead of key by key.

An equi join on the key alone forms every event with every version of its key. Here a version
goes to a handful of buckets whose width fits its length (``FANOUT`` days to some power, at most
``FANOUT`` + 1 of them), an event to one bucket of every width that some version uses, and the
join key is (key, width, bucket). A version's buckets reach less than its own length
beyond it, so the candidates stay near the result, and a heavy key is as
many join keys as it has buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FANOUT = 4  # a power of two


def _exponent(days: Column) -> Column:
    """The largest power of ``FANOUT`` that is no more than ``days``, exactly."""
    bits = FANOUT.bit_length() - 1
    return F.floor((F.length(F.bin(days)) - 1) / bits).cast("int")


def _bucket(day: Column, exponent: Column) -> Column:
    return F.floor(day / F.pow(F.lit(FANOUT), exponent)).cast("bigint")


def _day(column: str) -> Column:
    return F.unix_date(F.col(column).cast("date")).cast("bigint")


def candidates(
    events: DataFrame, versions: DataFrame, key: str, at: str, valid_from: str, valid_to: str
) -> DataFrame:
    """Events next to the versions of their key in a common bucket: all matches and few others.

    ``at`` and the bounds are dates or timestamps. An open end reaches to the last event and a
    version that begins later meets nothing, so open versions are as narrow as the data
    allows. No pair comes up twice.
    """
    last = events.agg(F.max(_day(at))).scalar()
    spans = versions.withColumns({
        "_from": _day(valid_from), "_to": F.coalesce(F.least(_day(valid_to), last), last)})
    spans = spans.where("_from <= _to").withColumn("_width", _exponent(F.col("_to") - F.col("_from") + 1))
    widths = spans.agg(F.array_sort(F.collect_set("_width"))).scalar()
    placed = spans.select(*versions.columns, "_width", F.explode(F.sequence(
        _bucket(F.col("_from"), F.col("_width")), _bucket(F.col("_to"), F.col("_width")))).alias("_bucket"))
    dated = events.select("*", F.explode(widths).alias("_width"))
    dated = dated.withColumn("_bucket", _bucket(_day(at), F.col("_width")))
    return dated.join(placed, [key, "_width", "_bucket"]).drop("_width", "_bucket")


def point_in_time_join(
    events: DataFrame, versions: DataFrame, key: str, at: str, valid_from: str, valid_to: str
) -> DataFrame:
    """Events with every version that was valid on their date, both ends included; an open end never expires.

    A null key, date or start matches nothing. Versions may overlap, repeat and have gaps.
    """
    in_window = (F.col(at) >= F.col(valid_from)) & (
        F.col(valid_to).isNull() | (F.col(at) <= F.col(valid_to))
    )
    return candidates(events, versions, key, at, valid_from, valid_to).where(in_window)
