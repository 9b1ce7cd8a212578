"""Comparisons of rows with their group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.functions.numbers import money_sum, percentage
from assaymill.runtime import dealt


def with_group_value(
    df: DataFrame, group: Sequence[str], value: Column, name: str
) -> DataFrame:
    """Each row next to an aggregate of its group.

    Aggregate, then join: the aggregate combines on the map side and, with few
    groups, the rows are not shuffled at all; with many, the join can split a
    heavy group, where a window would hold the group in one task.
    """
    totals = df.groupBy(*[F.col(g).alias(f"_k_{g}") for g in group]).agg(value.alias(name))
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_k_{g}"))
    return df.join(dealt(totals), same).drop(*[f"_k_{g}" for g in group])


def share_of_group(
    df: DataFrame, group: Sequence[str], value: str, digits: int = 1
) -> DataFrame:
    """Percentage of the group's total; ``value`` is money."""
    joined = with_group_value(df, group, money_sum(F.col(value)), "group_total")
    return joined.withColumn(
        "pct_of_group", percentage(F.col(value), F.col("group_total"), digits))


def profile_distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("raw_value")).agg(F.count("*").alias("n"))
