"""Duplicates, grain and best-row selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaymill.operators.ordered import Key, row_numbers
from assaymill.runtime import dealt


def dedup_by_key(df: DataFrame, key: Column, order: Sequence[Column]) -> DataFrame:
    """First row per ``key`` along a total ``order``; rows with a NULL or blank key are left out.

    An aggregate, so each task keeps one candidate per key before the shuffle.
    """
    keyed = df.select(key.alias("_key"), F.struct("*").alias("_row"), F.struct(*order).alias("_ord"))
    kept = keyed.where("_key <> ''").groupBy("_key").agg(F.min_by("_row", "_ord").alias("_row"))
    return kept.select("_row.*")


def duplicate_listing(df: DataFrame, key: Column, order: Sequence[Key]) -> DataFrame:
    """All rows whose key occurs more than once, numbered within their key."""
    keyed = df.withColumn("norm_key", key).where("norm_key <> ''")
    repeated = dealt(keyed.groupBy("norm_key").count().where("count > 1").select("norm_key"))
    return row_numbers(keyed.join(repeated, "norm_key"), ["norm_key"], order, "rn")


def dedup_losers(df: DataFrame, key: Column, order: Sequence[Column], id_column: str) -> DataFrame:
    """Ids of the rows ``dedup_by_key`` would drop."""
    keyed = df.where(F.coalesce(key, F.lit("")) != "")
    return keyed.select(id_column).join(
        dedup_by_key(df, key, order).select(id_column), id_column, "left_anti")


def top_n_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, name: str = "rn"
) -> DataFrame:
    """Best ``n`` rows per group along a total order.

    The filter sits right above the window, so Spark keeps at most ``n`` rows per
    group in each task before the shuffle and a large group stays small.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)


def top_rank_per_group(
    df: DataFrame, group: Sequence[str], value: str, n: int = 1, name: str = "rnk"
) -> DataFrame:
    """As ``top_n_per_group`` but ties share a rank and all of them are kept."""
    w = Window.partitionBy(*group).orderBy(F.col(value).desc())
    return df.withColumn(name, F.rank().over(w)).where(F.col(name) <= n)


def latest_per_entity(df: DataFrame, entity: str, order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per entity, as a map-side combining aggregate."""
    rest = [c for c in df.columns if c != entity]
    best = df.groupBy(entity).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(entity, "_row.*").select(*df.columns)


def flag_duplicates(df: DataFrame, key: str, flag: str) -> DataFrame:
    """``flag`` = 1 on rows that share their ``key`` (NULL counts as a value).

    Only repeated keys are joined back; counting combines on the map side, so one
    very common key never gathers its rows in one task.
    """
    counts = df.groupBy(F.col(key).alias("_key")).count()
    repeated = dealt(counts.where("count > 1").select("_key")).withColumn("_hit", F.lit(1))
    return (
        df.join(repeated, F.col(key).eqNullSafe(F.col("_key")), "left")
        .withColumn(flag, F.col("_hit").isNotNull().cast("int"))
        .drop("_key", "_hit")
    )


def grain_check(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Key combinations that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias(name)).where(F.col(name) > 1)


def grain_report(df: DataFrame, grains: dict[str, Sequence[str]]) -> DataFrame:
    """Row count and the number of distinct combinations for each candidate grain.

    One distinct pass per grain, stacked: each is a plain two-step count that
    combines early, where several distinct counts in one aggregate would
    multiply the rows of the whole table first.
    """
    out = None
    for label, keys in grains.items():
        part = df.groupBy(*keys).agg(F.count("*").alias("_rows")).agg(
            F.lit(label).alias("grain"),
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_rows"),
            F.count("*").alias("distinct_keys"),
        )
        out = part if out is None else out.unionByName(part)
    return out
