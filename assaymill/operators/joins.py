"""Joins and correlated conditions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.runtime import dealt


def star_join(
    fact: DataFrame, dims: Sequence[tuple[DataFrame, str]], how: str = "inner"
) -> DataFrame:
    """Fact with several dimensions on shared key names.

    Dimensions come without a hint: Spark broadcasts those whose measured size
    is below the threshold and shuffles the others, splitting heavy keys.
    """
    out = fact
    for dim, key in dims:
        out = out.join(dim, key, how)
    return out


def _keys(right: DataFrame, key: str, many: bool) -> DataFrame:
    """The keys to match against.

    With ``many`` (a fact, whose keys repeat) each task reduces its rows to
    distinct keys before the shuffle, so a heavy key is sent once per task.
    """
    values = right.select(key)
    return values.distinct() if many else values


def semi_join(left: DataFrame, right: DataFrame, key: str, many: bool = False) -> DataFrame:
    """Rows of ``left`` that have a match (EXISTS, IN)."""
    return left.join(_keys(right, key, many), key, "left_semi")


def anti_join(left: DataFrame, right: DataFrame, key: str, many: bool = False) -> DataFrame:
    """Rows of ``left`` without a match (NOT EXISTS); NULL keys never match and stay."""
    return left.join(_keys(right, key, many), key, "left_anti")


def not_in(left: DataFrame, key: str, right: DataFrame) -> DataFrame:
    """SQL ``NOT IN``: empty when ``right`` holds a NULL, NULL keys on the left drop out.

    One scalar fact about the right side decides that, and the rows themselves
    use the ordinary anti join; the built-in null-aware form needs the whole
    right side on every executor.
    """
    values = right.select(F.col(key).alias("_v"))
    listed = values.distinct()
    state = F.when(F.count("*") == 0, "empty").when(F.count("*") > F.count("_v"), "has null")
    kind = values.agg(state.otherwise("plain")).scalar()
    rest = left.join(listed, F.col(key) == F.col("_v"), "left_anti")
    return rest.where(
        (kind == "empty") | ((kind == "plain") & F.col(key).isNotNull()))


def after_validity(
    events: DataFrame, entities: DataFrame, key: str, at: str, ended: str
) -> DataFrame:
    """Events dated after their entity ended."""
    closed = entities.where(F.col(ended).isNotNull())
    return events.where(F.col(at).isNotNull()).join(closed, key).where(F.col(at) > F.col(ended))


def with_overall(df: DataFrame, aggregates: Mapping[str, Column]) -> DataFrame:
    """Each row next to whole-table aggregates, as scalar subqueries instead of a cross join.

    ``df`` is read once more per aggregate; pin it first when it is costly to make.
    """
    return df.select(
        "*", *[df.agg(a.alias(name)).scalar().alias(name) for name, a in aggregates.items()]
    )


def scalar_row(spark, counts: Mapping[str, DataFrame]) -> DataFrame:
    """One row of several one-value queries."""
    return spark.range(1).select(*[df.scalar().alias(name) for name, df in counts.items()])


def count_from(df: DataFrame, other: DataFrame, key: str, name: str) -> DataFrame:
    """Per-row count of matching rows in another set, 0 when there are none."""
    counts = other.groupBy(key).agg(F.count("*").alias(name))
    return df.join(counts, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def flag_orphans(lines: DataFrame, key: str, parents: DataFrame, flag: str) -> DataFrame:
    """``flag`` = 1 where ``key`` has no parent, NULL keys included. Rows are kept.

    One left join with the distinct parent keys and a marker: the lines are read once,
    a small parent is broadcast, and a heavy key of a large one is split.
    """
    known = parents.select(F.col(key)).where(F.col(key).isNotNull()).distinct()
    joined = lines.join(dealt(known).withColumn("_known", F.lit(1)), key, "left")
    return joined.withColumn(flag, F.col("_known").isNull().cast("int")).select(*lines.columns, flag)


def match_status(left: DataFrame, right: DataFrame, key: str, aggregates: Sequence[Column]):
    """Totals of matched and orphan rows."""
    status = F.when(F.col("_orphan") == 1, "orphan").otherwise("matched")
    flagged = flag_orphans(left, key, right, "_orphan")
    return flagged.groupBy(status.alias("match_status")).agg(*aggregates)


def duplicate_pairs(df: DataFrame, key: Column, id_column: str, columns: Sequence[str]) -> DataFrame:
    """Each repeated row next to the first row (smallest id) of its key.

    One pair per repeated row, not one per combination: a key shared by k rows
    gives k - 1 rows and the group can still be read off completely.
    """
    keyed = df.withColumn("_key", key).where("_key <> ''")
    first = (
        keyed.groupBy("_key")
        .agg(F.min_by(F.struct(id_column, *columns), id_column).alias("_first"),
             F.count("*").alias("_n"))
        .where("_n > 1")
    )
    pairs = keyed.join(dealt(first), "_key").where(F.col(id_column) > F.col(f"_first.{id_column}"))
    return pairs.select(
        F.col(f"_first.{id_column}").alias("orig_id"),
        *[F.col(f"_first.{c}").alias(f"orig_{c}") for c in columns],
        F.col(id_column).alias("dup_id"),
        *[F.col(c).alias(f"dup_{c}") for c in columns],
    )
