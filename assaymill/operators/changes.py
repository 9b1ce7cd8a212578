"""Table changes as new versions. The result never overwrites the table being read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assaymill.functions.dates import OPEN_END


def unique_by(df: DataFrame, key: str) -> DataFrame:
    """``df`` as it is; the job fails when two rows share a key or have none, so that a merge never multiplies rows.

    One aggregate on the key, the partitioning the merge needs anyway.
    """
    rows = df.groupBy(F.col(key).alias("_key")).agg(
        F.count("*").alias("_rows"), F.any_value(F.struct("*")).alias("_row"))
    message = F.concat(F.lit(f"repeated or missing {key} in the updates: "), F.coalesce(F.col("_key").cast("string"), F.lit("null")))
    single = F.when((F.col("_rows") == 1) & F.col("_key").isNotNull(), F.col("_row")).otherwise(F.raise_error(message))
    return rows.select(single.alias("_row")).select("_row.*")


def scd1_upsert(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Updates replace rows with the same key and add the others.

    A key that occurs twice in the updates, and a null key there, fails the job.
    """
    updates = unique_by(updates, key)
    new = updates.select([F.col(c).alias(f"_new_{c}") for c in updates.columns])
    joined = target.join(new, F.col(key) == F.col(f"_new_{key}"), "full_outer")
    replaced = F.col(f"_new_{key}").isNotNull()
    return joined.select(
        *[
            F.when(replaced, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in updates.columns else F.col(c)
            for c in target.columns
        ]
    )


def scd2_window_view(df: DataFrame, started: str, ended: str) -> DataFrame:
    """Validity columns from a start and a possibly open end date."""
    return df.select(
        "*",
        F.col(started).alias("valid_from"),
        F.coalesce(F.col(ended), F.lit(OPEN_END).cast("date")).alias("valid_to"),
        F.col(ended).isNull().cast("int").alias("is_current"),
    )


def scd2_merge(
    history: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str], as_of: Column
) -> DataFrame:
    """Close current versions whose tracked columns changed and append the new versions.

    One equi join of the snapshot with the current versions finds both; a row
    that does not change is passed through, closed versions are not touched.
    ``history`` has ``key``, the tracked columns, valid_from, valid_to, is_current. A
    key that occurs twice in the snapshot, and a null key there, fails the job.
    """
    fresh = unique_by(snapshot.select(key, *tracked), key).select(
        F.col(key).alias("_s_key"), *[F.col(c).alias(f"_s_{c}") for c in tracked])
    past = history.where("is_current = 0")
    current = history.where("is_current = 1")
    paired = current.join(fresh, F.col(key) == F.col("_s_key"), "full_outer")
    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    changed = F.col(key).isNotNull() & F.col("_s_key").isNotNull() & differs
    added = F.col(key).isNull()

    def version(values: Sequence[Column], start: Column, end: Column, open_: int) -> Column:
        names = [key, *tracked]
        return F.struct(
            *[v.alias(n) for n, v in zip(names, values, strict=True)],
            start.alias("valid_from"), end.alias("valid_to"), F.lit(open_).alias("is_current"))

    open_end = F.lit(OPEN_END).cast("date")
    old = [F.col(key), *[F.col(c) for c in tracked]]
    new = [F.col("_s_key"), *[F.col(f"_s_{c}") for c in tracked]]
    kept = version(old, F.col("valid_from"), F.col("valid_to"), 1)
    closed = version(old, F.col("valid_from"), F.date_sub(as_of, 1), 0)
    opened = version(new, as_of, open_end, 1)
    # A version that began on the same day never held for a day: the new one takes its place.
    corrected = version(new, F.col("valid_from"), open_end, 1)
    rows = (
        F.when(added, F.array(opened))
        .when(changed & (F.col("valid_from") >= as_of), F.array(corrected))
        .when(changed, F.array(closed, opened))
        .otherwise(F.array(kept))
    )
    merged = paired.select(F.inline(rows))
    return past.select(*merged.columns).unionByName(merged)


def conditional_update(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """``UPDATE ... SET ... WHERE``; a NULL condition leaves the row as it is."""
    return df.withColumns(
        {name: F.when(condition, v).otherwise(F.col(name)) for name, v in values.items()})


def delete_rows(df: DataFrame, condition: Column) -> DataFrame:
    """``DELETE ... WHERE``; a NULL condition keeps the row."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def add_column_default(df: DataFrame, name: str, default: Column) -> DataFrame:
    return df.withColumn(name, default)


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def drop_column(df: DataFrame, name: str) -> DataFrame:
    return df.drop(name)


def rebuild_with_schema(
    df: DataFrame, schema: StructType, defaults: Mapping[str, object]
) -> DataFrame:
    """Copy into a new schema: shared columns convert, absent and NULL ones take their default."""
    out = []
    for field in schema:
        value = F.col(field.name).try_cast(field.dataType) if field.name in df.columns else F.lit(
            None).cast(field.dataType)
        if field.name in defaults:
            value = F.coalesce(value, F.lit(defaults[field.name]).cast(field.dataType))
        out.append(value.alias(field.name))
    return df.select(*out)
