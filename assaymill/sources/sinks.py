"""Writers. Each returns the table as read back, so the next step starts from the file."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaymill.runtime import new_scratch_path


def create_or_replace(
    df: DataFrame, path: str, cluster_by: Sequence[str] = ()
) -> DataFrame:
    """Define or redefine a derived table. ``path`` must not be an input of ``df``.

    ``cluster_by`` range-partitions and sorts the files, so that a filter on the
    leading column skips files and row groups. End it with columns that make rows
    unique: rows equal in all of them land in one file.
    """
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


POINTER = "CURRENT"


def published(spark: SparkSession, path: str) -> DataFrame:
    """The version of a published table that is current now; a reader keeps it while a newer one is made."""
    return spark.read.parquet(f"{path}/{spark.read.text(f'{path}/{POINTER}').first()[0]}")


def publish(df: DataFrame, path: str, cluster_by: Sequence[str] = ()) -> DataFrame:
    """Replace a table without a moment in which it is missing or half written.

    The rows go to a version folder of their own; only when that is whole, one atomic rename makes
    its name the current one. A build that fails leaves the old rows readable, so ``df`` may
    read the table it replaces. The version before stays for those who read it, older ones go.
    """
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    pointer = hadoop.Path(f"{path}/{POINTER}")
    before = spark.read.text(pointer.toString()).first()[0] if files.exists(pointer) else None
    version = f"version-{uuid.uuid4().hex}"
    create_or_replace(df, f"{path}/{version}", cluster_by)
    written = hadoop.Path(f"{path}/.{version}")
    out = files.create(written, False)
    out.write(bytearray(version.encode()))
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    overwrite[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(written, pointer, overwrite)
    for status in files.listStatus(hadoop.Path(path)):
        if status.isDirectory() and status.getPath().getName() not in (version, before):
            files.delete(status.getPath(), True)
    return published(spark, path)


def _folder(key: str, folders: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(folders)).cast("int")


def write_folders(df: DataFrame, path: str, key: str, folders: int) -> DataFrame:
    """A table in ``folders`` hash folders of ``key``, for ``merge_folders``."""
    placed = df.withColumn("folder", _folder(key, folders)).repartition("folder")
    placed.write.mode("overwrite").partitionBy("folder").parquet(path)
    return df.sparkSession.read.parquet(path).drop("folder")


def merge_folders(
    path: str, updates: DataFrame, key: str, folders: int, merge: Callable[[DataFrame, DataFrame], DataFrame]
) -> DataFrame:
    """Merge ``updates`` into a table written by ``write_folders`` with the same ``folders``.

    Only folders that hold a key of the updates are read and written; the files of the others
    stay as they are. ``merge(rows, updates)`` sees the rows of those folders. The new folders are
    whole in a scratch table before they replace the old ones.
    """
    spark = updates.sparkSession
    touched = sorted(r[0] for r in updates.select(_folder(key, folders)).distinct().toLocalIterator())
    table = spark.read.parquet(path)
    rows = table.where(F.col("folder").isin(touched)).drop("folder")
    staged = new_scratch_path(spark, "folders")
    merge(rows, updates).withColumn("folder", _folder(key, folders)).write.parquet(staged)
    fresh = spark.read.parquet(staged).repartition("folder").select(table.columns)
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("folder").parquet(path)
    return spark.read.parquet(path).drop("folder")


def create_or_replace_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def create_if_absent(df: DataFrame, path: str) -> DataFrame:
    """Write the table only when there is none yet."""
    df.write.mode("ignore").parquet(path)
    return df.sparkSession.read.parquet(path)


def insert_select(df: DataFrame, path: str) -> DataFrame:
    """Append by column name; columns the target lacks are dropped, missing ones become NULL.

    Values take the target's types, so that all files of the table agree; one that does
    not fit fails the job before anything is added.
    """
    target = df.sparkSession.read.parquet(path)
    aligned = df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.schema.fields])
    aligned.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(target.schema).parquet(path)


def export_csv(df: DataFrame, path: str) -> DataFrame:
    """CSV part files with a header, one per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return df.sparkSession.read.schema(df.schema).option("header", True).csv(path)
