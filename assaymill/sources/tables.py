"""Reading tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scan_table(spark: SparkSession, path: str, *columns: str, schema: StructType | None = None):
    """A Parquet table, all columns or the named ones; no schema inference when one is given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def typed_extract(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in its types; values that do not convert become NULL."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def inline_values(spark: SparkSession, columns: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """A literal relation for small lookups."""
    return spark.createDataFrame([tuple(r) for r in rows], list(columns))
