"""Data-quality reports. Every check is an aggregate; violations come back as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.functions.numbers import lenient_double, net_amount


def stacked(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def orphan_fk_report(keys: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Lines whose foreign key has no parent, per ``key: (lines, parents)``. NULL is an orphan.

    Lines are counted per key before the anti join, so the join sees each key
    once, however many lines share it.
    """
    parts = []
    for key, (lines, parents) in keys.items():
        counted = lines.groupBy(key).agg(F.count("*").alias("_lines"))
        lost = counted.join(parents.select(key), key, "left_anti")
        parts.append(lost.agg(
            F.lit(key).alias("foreign_key"),
            F.coalesce(F.sum("_lines"), F.lit(0)).alias("orphan_lines"),
            F.count(key).alias("orphan_ids"),
            F.min(key).alias("sample_id"),
        ))
    return stacked(parts)


def counters(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Several conditional counts in one pass."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def unpivot_counters(df: DataFrame) -> DataFrame:
    """One-row counters as (check_name, actual) rows."""
    pairs = [
        F.struct(F.lit(c).alias("check_name"), F.col(c).cast("long").alias("actual"))
        for c in df.columns
    ]
    return df.select(F.inline(F.array(*pairs)))


def stale_totals(sales: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """Discounted lines whose stored total still shows the price before discount."""
    before = F.round(F.col("quantity") * F.col("unit_price"), 2)
    after = net_amount(F.col("quantity"), F.col("unit_price"), F.col("discount_pct"))
    stored = lenient_double(F.col("order_total"))
    discounted = (F.col("discount_pct") > 0) & (F.col("discount_pct") <= 1)
    plain = F.col("order_total").isNotNull() & ~F.col("order_total").startswith("$")
    wanted = sales.where(discounted & plain & F.col("quantity").isNotNull())
    return (
        wanted.withColumn("pre_discount_total", before)
        .withColumn("net_amount", after)
        .where((stored != F.col("net_amount"))
               & (F.abs(stored - F.col("pre_discount_total")) < tolerance))
    )


# Texts that stand for a total nobody has entered.
PLACEHOLDERS = ["TBD", "N/A"]


def junk_totals(sales: DataFrame) -> DataFrame:
    """Every stored total that is no plain number, a placeholder or a text with a currency sign, and its lines."""
    stored = F.trim("order_total")
    junk = sales.where(stored.isin(PLACEHOLDERS) | stored.startswith("$"))
    return junk.groupBy("order_total").agg(F.count("*").alias("order_lines"))


def constraint_violations(
    df: DataFrame,
    *,
    unique: Mapping[str, Column] | None = None,
    not_null: Sequence[str] = (),
    checks: Mapping[str, Column] | None = None,
    foreign: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Violating rows per constraint as (constraint_name, violations).

    NOT NULL and CHECK are counted together in one pass; a CHECK that yields
    NULL passes. UNIQUE counts surplus rows and ignores NULL. FOREIGN KEY ignores NULL
    and counts rows per key before the anti join, so a heavy key is one row there.
    """
    row_rules = {f"NOT NULL {c}": F.col(c).isNull() for c in not_null}
    row_rules |= {f"CHECK {n}": ~c for n, c in (checks or {}).items()}
    parts = []
    if row_rules:
        parts.append(unpivot_counters(counters(df, row_rules)))
    for name, key in (unique or {}).items():
        repeated = df.select(key.alias("_k")).where("_k IS NOT NULL").groupBy("_k").count()
        parts.append(repeated.where("count > 1").agg(
            F.lit(f"UNIQUE {name}").alias("check_name"),
            F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("actual"),
        ))
    for key, parent in (foreign or {}).items():
        counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_lines"))
        lost = counted.join(parent.select(key), key, "left_anti")
        parts.append(lost.agg(
            F.lit(f"FOREIGN KEY {key}").alias("check_name"),
            F.coalesce(F.sum("_lines"), F.lit(0)).alias("actual")))
    return stacked(parts).withColumnsRenamed(
        {"check_name": "constraint_name", "actual": "violations"})


def unmapped_values(df: DataFrame, raw: str, mapped: Column) -> DataFrame:
    """Raw values that a canonical map sends to NULL, with their counts."""
    lost = df.where(F.col(raw).isNotNull() & mapped.isNull())
    return lost.groupBy(F.col(raw).alias("raw_value")).agg(F.count("*").alias("n"))


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.lit(name).alias("check_name"), F.count("*").alias("actual"))


def layer_row_counts(threads: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Rows per layer, one output row per thread."""
    parts = [
        df.agg(F.lit(thread).alias("thread"), F.lit(layer).alias("layer"), F.count("*").alias("n"))
        for thread, layers in threads.items()
        for layer, df in layers.items()
    ]
    layers = list(dict.fromkeys(layer for ls in threads.values() for layer in ls))
    return stacked(parts).groupBy("thread").pivot("layer", layers).agg(F.first("n"))


# Tier of a table by the prefix of its name.
TIERS = {"bronze_": "Bronze", "silver_": "Silver", "agg_": "Gold (Aggregations)"}
DEFAULT_TIER = "Gold"


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Tier, row count and column count per table."""
    parts = []
    for name, df in tables.items():
        tier = next((t for prefix, t in TIERS.items() if name.startswith(prefix)), DEFAULT_TIER)
        parts.append(df.agg(
            F.lit(name).alias("table_name"),
            F.lit(tier).alias("tier"),
            F.count("*").alias("row_count"),
            F.lit(len(df.columns)).alias("column_count"),
        ))
    return stacked(parts)


def join_inflation_check(fact: DataFrame, dims: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Rows before and after inner joins with the dimensions."""
    joined = fact.select(*[key for _, key in dims])
    for dim, key in dims:
        joined = joined.join(dim.select(key), key)
    return stacked([row_count(fact, "before_joins"), row_count(joined, "after_joins")])
