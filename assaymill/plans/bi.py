"""Extracts for a reporting tool: flat tables and a small star around the newest lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.functions.numbers import discount_tier, gross_amount
from assaymill.operators.ordered import surrogate_key
from assaymill.runtime import bounded, pinned

EXTRACT_ROWS = 100


def newest(fact: DataFrame, tie_break: Sequence[str], n: int = EXTRACT_ROWS) -> DataFrame:
    """The ``n`` newest lines. Each task keeps its own best ``n``; the cut is the report's."""
    order = [F.col("order_date").desc(), "order_id", "order_line_id", *tie_break]
    return fact.orderBy(*order).limit(n)


def _named(df: DataFrame, key: str, names: dict[str, str]) -> DataFrame:
    return df.select(key, *[F.col(old).alias(new) for old, new in names.items()])


def flat_sales_all(
    fact: DataFrame, customers: DataFrame, products: DataFrame, employees: DataFrame,
    tie_break: Sequence[str], n: int = EXTRACT_ROWS,
) -> DataFrame:
    """Newest lines with customer, product and rep spelled out.

    The limit comes before the joins: dimension keys are unique, so it picks the
    same lines. The ``n`` lines are pinned, so the fact is read once.
    """
    lines = pinned(newest(fact, tie_break, n))
    people = _named(customers, "customer_id", {
        "full_name": "customer_name", "customer_segment": "customer_segment",
        "state": "customer_state"})
    goods = _named(products, "product_id", {
        "product_name": "product_name", "category": "product_category", "brand": "product_brand"})
    reps = _named(employees, "employee_id", {
        "full_name": "sales_rep_name", "region": "sales_region"})
    flat = lookup_small(lookup_small(lookup_small(lines, people, "customer_id"), goods,
                                     "product_id"), reps, "employee_id")
    return flat.select(
        "order_id", "order_line_id", "order_date", "customer_name", "customer_segment",
        "customer_state", "product_name", "product_category", "product_brand", "sales_rep_name",
        "sales_region", "quantity", "unit_price", "discount_pct",
        gross_amount(F.col("quantity"), F.col("unit_price")).alias("gross_amount"),
        "net_amount", discount_tier(F.col("discount_pct")).alias("discount_tier"),
        "payment_method", "order_status", "channel")


def lookup_small(lines: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join of a few lines with a dimension of any size.

    The dimension is first cut to the keys in use; those few keys are what is
    broadcast, never the dimension.
    """
    used = dim.join(bounded(lines.select(key).distinct()), key, "left_semi")
    return lines.join(bounded(used), key, "left")


def flat_sales_completed(
    fact: DataFrame, customers: DataFrame, products: DataFrame, tie_break: Sequence[str],
    n: int = EXTRACT_ROWS,
) -> DataFrame:
    completed = fact.where("order_status = 'Completed'")
    lines = pinned(newest(completed, tie_break, n))
    people = _named(customers, "customer_id", {"full_name": "customer_name"})
    goods = _named(products, "product_id", {
        "product_name": "product_name", "category": "product_category"})
    flat = lookup_small(lookup_small(lines, people, "customer_id"), goods, "product_id")
    return flat.select(
        "order_id", "order_line_id", "order_date", "customer_name", "product_name",
        "product_category", "quantity", "net_amount", "channel")


def scoped_dimension(dim: DataFrame, lines: DataFrame, key: str, columns: Sequence[str]):
    """Dimension rows that a limited set of fact lines refers to."""
    used = dim.select(*columns).join(bounded(lines.select(key).distinct()), key, "left_semi")
    return used.distinct()


def star_extract(
    fact: DataFrame, customers: DataFrame, products: DataFrame, employees: DataFrame,
    calendar: DataFrame, tie_break: Sequence[str], n: int = EXTRACT_ROWS,
) -> dict[str, DataFrame]:
    """Newest lines and the dimension rows they use."""
    lines = pinned(newest(fact, tie_break, n))
    return {
        "fact_sales": lines.select(
            "order_id", "order_line_id", "customer_id", "product_id", "employee_id", "datekey",
            "quantity", "unit_price", "discount_pct", "net_amount", "payment_method",
            "order_status", "channel"),
        "dim_customer": scoped_dimension(customers, lines, "customer_id", [
            "customer_id", "full_name", "email", "state", "customer_segment"]),
        "dim_product": scoped_dimension(products, lines, "product_id", [
            "product_id", "product_name", "category", "subcategory", "brand", "unit_cost",
            "unit_price"]),
        "dim_employee": scoped_dimension(employees, lines, "employee_id", [
            "employee_id", "full_name", "department", "region"]),
        "dim_date": scoped_dimension(calendar, lines, "datekey", [
            "datekey", "date", "year", "month", "month_name", "quarter", "day_name",
            "is_weekend"]),
    }


def snowflake_normalize(
    dim: DataFrame, attribute: str, key: str, id_name: str
) -> tuple[DataFrame, DataFrame]:
    """Split ``attribute`` out of a dimension: (slim dimension, keyed attribute table)."""
    values = dim.select(attribute).where(F.col(attribute).isNotNull()).distinct()
    table = surrogate_key(values, attribute, id_name)
    slim = dim.select(key, attribute).join(table, attribute).select(key, id_name)
    return slim, table


def matrix(df: DataFrame, rows: str, columns: str, values: Sequence[str], cell: Column):
    """Cross-tabulation over a known list of column values."""
    return df.groupBy(rows).pivot(columns, list(values)).agg(cell)
