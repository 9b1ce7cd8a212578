"""Gold layer: dimensions, the order-line fact and its rollups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.functions import dates
from assaymill.functions.numbers import money_sum
from assaymill.plans import silver


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(*silver.CUSTOMER_COLUMNS)


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(*silver.PRODUCT_COLUMNS)


def dim_employee(employees: DataFrame) -> DataFrame:
    return employees.select(*silver.EMPLOYEE_COLUMNS)


def dim_date(calendar: DataFrame) -> DataFrame:
    parts = dates.date_parts(F.col("date"))
    return calendar.select("datekey", "date", *[c.alias(name) for name, c in parts.items()])


FACT_COLUMNS = [
    "order_id", "order_line_id", "customer_id", "product_id", "employee_id", "datekey",
    "order_date", "ship_date", "quantity", "unit_price", "discount_pct", "net_amount",
    "payment_method", "order_status", "channel", "is_customer_orphan", "is_product_orphan",
]


def fact_sales(sales: DataFrame) -> DataFrame:
    """One row per order line. Keys pass through as they are; orphans carry a flag."""
    keyed = sales.withColumn("datekey", dates.date_key(F.col("order_date")))
    return keyed.select(*[c for c in FACT_COLUMNS if c in keyed.columns])


def _line_totals() -> list[Column]:
    """Lines, units and net sales of a group, money in whole cents."""
    return [
        F.count("*").alias("lines"),
        F.sum("quantity").alias("units"),
        F.sum(F.rint(F.col("net_amount") * 100).cast("long")).alias("cents"),
    ]


def _added() -> list[Column]:
    """The same totals of rows that are totals themselves."""
    return [F.sum(c).alias(c) for c in ("lines", "units", "cents")]


def _by_period(daily: DataFrame, calendar: DataFrame, by: Sequence[str]) -> DataFrame:
    """Day totals to calendar periods; days outside the calendar and NULL dates drop out."""
    parts = [c for c in by if c in calendar.columns]
    return daily.join(calendar.select("datekey", *parts), "datekey").groupBy(*by).agg(
        F.sum("lines").alias("order_line_count"),
        F.sum("units").alias("total_quantity"),
        (F.sum("cents") / 100).alias("total_net_amount"),
    )


def rollup(
    fact: DataFrame, calendar: DataFrame, dims: Sequence[tuple[DataFrame, str]], by: Sequence[str]
) -> DataFrame:
    """Lines, units and net sales by calendar parts and dimension attributes.

    Each dimension is ``(frame, key)``; unmatched keys drop out, and only the key
    and the attributes in ``by`` are read from it. Lines first combine to day and key, in
    each task before the shuffle, so only those totals meet a dimension or the calendar.
    """
    keys = [key for _, key in dims]
    attributes = [c for c in by if c not in calendar.columns]
    own = [c for c in attributes if c in fact.columns and c not in keys]
    joined = fact.groupBy("datekey", *keys, *own).agg(*_line_totals())
    for dim, key in dims:
        joined = joined.join(dim.select(key, *[c for c in by if c in dim.columns and c != key]), key)
    daily = joined.groupBy("datekey", *attributes).agg(*_added())
    return _by_period(daily, calendar, by)


def sales_by_attributes(
    fact: DataFrame,
    calendar: DataFrame,
    dims: Sequence[tuple[DataFrame, str]],
    attributes: Mapping[str, str | None],
) -> DataFrame:
    """Net sales per year by each of several attributes, stacked, in one pass over the fact.

    ``attributes`` maps a column to the key of its dimension, or None for the
    fact's own columns. A line counts for an attribute only where its dimension
    row exists. Lines combine to day, keys and own columns before they meet a dimension;
    these totals fan out to one row per attribute and combine again.
    """
    keys = dict.fromkeys(key for _, key in dims)
    own = [name for name, key in attributes.items() if key is None and name not in keys]
    joined = fact.groupBy("datekey", *keys, *own).agg(*_line_totals())
    for dim, key in dims:
        joined = joined.join(dim.withColumn(f"_has_{key}", F.lit(True)), key, "left")
    members = [
        F.when(F.lit(True) if key is None else F.col(f"_has_{key}"), F.struct(
            F.lit(name).alias("dimension"), F.col(name).alias("member")))
        for name, key in attributes.items()
    ]
    fanned = joined.select(
        "datekey", "lines", "units", "cents", F.inline(F.array_compact(F.array(*members))))
    daily = fanned.groupBy("datekey", "dimension", "member").agg(*_added())
    return _by_period(daily, calendar, ["dimension", "member", "year"])


def agg_monthly_sales_by_category(
    fact: DataFrame, calendar: DataFrame, products: DataFrame
) -> DataFrame:
    by = ["year", "month", "month_name", "category"]
    return rollup(fact, calendar, [(products, "product_id")], by)


def agg_quarterly_by_category(
    fact: DataFrame, calendar: DataFrame, products: DataFrame
) -> DataFrame:
    return rollup(fact, calendar, [(products, "product_id")], ["year", "quarter", "category"])


def customer_totals(fact: DataFrame) -> DataFrame:
    """Orders, lines, money and date range per customer.

    First per (customer, order), then per customer: counts orders without a
    distinct aggregate, and one heavy customer spreads over many tasks.
    """
    per_order = fact.groupBy("customer_id", "order_id").agg(
        F.count("order_line_id").alias("lines"),
        F.sum(F.rint(F.col("net_amount") * 100).cast("long")).alias("cents"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
    )
    return per_order.groupBy("customer_id").agg(
        F.count("order_id").alias("order_count"),
        F.sum("lines").alias("order_line_count"),
        (F.sum("cents") / 100).alias("lifetime_net_amount"),
        F.min("first_date").alias("first_order_date"),
        F.max("last_date").alias("last_order_date"),
    )


def agg_customer_ltv(
    customers: DataFrame, fact: DataFrame, status_filter: str | None = None
) -> DataFrame:
    """Lifetime value per customer; customers without orders stay, with zeros."""
    lines = fact if status_filter is None else fact.where(F.col("order_status") == status_filter)
    people = customers.select("customer_id", "full_name", "customer_segment", "state")
    joined = people.join(customer_totals(lines), "customer_id", "left")
    return joined.select(
        *people.columns,
        F.coalesce("order_count", F.lit(0)).alias("order_count"),
        F.coalesce("order_line_count", F.lit(0)).alias("order_line_count"),
        F.coalesce("lifetime_net_amount", F.lit(0.0)).alias("lifetime_net_amount"),
        "first_order_date", "last_order_date",
    )


def daily_totals(fact: DataFrame) -> DataFrame:
    """Lines and net sales per day, for days that have lines."""
    return fact.groupBy("datekey").agg(
        F.count("order_line_id").alias("order_line_count"),
        money_sum(F.col("net_amount")).alias("total_net_amount"),
    )


def agg_daily_sales(calendar: DataFrame, fact: DataFrame) -> DataFrame:
    """One row per calendar day, zeros included. The fact shrinks to days before the join."""
    days = calendar.select("datekey", F.col("date").alias("order_date"), "year", "month",
                           "day_name", "is_weekend")
    return days.join(daily_totals(fact), "datekey", "left").select(
        "order_date", "year", "month", "day_name", "is_weekend",
        F.coalesce("order_line_count", F.lit(0)).alias("order_line_count"),
        F.coalesce("total_net_amount", F.lit(0.0)).alias("total_net_amount"),
    )
