"""Analyses over the fact and its rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.functions import dates
from assaymill.functions.numbers import exact_avg, money_sum, product_sum, percentage


def product_revenue(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Net sales per product. The fact shrinks to products before it meets the dimension."""
    per_product = lines.groupBy("product_id").agg(
        money_sum(F.col("net_amount")).alias("total_revenue"))
    named = products.select("product_id", "category", "product_name")
    return per_product.join(named, "product_id").select(
        "category", "product_id", "product_name", "total_revenue")


def month_totals(monthly: DataFrame) -> DataFrame:
    return monthly.groupBy("year", "month").agg(
        money_sum(F.col("total_net_amount")).alias("month_total"))


def category_years(monthly: DataFrame) -> DataFrame:
    return monthly.groupBy("year", "category").agg(
        money_sum(F.col("total_net_amount")).alias("year_revenue"))


def cohort_summary(customers: DataFrame, fact: DataFrame) -> DataFrame:
    """Size, active customers and revenue per sign-up month."""
    spent = fact.where("order_date IS NOT NULL").groupBy("customer_id").agg(
        money_sum(F.col("net_amount")).alias("spent"))
    cohorts = customers.where("signup_date IS NOT NULL").select(
        "customer_id", dates.year_month(F.col("signup_date")).alias("cohort_month"))
    joined = cohorts.join(spent.withColumn("active", F.lit(1)), "customer_id", "left")
    return joined.groupBy("cohort_month").agg(
        F.count("*").alias("cohort_size"), F.count("active").alias("active_customers"),
        money_sum(F.col("spent")).alias("cohort_net_amount"))


def cohort_retention(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Active customers per sign-up month and months since sign-up.

    Orders shrink to (customer, month) first, so the count afterwards needs no
    distinct and a heavy customer is at most one row per month.
    """
    months = orders.where("order_date IS NOT NULL").select(
        "customer_id", dates.month_number(F.col("order_date")).alias("order_month")).distinct()
    cohorts = customers.where("signup_date IS NOT NULL").select(
        "customer_id",
        dates.year_month(F.col("signup_date")).alias("cohort_month"),
        dates.month_number(F.col("signup_date")).alias("signup_month"))
    offset = (F.col("order_month") - F.col("signup_month")).alias("months_since_signup")
    return cohorts.join(months, "customer_id").groupBy("cohort_month", offset).agg(
        F.count("*").alias("active_customers"))


def cohort_activation(customers: DataFrame, orders: DataFrame, days: int = 90) -> DataFrame:
    """Share of each sign-up year that ordered within ``days`` of signing up."""
    first = orders.where("order_date IS NOT NULL").groupBy("customer_id").agg(
        F.min("order_date").alias("first_order"))
    joined = customers.where("signup_date IS NOT NULL").select(
        "customer_id", "signup_date").join(first, "customer_id", "left")
    activated = F.count_if(F.datediff("first_order", "signup_date").between(0, days))
    return joined.groupBy(F.year("signup_date").alias("signup_year")).agg(
        F.count("*").alias("cohort_size"),
        activated.alias("activated"),
        percentage(activated, F.count("*"), 2).alias("activation_rate_pct"))


def ltv_by_segment(ltv: DataFrame) -> DataFrame:
    amount = F.col("lifetime_net_amount")
    return ltv.groupBy("customer_segment").agg(
        F.count("*").alias("customers"),
        F.count_if(F.col("order_count") == 0).alias("zero_order_customers"),
        F.round(exact_avg(amount), 2).alias("avg_ltv"),
        money_sum(amount).alias("segment_total_ltv"))


def orders_per_customer(orders: DataFrame) -> DataFrame:
    """Distinct orders per customer, counted in two steps."""
    return orders.select("customer_id", "order_id").distinct().groupBy("customer_id").agg(
        F.count("*").alias("order_count"))


def segment_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    joined = customers.select("customer_id", "customer_segment").join(
        orders_per_customer(orders), "customer_id", "left")
    return joined.groupBy("customer_segment").agg(
        F.count("*").alias("customers"),
        F.coalesce(F.sum("order_count"), F.lit(0)).alias("orders"))


# Upper bounds and names of the tiers; the last one is open.
FREQUENCY_TIERS = [
    (0, "No Orders"), (8, "Light (1-8 orders)"), (14, "Regular (9-14 orders)"),
    (None, "Frequent (15+ orders)"),
]
BREADTH_TIERS = [
    (0, "No Purchases"), (2, "Narrow (1-2 categories)"), (4, "Moderate (3-4 categories)"),
    (None, "Broad (5+ categories)"),
]


def tier_of(value: Column, tiers: Sequence[tuple[int | None, str]]) -> Column:
    out = F
    for bound, name in tiers:
        if bound is None:
            return out.otherwise(name)
        out = out.when(value <= bound, name)
    return out


def customer_tiers(
    customers: DataFrame, counts: DataFrame, count: str, tiers: Sequence[tuple[int | None, str]],
    tier: str, average: str,
) -> DataFrame:
    """Customers per segment and tier of a per-customer count, zero when absent."""
    value = F.coalesce(count, F.lit(0))
    joined = customers.select("customer_id", "customer_segment").join(counts, "customer_id", "left")
    return joined.groupBy(
        F.coalesce("customer_segment", F.lit("Unknown")).alias("customer_segment"),
        tier_of(value, tiers).alias(tier),
    ).agg(
        F.count("*").alias("num_customers"),
        F.round(F.sum(value) / F.count("*"), 2).alias(average))


def frequency_tiers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return customer_tiers(customers, orders_per_customer(orders), "order_count", FREQUENCY_TIERS,
                          "frequency_tier", "avg_orders")


def category_breadth_tiers(
    customers: DataFrame, fact: DataFrame, products: DataFrame
) -> DataFrame:
    bought = fact.select("customer_id", "product_id").join(
        products.select("product_id", "category"), "product_id")
    breadth = bought.where("category IS NOT NULL").select("customer_id", "category").distinct()
    breadth = breadth.groupBy("customer_id").agg(F.count("*").alias("categories"))
    return customer_tiers(customers, breadth, "categories", BREADTH_TIERS,
                          "breadth_tier", "avg_categories")


def gross_margin_by_category(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue minus units at today's cost; products without a cost are left out."""
    costed = products.where("unit_cost IS NOT NULL").select("product_id", "category", "unit_cost")
    sold = lines.groupBy("product_id").agg(
        money_sum(F.col("net_amount")).alias("net"), F.sum("quantity").alias("units"))
    revenue, cost = money_sum(F.col("net")), product_sum(F.col("units") * F.col("unit_cost"))
    return sold.join(costed, "product_id").groupBy("category").agg(
        revenue.alias("total_revenue"), cost.alias("total_cost"),
        F.round(revenue - cost, 2).alias("gross_margin"))


def ship_lead_time(fact: DataFrame) -> DataFrame:
    days = F.datediff("ship_date", "order_date")
    return fact.where("order_date IS NOT NULL AND ship_date IS NOT NULL").groupBy("channel").agg(
        F.count("*").alias("shipped_lines"),
        F.round(F.sum(days) / F.count("*"), 2).alias("avg_days_to_ship"),
        F.count_if(days < 0).alias("shipped_before_order"))


def exclusive_channel_customers(customers: DataFrame, fact: DataFrame) -> DataFrame:
    """Customers who bought through one channel only, with that channel.

    "Bought here" and "never bought elsewhere" come from one aggregate instead of
    a semi and an anti join per channel.
    """
    used = fact.groupBy("customer_id").agg(
        F.min("channel").alias("only_channel"), F.max("channel").alias("_other"))
    single = used.where("only_channel = _other").drop("_other")
    return customers.select("customer_id", "full_name").join(single, "customer_id")


def after_termination_share(fact: DataFrame, employees: DataFrame) -> DataFrame:
    """Lines of employees who left, and how many of them are dated after they left."""
    left = employees.where("termination_date IS NOT NULL").select(
        "employee_id", "full_name", "termination_date")
    late = F.count_if(F.col("order_date") > F.col("termination_date"))
    sold = fact.where("order_date IS NOT NULL").select("employee_id", "order_date")
    return sold.join(left, "employee_id").groupBy(
        "employee_id", "full_name", "termination_date"
    ).agg(
        F.count("*").alias("total_lines"), late.alias("lines_after_term"),
        percentage(late, F.count("*"), 1).alias("pct_after_term"))


def tenure_by_status(employees: DataFrame, snapshot: Column) -> DataFrame:
    status = F.when(F.col("termination_date").isNull(), "active").otherwise("terminated")
    days = F.datediff(F.coalesce("termination_date", snapshot), "hire_date")
    return employees.groupBy(status.alias("status")).agg(
        F.count("*").alias("n"),
        F.round(F.sum(days) / F.count(days), 1).alias("avg_tenure_days"))


def repeat_purchase_pairs(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_id", "product_id").agg(F.count("*").alias("n")).where("n > 1")
