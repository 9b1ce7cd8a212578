"""Aggregation and grain."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaymill.functions.numbers import exact_avg, money_sum, percentage
from assaymill.operators import groups, joins, keys
from assaymill.runtime import pinned
from catalog.model_sql import esum, isum, rnd, sql
from catalog.registry import query


@query("global_aggregate", sql(f"""
    SELECT COUNT(*) AS rows_total, COUNT(quantity) AS rows_with_quantity, {isum('quantity')} AS units,
           {esum('unit_price')} / COUNT(unit_price) AS avg_price, MIN(unit_price) AS min_price,
           MAX(unit_price) AS max_price, MIN(ship_date) AS first_ship, MAX(ship_date) AS last_ship FROM lines"""))
def global_aggregate(t):
    price = F.col("unit_price")
    return t.lines.agg(
        F.count("*").alias("rows_total"), F.count("quantity").alias("rows_with_quantity"),
        F.sum("quantity").alias("units"), exact_avg(price).alias("avg_price"),
        F.min(price).alias("min_price"), F.max(price).alias("max_price"),
        F.min("ship_date").alias("first_ship"), F.max("ship_date").alias("last_ship"))


@query("count_distinct", sql("""
    SELECT COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT product_id) AS products,
           COUNT(DISTINCT (order_id, order_line_id)) AS line_keys FROM fact"""))
def count_distinct(t):
    """One distinct pass per question: nothing is expanded and no single task sees all values."""
    return joins.scalar_row(t.spark, {
        "customers": t.fact.agg(F.count_distinct("customer_id")),
        "products": t.lines.agg(F.count_distinct("product_id")),
        "line_keys": t.lines.agg(F.count_distinct("order_id", "order_line_id")),
    })


@query("group_by", sql(f"""
    SELECT channel, order_status, COUNT(*) AS order_lines, {isum('quantity')} AS units, {esum('net_amount')} AS net_amount
    FROM fact GROUP BY channel, order_status"""))
def group_by(t):
    return t.fact.groupBy("channel", "order_status").agg(
        F.count("*").alias("order_lines"), F.sum("quantity").alias("units"),
        money_sum(F.col("net_amount")).alias("net_amount"))


@query("group_by_expression", sql("""
    SELECT CASE WHEN unit_price < 2000 THEN 'low' WHEN unit_price < 10000 THEN 'middle' ELSE 'high' END AS price_band,
           upper(channel) AS channel_key, COUNT(*) AS order_lines FROM lines GROUP BY 1, 2"""))
def group_by_expression(t):
    price = F.col("unit_price")
    band = F.when(price < 2000, "low").when(price < 10000, "middle").otherwise("high")
    return t.lines.groupBy(band.alias("price_band"), F.upper("channel").alias("channel_key")).agg(
        F.count("*").alias("order_lines"))


@query("having", sql(f"""
    SELECT product_id, COUNT(*) AS order_lines, {esum('net_amount')} AS net_amount FROM lines
    WHERE quantity > 0 GROUP BY product_id HAVING COUNT(*) > 30 AND {esum('net_amount')} > 1000000"""))
def having(t):
    per_product = t.lines.where("quantity > 0").groupBy("product_id").agg(
        F.count("*").alias("order_lines"), money_sum(F.col("net_amount")).alias("net_amount"))
    return per_product.where("order_lines > 30 AND net_amount > 1000000")


@query("conditional_aggregate", sql(f"""
    SELECT channel, {isum("CASE WHEN discount_pct > 1 THEN 1 ELSE 0 END")} AS bugged_lines,
           {esum("CASE WHEN discount_pct > 1 THEN quantity * unit_price ELSE 0 END")} AS bugged_total,
           {esum("CASE WHEN discount_pct > 1 THEN 0 ELSE quantity * unit_price END")} AS normal_total
    FROM lines_feed GROUP BY channel"""))
def conditional_aggregate(t):
    bugged, gross = F.col("discount_pct") > 1, F.col("quantity") * F.col("unit_price")
    return t.lines_feed.groupBy("channel").agg(
        F.count_if(bugged).alias("bugged_lines"),
        money_sum(F.when(bugged, gross).otherwise(0)).alias("bugged_total"),
        money_sum(F.when(bugged, 0).otherwise(gross)).alias("normal_total"))


@query("percentage_of_rows", sql(f"""
    SELECT COUNT(*) AS total_rows,
           {rnd("100.0::DOUBLE * SUM(CASE WHEN employee_id IS NULL THEN 1 ELSE 0 END) / COUNT(*)")} AS pct_null_employee,
           {rnd("100.0::DOUBLE * SUM(CASE WHEN datekey IS NULL THEN 1 ELSE 0 END) / COUNT(*)")} AS pct_null_datekey,
           {rnd("100.0::DOUBLE * SUM(CASE WHEN quantity IS NULL THEN 1 ELSE 0 END) / COUNT(*)")} AS pct_null_quantity
    FROM fact"""))
def percentage_of_rows(t):
    def share(column):
        return percentage(F.count_if(F.col(column).isNull()), F.count("*"), 2)

    return t.fact.agg(
        F.count("*").alias("total_rows"), share("employee_id").alias("pct_null_employee"),
        share("datekey").alias("pct_null_datekey"), share("quantity").alias("pct_null_quantity"))


@query("weighted_average", sql(f"""
    SELECT channel, {rnd(f"{esum('discount_pct')} / COUNT(discount_pct)", 4)} AS naive_avg,
           {rnd(f"1 - {esum('net_amount')} / {esum('quantity * unit_price')}", 4)} AS weighted_avg
    FROM lines WHERE quantity > 0 GROUP BY channel"""))
def weighted_average(t):
    gross = money_sum(F.col("quantity") * F.col("unit_price"))
    return t.lines.where("quantity > 0").groupBy("channel").agg(
        F.round(exact_avg(F.col("discount_pct")), 4).alias("naive_avg"),
        F.round(1 - money_sum(F.col("net_amount")) / gross, 4).alias("weighted_avg"))


@query("two_level_aggregate", sql("""
    SELECT lines_per_order, COUNT(*) AS orders, SUM(cents)::DOUBLE / 100 AS net_amount,
           SUM(cents)::DOUBLE / 100 / COUNT(*) AS avg_order_value
    FROM (SELECT order_id, COUNT(*) AS lines_per_order, SUM(CAST(ROUND(net_amount * 100) AS BIGINT)) AS cents
          FROM lines GROUP BY order_id) GROUP BY lines_per_order"""))
def two_level_aggregate(t):
    per_order = t.lines.groupBy("order_id").agg(
        F.count("*").alias("lines_per_order"), money_sum(F.col("net_amount")).alias("order_total"))
    return per_order.groupBy("lines_per_order").agg(
        F.count("*").alias("orders"), money_sum(F.col("order_total")).alias("net_amount"),
        exact_avg(F.col("order_total")).alias("avg_order_value"))


TOTALS = f"""(SELECT employee_id, {esum('quantity * unit_price')} AS rough_total FROM lines
              WHERE employee_id IS NOT NULL GROUP BY employee_id)"""


@query("group_max_filter", sql(f"""
    SELECT employee_id, rough_total FROM {TOTALS}
    WHERE rough_total > (SELECT {esum('rough_total')} / COUNT(rough_total) FROM {TOTALS})"""))
def group_max_filter(t):
    totals = pinned(t.lines.where("employee_id IS NOT NULL").groupBy("employee_id").agg(
        money_sum(F.col("quantity") * F.col("unit_price")).alias("rough_total")))
    mean = totals.agg(exact_avg(F.col("rough_total"))).scalar()
    return totals.where(F.col("rough_total") > mean)


@query("grain_check", sql("""
    SELECT order_id, order_line_id, COUNT(*) AS n FROM lines GROUP BY ALL HAVING COUNT(*) > 1"""))
def grain_check(t):
    return keys.grain_check(t.lines, ["order_id", "order_line_id"])


GRAINS = {
    "order": ["order_id"],
    "order line": ["order_id", "order_line_id"],
    "order line product": ["order_id", "order_line_id", "product_id"],
    "order product": ["order_id", "product_id"],
}


@query("grain_report", sql(" UNION ALL ".join(
    f"SELECT '{label}' AS grain, CAST(SUM(n) AS BIGINT) AS total_rows, COUNT(*) AS distinct_keys "
    f"FROM (SELECT COUNT(*) AS n FROM lines GROUP BY {', '.join(cols)})"
    for label, cols in GRAINS.items())))
def grain_report(t):
    return keys.grain_report(t.lines, GRAINS)


@query("profile_distinct_values", sql("SELECT category AS raw_value, COUNT(*) AS n FROM bronze_products GROUP BY 1"))
def profile_distinct_values(t):
    return groups.profile_distinct_values(t.bronze_products, "category")
