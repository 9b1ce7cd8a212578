"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaymill.functions import dates, text
from assaymill.functions.numbers import money_sum
from assaymill.operators import intervals, joins
from assaymill.plans import gold, silver
from assaymill.runtime import pinned
from catalog.model_sql import datekey, esum, sql
from catalog.registry import query


@query("inner_join", sql("""
    SELECT order_id, order_line_id, product_id, product_name, category FROM lines JOIN prod USING (product_id)"""))
def inner_join(t):
    products = t.products.select("product_id", "product_name", "category")
    return t.lines.select("order_id", "order_line_id", "product_id").join(products, "product_id")


@query("multi_way_star_join", sql("""
    SELECT f.order_id, f.order_line_id, c.full_name AS customer_name, p.product_name, e.full_name AS rep_name,
           d.year, d.month_name, f.net_amount
    FROM fact f JOIN cust c ON c.customer_id = f.customer_id JOIN prod p ON p.product_id = f.product_id
    JOIN emp e ON e.employee_id = f.employee_id JOIN cal d ON d.datekey = f.datekey"""))
def multi_way_star_join(t):
    dims = [
        (t.calendar.select("datekey", "year", "month_name"), "datekey"),
        (t.employees.select("employee_id", F.col("full_name").alias("rep_name")), "employee_id"),
        (t.products.select("product_id", "product_name"), "product_id"),
        (t.customers.select("customer_id", F.col("full_name").alias("customer_name")), "customer_id"),
    ]
    return joins.star_join(t.fact, dims).select(
        "order_id", "order_line_id", "customer_name", "product_name", "rep_name", "year",
        "month_name", "net_amount")


@query("left_join", sql("""
    SELECT f.order_id, f.order_line_id, c.full_name AS customer_name, c.customer_segment
    FROM fact f LEFT JOIN cust c ON c.customer_id = f.customer_id"""))
def left_join(t):
    people = t.customers.select(
        "customer_id", F.col("full_name").alias("customer_name"), "customer_segment")
    return t.fact.join(people, "customer_id", "left").select(
        "order_id", "order_line_id", "customer_name", "customer_segment")


@query("anti_join_is_null", sql("""
    SELECT l.order_id, l.order_line_id, l.product_id FROM lines l
    LEFT JOIN prod p ON p.product_id = l.product_id WHERE p.product_id IS NULL"""))
def anti_join_is_null(t):
    return joins.anti_join(t.lines, t.products, "product_id").select(
        "order_id", "order_line_id", "product_id")


@query("not_exists_anti", sql("""
    SELECT customer_id, full_name FROM cust c
    WHERE NOT EXISTS (SELECT 1 FROM headers h WHERE h.customer_id = c.customer_id)"""))
def not_exists_anti(t):
    return joins.anti_join(t.customers, t.headers, "customer_id", many=True).select("customer_id", "full_name")


@query("exists_semi", sql("""
    SELECT customer_id, full_name FROM cust c
    WHERE EXISTS (SELECT 1 FROM headers h WHERE h.customer_id = c.customer_id AND h.order_status = 'Returned')"""))
def exists_semi(t):
    returned = t.headers.where("order_status = 'Returned'")
    return joins.semi_join(t.customers, returned, "customer_id", many=True).select("customer_id", "full_name")


@query("in_subquery_semi", sql("""
    SELECT customer_id, full_name, customer_segment FROM cust WHERE customer_id IN (
        SELECT customer_id FROM headers WHERE order_id IN (
            SELECT order_id FROM lines WHERE product_id IN (
                SELECT product_id FROM prod WHERE category = 'Climbing' AND unit_price > 995)))"""))
def in_subquery_semi(t):
    climbing = t.products.where("category = 'Climbing' AND unit_price > 995")
    lines = joins.semi_join(t.lines, climbing, "product_id")
    orders = joins.semi_join(t.headers, lines, "order_id", many=True)
    return joins.semi_join(t.customers, orders, "customer_id", many=True).select(
        "customer_id", "full_name", "customer_segment")


@query("not_in_null_aware", sql("""
    SELECT 'with null' AS form, COUNT(*) AS reps FROM emp
    WHERE employee_id NOT IN (SELECT employee_id FROM lines WHERE quantity < 0)
    UNION ALL
    SELECT 'without null', COUNT(*) FROM emp
    WHERE employee_id NOT IN (SELECT employee_id FROM lines WHERE quantity < -49 AND employee_id IS NOT NULL)"""))
def not_in_null_aware(t):
    """A NULL in the list empties the result; the list without it gives the answer meant."""
    trap = joins.not_in(t.employees, "employee_id", t.lines.where("quantity < 0"))
    few = t.lines.where("quantity < -49 AND employee_id IS NOT NULL")
    safe = joins.not_in(t.employees, "employee_id", few)
    return trap.agg(F.lit("with null").alias("form"), F.count("*").alias("reps")).unionByName(
        safe.agg(F.lit("without null").alias("form"), F.count("*").alias("reps")))


@query("self_join_pairs", sql("""
    SELECT first_id AS orig_id, first_email AS orig_email, customer_id AS dup_id, email AS dup_email
    FROM (SELECT customer_id, email, MIN(customer_id) OVER w AS first_id, ARG_MIN(email, customer_id) OVER w AS first_email
          FROM bronze_customers WHERE trim(email) <> '' WINDOW w AS (PARTITION BY lower(trim(email))))
    WHERE customer_id > first_id"""))
def self_join_pairs(t):
    return joins.duplicate_pairs(
        t.bronze_customers, text.normalized_key(F.col("email")), "customer_id", ["email"])


@query("point_in_time_join", sql("""
    SELECT f.order_id, f.order_line_id, f.employee_id, f.order_date, e.hire_date, e.termination_date
    FROM fact f JOIN emp e ON e.employee_id = f.employee_id
    WHERE f.order_date >= e.hire_date AND f.order_date <= COALESCE(e.termination_date, DATE '9999-12-31')"""))
def point_in_time_join(t):
    terms = t.employees.select("employee_id", "hire_date", "termination_date")
    sold = t.fact.select("order_id", "order_line_id", "employee_id", "order_date")
    return intervals.point_in_time_join(
        sold, terms, "employee_id", "order_date", "hire_date", "termination_date")


@query("post_validity_detector", sql("""
    SELECT f.order_id, f.order_line_id, f.order_date, f.employee_id, e.full_name, e.termination_date
    FROM fact f JOIN emp e ON e.employee_id = f.employee_id WHERE f.order_date > e.termination_date"""))
def post_validity_detector(t):
    people = t.employees.select("employee_id", "full_name", "termination_date")
    sold = t.fact.select("order_id", "order_line_id", "order_date", "employee_id")
    return joins.after_validity(sold, people, "employee_id", "order_date", "termination_date")


@query("scalar_cross_join", sql("""
    SELECT customer_id, full_name, lifetime_net_amount, avg_ltv FROM ltv,
        (SELECT SUM(CAST(ROUND(lifetime_net_amount * 100) AS BIGINT))::DOUBLE / 100 / COUNT(*) AS avg_ltv FROM ltv)
    WHERE lifetime_net_amount > 2 * avg_ltv"""))
def scalar_cross_join(t):
    amount = F.col("lifetime_net_amount")
    people = pinned(t.ltv.select("customer_id", "full_name", "lifetime_net_amount"))
    beside = joins.with_overall(people, {"avg_ltv": money_sum(amount) / F.count("*")})
    return beside.where(amount > 2 * F.col("avg_ltv"))


@query("filtered_left_join", sql("""
    SELECT d.date, COUNT(f.order_line_id) AS lines FROM window_days d
    LEFT JOIN fact f ON f.datekey = d.datekey AND f.product_id IN (SELECT product_id FROM prod WHERE category = 'Accessories')
    GROUP BY d.date"""))
def filtered_left_join(t):
    chosen = joins.semi_join(t.fact, t.products.where("category = 'Accessories'"), "product_id")
    per_day = chosen.groupBy("datekey").agg(F.count("order_line_id").alias("lines"))
    return t.sales_days.join(per_day, "datekey", "left").select(
        "date", F.coalesce("lines", F.lit(0)).alias("lines"))


@query("role_playing_date_join", sql(f"""
    SELECT f.order_id, f.order_line_id, f.ship_date, d.day_name AS ship_day_name, d.quarter AS ship_quarter
    FROM lines f JOIN cal d ON {datekey('f.ship_date')} = d.datekey"""))
def role_playing_date_join(t):
    shipped = t.lines.select("order_id", "order_line_id", "ship_date",
                             dates.date_key(F.col("ship_date")).alias("datekey"))
    days = t.calendar.select("datekey", F.col("day_name").alias("ship_day_name"),
                             F.col("quarter").alias("ship_quarter"))
    return shipped.join(days, "datekey").drop("datekey")


def _per_line_sql(table: str, layer: str, where: str = "") -> str:
    return (f"SELECT order_id, order_line_id, COUNT(*) AS {layer}_lines, MAX(discount_pct) AS {layer}_discount "
            f"FROM {table} {where} GROUP BY 1, 2")


@query("recon_join_layers", sql(f"""
    SELECT b.*, silver_lines, silver_discount, gold_lines, gold_discount
    FROM ({_per_line_sql('bronze_sales', 'bronze')}) b
    LEFT JOIN ({_per_line_sql('silver_sales', 'silver')}) s USING (order_id, order_line_id)
    LEFT JOIN ({_per_line_sql('flagged_fact', 'gold')}) g USING (order_id, order_line_id)
    WHERE bronze_discount > 1"""))
def recon_join_layers(t):
    """Line keys with whole-number discounts, as the three layers of one build show them.

    A line key may repeat, so each layer is counted per key before the layers meet:
    a line that a layer lost or repeated shows in the counts.
    """
    lines = silver.silver_sales(t.bronze_sales, t.bronze_customers, t.bronze_products)
    grain = ["order_id", "order_line_id"]

    def per_line(df, layer):
        return df.groupBy(*grain).agg(
            F.count("*").alias(f"{layer}_lines"), F.max("discount_pct").alias(f"{layer}_discount"))

    bronze = per_line(t.bronze_sales, "bronze").where("bronze_discount > 1")
    return bronze.join(per_line(lines, "silver"), grain, "left").join(
        per_line(gold.fact_sales(lines), "gold"), grain, "left")


@query("join_match_counts", sql(f"""
    SELECT CASE WHEN p.product_id IS NULL THEN 'orphan' ELSE 'matched' END AS match_status, COUNT(*) AS n,
           {esum('quantity * l.unit_price')} AS rough_total
    FROM lines l LEFT JOIN prod p ON p.product_id = l.product_id GROUP BY 1"""))
def join_match_counts(t):
    rough = money_sum(F.col("quantity") * F.col("unit_price")).alias("rough_total")
    return joins.match_status(
        t.lines, t.products, "product_id", [F.count("*").alias("n"), rough])
