"""Sort, limit, set operations and subqueries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from assaymill.functions import text
from assaymill.functions.numbers import exact_avg, money_sum
from assaymill.operators import groups, joins, ordered
from assaymill.plans import analytics, bi
from assaymill.sources.tables import inline_values
from catalog.model_sql import esum, q, sql
from catalog.registry import query

TIE = ["product_id", "quantity", "ship_date", "unit_price"]


@query("sort_multi", sql("SELECT customer_id, customer_segment, state, signup_date FROM cust"))
def sort_multi(t):
    people = t.customers.select("customer_id", "customer_segment", "state", "signup_date")
    return people.orderBy(F.col("customer_segment").asc(), F.col("signup_date").desc(), "customer_id")


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k(t):
    orders = t.raw("orders", "o_orderkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@query("limit_offset", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 20")
def limit_offset(t):
    orders = t.raw("orders", "o_orderkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").offset(20).limit(10)


@query("deep_page", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate FROM lineitem
    ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity LIMIT 500 OFFSET 40000""")
def deep_page(t):
    """A page far down: only the slices that hold it are sorted."""
    lines = t.raw("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    order = [ordered.descending("l_shipdate"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    return ordered.page(lines, order, 40_000, 500)


@query("union_all", sql("""
    SELECT 'customer' AS kind, customer_id AS id, full_name FROM cust
    UNION ALL SELECT 'employee', employee_id, full_name FROM emp"""))
def union_all(t):
    people = t.customers.select(F.lit("customer").alias("kind"), F.col("customer_id").alias("id"), "full_name")
    staff = t.employees.select(F.lit("employee").alias("kind"), F.col("employee_id").alias("id"), "full_name")
    return people.unionByName(staff)


@query("union_distinct", sql("SELECT full_name FROM cust UNION SELECT full_name FROM emp"))
def union_distinct(t):
    return t.customers.select("full_name").unionByName(t.employees.select("full_name")).distinct()


@query("intersect", sql("""
    SELECT customer_id FROM headers WHERE order_status = 'Returned'
    INTERSECT SELECT customer_id FROM headers WHERE order_status = 'Cancelled'"""))
def intersect(t):
    buyers = t.headers.select("customer_id", "order_status")
    returned = buyers.where("order_status = 'Returned'").select("customer_id")
    return returned.intersect(buyers.where("order_status = 'Cancelled'").select("customer_id"))


CANONICAL = sorted(set(text.CATEGORIES.values()))


@query("except_unmapped", sql(f"""
    SELECT lower(trim(replace(category, '  ', ' '))) AS category_key FROM bronze_products
    EXCEPT SELECT * FROM (VALUES {", ".join(f"({q(c.lower())})" for c in CANONICAL)})"""))
def except_unmapped(t):
    """Category spellings that are not a canonical name."""
    raw = t.bronze_products.select(text.normalized_key(
        F.replace("category", F.lit("  "), F.lit(" "))).alias("category_key"))
    names = inline_values(t.spark, ["category_key"], [(c.lower(),) for c in CANONICAL])
    return raw.subtract(names)


@query("scalar_subquery_filter", sql(f"""
    SELECT product_id, product_name, unit_price FROM prod
    WHERE unit_price > (SELECT {esum('unit_price')} / COUNT(unit_price) FROM prod)"""))
def scalar_subquery_filter(t):
    goods = t.products.select("product_id", "product_name", "unit_price")
    return goods.where(F.col("unit_price") > goods.agg(exact_avg(F.col("unit_price"))).scalar())


@query("correlated_group_average", sql(f"""
    SELECT product_id, category, unit_price FROM prod p
    WHERE unit_price > (SELECT {esum('p2.unit_price')} / COUNT(p2.unit_price) FROM prod p2 WHERE p2.category = p.category)"""))
def correlated_group_average(t):
    goods = t.products.select("product_id", "category", "unit_price").where("category IS NOT NULL")
    beside = groups.with_group_value(
        goods, ["category"], exact_avg(F.col("unit_price")), "mean")
    return beside.where("unit_price > mean").drop("mean")


@query("correlated_max_equals", sql("""
    SELECT year, category, year_revenue FROM category_year c
    WHERE year_revenue = (SELECT MAX(year_revenue) FROM category_year c2 WHERE c2.year = c.year)"""))
def correlated_max_equals(t):
    """A window over one row per year and category, so the rollup is computed once."""
    best = F.max("year_revenue").over(Window.partitionBy("year"))
    return analytics.category_years(t.monthly).withColumn("best", best).where(
        "year_revenue = best").drop("best")


@query("correlated_count_column", sql("""
    SELECT customer_id, full_name, (SELECT COUNT(*) FROM headers h WHERE h.customer_id = c.customer_id) AS orders FROM cust c"""))
def correlated_count_column(t):
    return joins.count_from(
        t.customers.select("customer_id", "full_name"), t.headers, "customer_id", "orders")


@query("derived_table_filter", sql("""
    SELECT * FROM (SELECT customer_id, COUNT(DISTINCT category) AS categories FROM fact JOIN prod USING (product_id)
                   GROUP BY customer_id) WHERE categories >= 6"""))
def derived_table_filter(t):
    bought = t.fact.select("customer_id", "product_id").join(
        t.products.select("product_id", "category"), "product_id")
    spread = bought.select("customer_id", "category").distinct().groupBy("customer_id").agg(
        F.count("category").alias("categories"))
    return spread.where("categories >= 6")


@query("cte_pipeline", sql(f"""
    SELECT employee_id, full_name, department, line_count FROM emp
    JOIN (SELECT employee_id, COUNT(*) AS line_count FROM lines GROUP BY 1) USING (employee_id)
    WHERE is_manager = 1 AND line_count > 500"""))
def cte_pipeline(t):
    managers = t.employees.where("is_manager = 1").select("employee_id", "full_name", "department")
    per_rep = t.lines.groupBy("employee_id").agg(F.count("*").alias("line_count"))
    return managers.join(per_rep.where("line_count > 500"), "employee_id")


@query("scalar_counts_row", sql(f"""
    SELECT (SELECT COUNT(*) FROM lines) AS order_lines, (SELECT COUNT(*) FROM cust) AS customers,
           (SELECT COUNT(*) FROM prod) AS products, (SELECT COUNT(*) FROM emp) AS employees,
           (SELECT {esum('net_amount')} FROM lines) AS net_amount"""))
def scalar_counts_row(t):
    sides = {"order_lines": t.lines, "customers": t.customers, "products": t.products,
             "employees": t.employees}
    counts = {n: df.agg(F.count("*")) for n, df in sides.items()}
    return joins.scalar_row(
        t.spark, {**counts, "net_amount": t.lines.agg(money_sum(F.col("net_amount")))})


NEWEST = "SELECT * FROM fact ORDER BY order_date DESC NULLS LAST, order_id, order_line_id, product_id, quantity NULLS FIRST, ship_date NULLS FIRST, unit_price LIMIT 100"


@query("fact_scoped_dimension", sql(f"""
    SELECT DISTINCT customer_id, full_name, email, state, customer_segment FROM cust
    WHERE customer_id IN (SELECT customer_id FROM ({NEWEST}))"""))
def fact_scoped_dimension(t):
    return bi.scoped_dimension(t.customers, bi.newest(t.fact, TIE), "customer_id", [
        "customer_id", "full_name", "email", "state", "customer_segment"])
