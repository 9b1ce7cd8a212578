"""Silver and gold datasets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from assaymill.functions.numbers import money_sum
from assaymill.operators import joins, quality
from assaymill.plans import bi, gold, refresh, silver
from assaymill.runtime import new_scratch_path
from catalog.model_sql import datekey, esum, isum, rnd, sql
from catalog.registry import query
from catalog.sets import NEWEST, TIE


@query("silver_customers", sql("SELECT * FROM cust"))
def silver_customers(t):
    return silver.silver_customers(t.bronze_customers)


@query("silver_products", sql("SELECT * FROM silver_products"))
def silver_products(t):
    return silver.silver_products(t.bronze_products)


@query("silver_employees", sql("SELECT * FROM emp"))
def silver_employees(t):
    return silver.silver_employees(t.bronze_employees)


@query("silver_sales", sql("SELECT * FROM silver_sales"))
def silver_sales(t):
    return silver.silver_sales(t.bronze_sales, t.bronze_customers, t.bronze_products)


@query("silver_calendar", sql("SELECT datekey, date FROM cal"))
def silver_calendar(t):
    return silver.silver_calendar(t.spine)


@query("dim_customer", sql("SELECT * FROM cust"))
def dim_customer(t):
    return gold.dim_customer(silver.silver_customers(t.bronze_customers))


@query("dim_product", sql("SELECT * FROM silver_products"))
def dim_product(t):
    return gold.dim_product(silver.silver_products(t.bronze_products))


@query("dim_employee", sql("SELECT * FROM emp"))
def dim_employee(t):
    return gold.dim_employee(silver.silver_employees(t.bronze_employees))


@query("dim_date", sql("SELECT * FROM cal"))
def dim_date(t):
    return gold.dim_date(silver.silver_calendar(t.spine))


@query("fact_sales", sql(f"SELECT * EXCLUDE (order_total_raw), {datekey('order_date')} AS datekey FROM silver_sales"))
def fact_sales(t):
    return gold.fact_sales(
        silver.silver_sales(t.bronze_sales, t.bronze_customers, t.bronze_products))


@query("agg_monthly_sales_by_category", sql("SELECT * FROM monthly"))
def agg_monthly_sales_by_category(t):
    return t.monthly


@query("agg_customer_ltv", sql("SELECT * FROM ltv"))
def agg_customer_ltv(t):
    return t.ltv


@query("agg_daily_sales", sql("SELECT * FROM daily"))
def agg_daily_sales(t):
    return t.daily


@query("agg_quarterly_by_category", sql(f"""
    SELECT year, quarter, category, COUNT(*) AS order_line_count, {isum('quantity')} AS total_quantity,
           {esum('net_amount')} AS total_net_amount
    FROM fact JOIN cal USING (datekey) JOIN prod USING (product_id) GROUP BY year, quarter, category"""))
def agg_quarterly_by_category(t):
    return gold.agg_quarterly_by_category(t.fact, t.calendar, t.products)


def _slice_sql(label: str, column: str, joined: str) -> str:
    return (f"SELECT '{label}' AS dimension, {column} AS member, year, COUNT(*) AS order_line_count, "
            f"{isum('quantity')} AS total_quantity, {esum('net_amount')} AS total_net_amount "
            f"FROM fact JOIN cal USING (datekey) {joined} GROUP BY {column}, year")


@query("sales_by_dimension", sql(" UNION ALL ".join([
    _slice_sql("channel", "channel", ""),
    _slice_sql("payment_method", "payment_method", ""),
    _slice_sql("region", "region", "JOIN emp USING (employee_id)"),
    _slice_sql("brand", "brand", "JOIN prod USING (product_id)"),
    _slice_sql("subcategory", "subcategory", "JOIN prod USING (product_id)"),
])))
def sales_by_dimension(t):
    return gold.sales_by_attributes(
        t.fact, t.calendar,
        [(t.employees.select("employee_id", "region"), "employee_id"),
         (t.products.select("product_id", "brand", "subcategory"), "product_id")],
        {"channel": None, "payment_method": None, "region": "employee_id", "brand": "product_id",
         "subcategory": "product_id"})


@query("rollup_reconciliation", sql("""
    SELECT (SELECT COUNT(*) FROM fact) AS fact_rows,
           (SELECT CAST(SUM(order_line_count) AS BIGINT) FROM monthly) AS rolled_up_rows,
           (SELECT COUNT(*) FROM fact f WHERE datekey IS NULL
            OR NOT EXISTS (SELECT 1 FROM prod p WHERE p.product_id = f.product_id)) AS excluded_rows"""))
def rollup_reconciliation(t):
    fact = joins.flag_orphans(t.fact, "product_id", t.products, "is_product_orphan")
    excluded = F.col("datekey").isNull() | (F.col("is_product_orphan") == 1)
    rolled_up = t.monthly.agg(F.sum("order_line_count")).scalar()
    return fact.agg(
        F.count("*").alias("fact_rows"), F.count_if(excluded).alias("excluded_rows")
    ).withColumn("rolled_up_rows", rolled_up)


@query("snowflake_normalize", sql(f"""
    SELECT dense_rank() OVER (ORDER BY category) AS category_id, category, COUNT(*) AS order_lines,
           {esum('net_amount')} AS net_amount
    FROM lines JOIN prod USING (product_id) WHERE category IS NOT NULL GROUP BY category"""))
def snowflake_normalize(t):
    slim, categories = bi.snowflake_normalize(t.products, "category", "product_id", "category_id")
    sold = t.lines.join(slim, "product_id").groupBy("category_id").agg(
        F.count("*").alias("order_lines"), money_sum(F.col("net_amount")).alias("net_amount"))
    return sold.join(categories, "category_id")


FLAT = f"""
    SELECT f.order_id, f.order_line_id, f.order_date, c.full_name AS customer_name, c.customer_segment,
           c.state AS customer_state, p.product_name, p.category AS product_category, p.brand AS product_brand,
           e.full_name AS sales_rep_name, e.region AS sales_region, f.quantity, f.unit_price, f.discount_pct,
           {rnd('f.quantity * f.unit_price')} AS gross_amount, f.net_amount,
           CASE WHEN f.discount_pct >= 0.2::DOUBLE THEN 'High Discount (20%+)' WHEN f.discount_pct > 0 THEN 'Standard Discount'
                ELSE 'Full Price' END AS discount_tier, f.payment_method, f.order_status, f.channel
    FROM ({NEWEST}) f LEFT JOIN cust c USING (customer_id) LEFT JOIN prod p USING (product_id)
    LEFT JOIN emp e USING (employee_id)"""


@query("flat_sales_all", sql(FLAT))
def flat_sales_all(t):
    return bi.flat_sales_all(t.fact, t.customers, t.products, t.employees, TIE)


@query("flat_sales_completed", sql(f"""
    SELECT f.order_id, f.order_line_id, f.order_date, c.full_name AS customer_name, p.product_name,
           p.category AS product_category, f.quantity, f.net_amount, f.channel
    FROM ({NEWEST.replace('FROM fact', "FROM fact WHERE order_status = 'Completed'")}) f
    LEFT JOIN cust c USING (customer_id) LEFT JOIN prod p USING (product_id)"""))
def flat_sales_completed(t):
    return bi.flat_sales_completed(t.fact, t.customers, t.products, TIE)


STAR_SIZES = {
    "fact_sales": "SELECT COUNT(*) FROM newest",
    "dim_customer": "SELECT COUNT(DISTINCT customer_id) FROM cust WHERE customer_id IN (SELECT customer_id FROM newest)",
    "dim_product": "SELECT COUNT(DISTINCT product_id) FROM prod WHERE product_id IN (SELECT product_id FROM newest)",
    "dim_employee": "SELECT COUNT(DISTINCT employee_id) FROM emp WHERE employee_id IN (SELECT employee_id FROM newest)",
    "dim_date": "SELECT COUNT(DISTINCT datekey) FROM cal WHERE datekey IN (SELECT datekey FROM newest)",
}


def _star(t):
    return bi.star_extract(t.fact, t.customers, t.products, t.employees, t.calendar, TIE)


@query("star_extract", sql(f"""
    SELECT order_id, order_line_id, customer_id, product_id, employee_id, datekey, quantity, unit_price,
           discount_pct, net_amount, payment_method, order_status, channel FROM ({NEWEST})"""))
def star_extract(t):
    return _star(t)["fact_sales"]


@query("star_extract_sizes", sql(" UNION ALL ".join(
    f"SELECT '{name}' AS check_name, ({count}) AS actual" for name, count in STAR_SIZES.items()),
    newest=NEWEST))
def star_extract_sizes(t):
    return quality.stacked([quality.row_count(df, name) for name, df in _star(t).items()])


# The columns of the extract's dimensions are its contract.
STAR_DIMS = {
    "dim_customer": ("cust", "customer_id", "customer_id, full_name, email, state, customer_segment"),
    "dim_product": ("prod", "product_id", "product_id, product_name, category, subcategory, brand, unit_cost, unit_price"),
    "dim_employee": ("emp", "employee_id", "employee_id, full_name, department, region"),
    "dim_date": ("cal", "datekey", "datekey, date, year, month, month_name, quarter, day_name, is_weekend"),
}


def _register_star(name: str, source: str, key: str, columns: str) -> None:
    statement = sql(f"SELECT DISTINCT {columns} FROM {source} WHERE {key} IN (SELECT {key} FROM newest)", newest=NEWEST)
    query(f"star_extract_{name}", statement)(lambda t: _star(t)[name])


for _name, _parts in STAR_DIMS.items():
    _register_star(_name, *_parts)


LATE_FROM = dt.date(2001, 6, 10)


def _refreshed(t) -> str:
    """Kept totals of most lines, then three batches of late ones that meet known days, orders and customers."""
    path = new_scratch_path(t.spark, "kept")
    batch = F.when(F.col("order_date") >= LATE_FROM, F.pmod(F.col("order_id") * 7 + F.col("order_line_id"), F.lit(5)))
    # Lines meet their orders once; the first load and every batch read them back.
    lines = t.written("refresh_lines", t.fact.select(
        "order_id", "order_line_id", "customer_id", "product_id", "order_date", "datekey", "quantity", "net_amount"))
    refresh.start(path, lines.where(F.coalesce(batch, F.lit(3)) > 2), t.products)
    for k in range(3):
        refresh.add(path, lines.where(batch == k), t.products)
    return path


@query("refreshed_monthly", sql("SELECT * FROM monthly"))
def refreshed_monthly(t):
    return refresh.monthly_by_category(t.spark, _refreshed(t), t.calendar)


@query("refreshed_daily", sql("SELECT * FROM daily"))
def refreshed_daily(t):
    return refresh.daily(t.spark, _refreshed(t), t.sales_days)


@query("refreshed_ltv", sql("SELECT * FROM ltv"))
def refreshed_ltv(t):
    return refresh.customer_ltv(t.spark, _refreshed(t), t.customers)
