"""Reading, series, dirty data and writers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from assaymill.operators import quality
from assaymill.plans import silver
from assaymill.plans.medallion import run_medallion as build_layers
from assaymill.runtime import bounded, new_scratch_path
from assaymill.sources import retail, series, sinks
from assaymill.sources.schemas import BRONZE_SCHEMAS
from assaymill.sources.tables import inline_values as literal_table
from assaymill.sources.tables import scan_table as scan
from assaymill.sources.tables import typed_extract as extract
from catalog.model_sql import DUP, esum, q, sql
from catalog.registry import query


@query("scan_table", "SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders")
def scan_table(t):
    return t.raw("orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")


@query("bronze_schemas", sql("SELECT * FROM bronze_products"))
def bronze_schemas(t):
    path = new_scratch_path(t.spark, "bronze-products")
    sinks.create_or_replace(t.bronze_products, path)
    return scan(t.spark, path, schema=BRONZE_SCHEMAS["bronze_products"])


@query("typed_extract", sql("""
    SELECT order_id, order_line_id, quantity, TRY_CAST(order_total AS DOUBLE) AS order_total
    FROM bronze_sales"""))
def typed_extract(t):
    return extract(t.bronze_sales, StructType([
        StructField("order_id", LongType()), StructField("order_line_id", IntegerType()),
        StructField("quantity", IntegerType()), StructField("order_total", DoubleType())]))


PRIORITY_ROWS = ", ".join(f"({q(k)}, {q(v)})" for k, v in retail.PAYMENT_BY_PRIORITY.items())


@query("inline_values", f"""
    SELECT payment_method, COUNT(*) AS orders
    FROM orders JOIN (VALUES {PRIORITY_ROWS}) AS m(priority, payment_method) ON o_orderpriority = priority
    GROUP BY payment_method""")
def inline_values(t):
    methods = literal_table(t.spark, ["o_orderpriority", "payment_method"],
                            list(retail.PAYMENT_BY_PRIORITY.items()))
    joined = t.raw("orders", "o_orderpriority").join(bounded(methods), "o_orderpriority")
    return joined.groupBy("payment_method").agg(F.count("*").alias("orders"))


@query("date_spine", sql("SELECT datekey, date FROM window_days"))
def date_spine(t):
    return series.spine_over(t.order_days, "date")


@query("number_series", """
    WITH upto AS (SELECT l_orderkey, MAX(l_linenumber) AS m FROM lineitem GROUP BY l_orderkey),
         expected AS (SELECT l_orderkey, CAST(UNNEST(range(1, m + 1)) AS INTEGER) AS n FROM upto),
         present AS (SELECT DISTINCT l_orderkey, l_linenumber AS n FROM lineitem)
    SELECT n, COUNT(*) AS orders_expected, COUNT(p.l_orderkey) AS orders_present
    FROM expected e LEFT JOIN present p USING (l_orderkey, n) GROUP BY n""")
def number_series(t):
    """Line numbers 1..last of every order, and how many of them really occur."""
    lines = t.raw("lineitem", "l_orderkey", "l_linenumber")
    upto = lines.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("upto"))
    expected = series.numbers_up_to(upto, F.col("upto")).drop("upto")
    present = lines.select("l_orderkey", F.col("l_linenumber").alias("n")).distinct()
    joined = expected.join(present.withColumn("seen", F.lit(1)), ["l_orderkey", "n"], "left")
    return joined.groupBy("n").agg(
        F.count("*").alias("orders_expected"), F.count("seen").alias("orders_present"))


@query("month_spine", """
    WITH b AS (SELECT date_trunc('month', min(o_orderdate)) AS lo, max(o_orderdate) AS hi FROM orders),
         months AS (SELECT CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month_start FROM b)
    SELECT month_start, COUNT(o_orderkey) AS orders
    FROM months LEFT JOIN orders ON CAST(date_trunc('month', o_orderdate) AS DATE) = month_start
    GROUP BY month_start""")
def month_spine(t):
    bounds = t.order_days.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    months = series.month_series(bounds, F.col("lo"), F.col("hi"))
    per_month = t.order_days.groupBy(F.trunc("date", "MM").alias("month_start")).agg(
        F.count("*").alias("orders"))
    return months.join(per_month, "month_start", "left").select(
        "month_start", F.coalesce("orders", F.lit(0)).alias("orders"))


@query("power_series", """
    WITH powers AS (SELECT CAST(1 AS BIGINT) << e AS power FROM range(0, 62) AS r(e)
                    WHERE e = 0 OR (CAST(1 AS BIGINT) << (e - 1)) < (SELECT MAX(o_totalprice) FROM orders))
    SELECT power, COUNT(o_orderkey) AS orders
    FROM powers LEFT JOIN orders ON o_totalprice <= power AND o_totalprice > power / 2
    GROUP BY power""")
def power_series(t):
    """Orders by size class, the classes being powers of two up to the largest order."""
    price = F.col("o_totalprice")
    orders = t.raw("orders", "o_totalprice")
    powers = series.powers_up_to(orders.agg(F.max(price).alias("top")), F.col("top"))
    bits = F.length(F.bin(F.ceil(price) - 1))
    per_class = orders.groupBy(F.pow(F.lit(2), bits).cast("long").alias("power")).agg(
        F.count("*").alias("orders"))
    return powers.join(per_class, "power", "left").select(
        "power", F.coalesce("orders", F.lit(0)).alias("orders"))


@query("dirty_data_synth", sql("SELECT * FROM bronze_customers"))
def dirty_data_synth(t):
    return t.bronze_customers


@query("inject_orphans_and_duplicates", sql("SELECT * FROM bronze_sales"))
def inject_orphans_and_duplicates(t):
    return t.bronze_sales


@query("create_or_replace_layer", sql("SELECT * FROM silver_products"))
def create_or_replace_layer(t):
    path = new_scratch_path(t.spark, "products")
    sinks.create_or_replace(t.bronze_products.select("product_id"), path)
    return sinks.create_or_replace(silver.silver_products(t.bronze_products), path)


@query("create_or_replace_view", sql("SELECT * FROM silver_products"))
def create_or_replace_view(t):
    """A layer as a view, defined twice; the second definition is the one that counts."""
    name = f"products_{uuid.uuid4().hex}"
    sinks.create_or_replace_view(t.bronze_products.select("product_id"), name)
    return sinks.create_or_replace_view(silver.silver_products(t.bronze_products), name)


@query("publish_layer", sql("SELECT customer_id, full_name, state FROM cust WHERE state IS NOT NULL"))
def publish_layer(t):
    """A table replaced by one that is made from itself."""
    path = new_scratch_path(t.spark, "published")
    first = sinks.publish(t.customers.select("customer_id", "full_name", "state"), path)
    return sinks.publish(first.where("state IS NOT NULL"), path)


@query("create_if_absent", sql("SELECT * FROM emp"))
def create_if_absent(t):
    path = new_scratch_path(t.spark, "employees")
    sinks.create_if_absent(t.employees, path)
    return sinks.create_if_absent(t.employees.select("employee_id"), path)


@query("insert_select", sql(f"""
    SELECT customer_id, full_name, email, state, signup_date FROM cust WHERE customer_id < {DUP}
    UNION ALL
    SELECT customer_id, full_name, email, NULL, NULL FROM cust WHERE customer_id >= {DUP}"""))
def insert_select(t):
    path = new_scratch_path(t.spark, "customers")
    people = t.customers.select("customer_id", "full_name", "email", "state", "signup_date")
    sinks.create_or_replace(people.where(F.col("customer_id") < DUP), path)
    late = people.where(F.col("customer_id") >= DUP)
    return sinks.insert_select(late.select("email", "customer_id", "full_name"), path)


LAYER_COUNTS = {
    "bronze_customers": "cust", "bronze_products": "prod", "bronze_employees": "emp",
    "bronze_sales": "lines_feed", "bronze_calendar": "cal", "silver_customers": "cust",
    "silver_products": "prod", "silver_employees": "emp", "silver_calendar": "cal",
    "silver_sales": "lines_feed", "dim_customer": "cust", "dim_product": "prod",
    "dim_employee": "emp", "dim_date": "cal", "fact_sales": "lines_feed",
    "agg_monthly_sales_by_category": "monthly", "agg_customer_ltv": "cust",
    "agg_daily_sales": "cal",
}


@query("run_medallion", sql(" UNION ALL ".join(
    f"SELECT {q(name)} AS check_name, COUNT(*) AS actual FROM {source}"
    for name, source in LAYER_COUNTS.items())))
def run_medallion(t):
    layers = build_layers(t.bronze, new_scratch_path(t.spark, "layers"))
    return quality.stacked([quality.row_count(df, name) for name, df in layers.items()])


BUILT = {
    "agg_monthly_sales_by_category": (
        "monthly", ["year", "month", "month_name", "category", "total_quantity"], "total_net_amount"),
    "agg_customer_ltv": (
        "ltv", ["customer_id", "full_name", "customer_segment", "state", "order_count",
                "first_order_date", "last_order_date"], "lifetime_net_amount"),
    "agg_daily_sales": (
        "every_day", ["order_date", "year", "month", "day_name", "is_weekend"], "total_net_amount"),
}
EVERY_DAY = f"""
    SELECT date AS order_date, year, month, day_name, is_weekend, COUNT(order_line_id) AS order_line_count,
           COALESCE({esum('net_amount')}, 0) AS total_net_amount
    FROM cal LEFT JOIN fact USING (datekey) GROUP BY ALL"""


@query("build_from_raw_text", sql(" UNION ALL ".join(
    f"SELECT {q(layer)} AS layer, concat_ws('|', {', '.join(named)}) AS described, order_line_count, {amount} AS net_amount"
    f" FROM {source}" for layer, (source, named, amount) in BUILT.items()), every_day=EVERY_DAY))
def build_from_raw_text(t):
    """All five raw tables written, read by their declared schemas and built; the whole content of the rollups."""
    bronze = {}
    for name, df in t.bronze.items():
        schema = BRONZE_SCHEMAS[name]
        path = new_scratch_path(t.spark, name)
        sinks.create_or_replace(df.select(*[F.col(f.name).cast(f.dataType) for f in schema]), path)
        bronze[name] = scan(t.spark, path, schema=schema)
    layers = build_layers(bronze, new_scratch_path(t.spark, "layers"))
    return quality.stacked([
        layers[layer].select(
            F.lit(layer).alias("layer"), F.concat_ws("|", *[F.col(c).cast("string") for c in named]).alias("described"),
            "order_line_count", F.col(amount).alias("net_amount"))
        for layer, (_, named, amount) in BUILT.items()])


@query("export_csv", sql("SELECT * FROM daily"))
def export_csv(t):
    return sinks.export_csv(t.daily, new_scratch_path(t.spark, "daily-csv"))
