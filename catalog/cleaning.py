"""Cleaning functions over the raw text tables.

Where the clean value is known before the noise is added, the SQL side returns
that value instead of cleaning again.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from assaymill.functions import dates, numbers, text
from catalog.model_sql import FIXED, esum, isum, rnd, sql
from catalog.registry import query


@query("clean_name", sql("SELECT customer_id, first_name, last_name FROM cust"))
def clean_name(t):
    return t.bronze_customers.select(
        "customer_id", text.clean_name(F.col("first_name")).alias("first_name"),
        text.clean_name(F.col("last_name")).alias("last_name"))


@query("clean_email", sql("SELECT customer_id, email FROM cust"))
def clean_email(t):
    return t.bronze_customers.select("customer_id", text.clean_email(F.col("email")).alias("email"))


@query("normalize_phone", sql("SELECT customer_id, phone FROM cust"))
def normalize_phone(t):
    return t.bronze_customers.select(
        "customer_id", text.normalize_phone(F.col("phone")).alias("phone"))


@query("normalize_state", sql("SELECT customer_id, state FROM cust"))
def normalize_state(t):
    return t.bronze_customers.select(
        "customer_id", text.normalize_state(F.col("state")).alias("state"))


@query("parse_mixed_date", sql("SELECT order_id, order_line_id, order_date, ship_date FROM sales_feed"))
def parse_mixed_date(t):
    return t.bronze_sales.select(
        "order_id", "order_line_id", dates.parse_mixed_date(F.col("order_date")).alias("order_date"),
        dates.parse_mixed_date(F.col("ship_date")).alias("ship_date"))


@query("standardize_boolean", sql("SELECT customer_id, is_active FROM cust"))
def standardize_boolean(t):
    return t.bronze_customers.select(
        "customer_id", text.standardize_boolean(F.col("is_active")).alias("is_active"))


@query("standardize_category", sql("SELECT product_id, category FROM prod"))
def standardize_category(t):
    return t.bronze_products.select(
        "product_id", text.standardize_category(F.col("category")).alias("category"))


@query("standardize_segment", sql("SELECT customer_id, customer_segment FROM cust"))
def standardize_segment(t):
    return t.bronze_customers.select(
        "customer_id", text.standardize_segment(F.col("customer_segment")).alias("customer_segment"))


@query("standardize_department_region", sql("SELECT employee_id, department, region FROM emp"))
def standardize_department_region(t):
    return t.bronze_employees.select(
        "employee_id", text.standardize_department(F.col("department")).alias("department"),
        text.standardize_region(F.col("region")).alias("region"))


@query("standardize_payment_status_channel", sql("""
    SELECT order_id, order_line_id, payment_method, order_status, channel FROM sales_feed"""))
def standardize_payment_status_channel(t):
    return t.bronze_sales.select(
        "order_id", "order_line_id",
        text.standardize_payment_method(F.col("payment_method")).alias("payment_method"),
        text.standardize_order_status(F.col("order_status")).alias("order_status"),
        text.standardize_channel(F.col("channel")).alias("channel"))


@query("parse_weight", sql("SELECT product_id, weight_kg FROM prod"))
def parse_weight(t):
    return t.bronze_products.select(
        "product_id", numbers.parse_weight(F.col("weight_kg")).alias("weight_kg"))


@query("lenient_double", sql(r"""
    SELECT order_id, order_line_id, CASE WHEN order_total IS NOT NULL THEN
        COALESCE(TRY_CAST(regexp_extract(trim(order_total), '^[+-]?[0-9]+(\.[0-9]+)?') AS DOUBLE), 0) END AS order_total
    FROM bronze_sales"""))
def lenient_double(t):
    return t.bronze_sales.select(
        "order_id", "order_line_id", numbers.lenient_double(F.col("order_total")).alias("order_total"))


@query("fix_discount_pct", sql("""
    SELECT l_orderkey AS order_id, l_linenumber AS order_line_id, CAST(ROUND(l_discount * 300) AS INTEGER) / 100 AS discount_pct
    FROM lineitem"""))
def fix_discount_pct(t):
    return t.lines_feed.select(
        "order_id", "order_line_id",
        numbers.fix_discount_pct(F.col("discount_pct")).alias("discount_pct"))


@query("net_amount", sql(f"""
    SELECT order_id, order_line_id,
           {rnd(f"coalesce(quantity, 0) * unit_price * (1 - {FIXED})")} AS net_amount FROM lines_feed"""))
def net_amount(t):
    discount = numbers.fix_discount_pct(F.col("discount_pct"))
    return t.lines_feed.select("order_id", "order_line_id", numbers.net_amount(
        F.col("quantity"), F.col("unit_price"), discount).alias("net_amount"))


@query("gross_amount", sql(f"""
    SELECT order_id, order_line_id, {rnd("quantity * unit_price")} AS gross_amount FROM lines_feed"""))
def gross_amount(t):
    return t.lines_feed.select("order_id", "order_line_id", numbers.gross_amount(
        F.col("quantity"), F.col("unit_price")).alias("gross_amount"))


@query("discount_tier", sql(f"""
    SELECT CASE WHEN discount_pct >= 0.2::DOUBLE THEN 'High Discount (20%+)' WHEN discount_pct > 0 THEN 'Standard Discount'
                ELSE 'Full Price' END AS discount_tier, COUNT(*) AS order_lines, {esum('net_amount')} AS net_amount
    FROM lines GROUP BY 1"""))
def discount_tier(t):
    tier = numbers.discount_tier(F.col("discount_pct")).alias("discount_tier")
    return t.lines.groupBy(tier).agg(
        F.count("*").alias("order_lines"), numbers.money_sum(F.col("net_amount")).alias("net_amount"))


@query("coalesce_default", sql("""
    SELECT customer_id, COALESCE(customer_segment, 'Unknown') AS segment,
           CASE WHEN trim(email) <> '' THEN trim(email) ELSE 'no email' END AS email,
           CASE WHEN trim(email) <> '' THEN trim(email) WHEN trim(phone) <> '' THEN trim(phone) ELSE 'none' END AS contact
    FROM bronze_customers"""))
def coalesce_default(t):
    email, phone = F.col("email"), F.col("phone")
    return t.bronze_customers.select(
        "customer_id", F.coalesce("customer_segment", F.lit("Unknown")).alias("segment"),
        text.coalesce_default(email, "no email").alias("email"),
        text.coalesce_default(email, "none", phone).alias("contact"))


@query("safe_ratio", sql("""
    SELECT order_id, order_line_id, net_amount / NULLIF(quantity, 0) AS net_per_unit,
           COALESCE(net_amount / NULLIF(quantity, 0), 0) AS net_per_unit_or_zero FROM lines"""))
def safe_ratio(t):
    net, units = F.col("net_amount"), F.col("quantity")
    return t.lines.select(
        "order_id", "order_line_id", numbers.safe_ratio(net, units).alias("net_per_unit"),
        numbers.safe_ratio(net, units, 0.0).alias("net_per_unit_or_zero"))


@query("concat_text", sql("""
    SELECT customer_id, full_name || ' <' || email || '>' AS mailbox, state || '/' || customer_segment AS cell FROM cust"""))
def concat_text(t):
    return t.customers.select(
        "customer_id", F.concat("full_name", F.lit(" <"), "email", F.lit(">")).alias("mailbox"),
        F.concat("state", F.lit("/"), "customer_segment").alias("cell"))


@query("text_length_sum", sql(f"""
    SELECT {isum('length(category)')} AS star_chars,
           (SELECT {isum('length(category)')} FROM (SELECT DISTINCT category FROM prod)) AS snowflake_chars FROM prod"""))
def text_length_sum(t):
    per_value = t.products.groupBy("category").agg(F.count("*").alias("n"))
    return per_value.agg(
        F.sum(F.length("category") * F.col("n")).alias("star_chars"),
        F.sum(F.length("category")).cast("long").alias("snowflake_chars"))


@query("round_half_up", sql(f"""
    SELECT l_orderkey AS order_id, l_linenumber AS order_line_id, {rnd('l_extendedprice * l_discount', 1)} AS discount_amount,
           {rnd('l_extendedprice / l_quantity', 0)} AS whole_price FROM lineitem"""))
def round_half_up(t):
    price = F.col("l_extendedprice")
    return t.raw("lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("order_line_id"),
        (F.round(price * F.col("l_discount"), 1) + 0.0).alias("discount_amount"),
        F.round(price / F.col("l_quantity"), 0).alias("whole_price"))


@query("abs_diff", sql(f"""
    SELECT order_id, order_line_id, ABS({rnd('quantity * unit_price')} - net_amount) AS discount_amount FROM lines"""))
def abs_diff(t):
    gross = numbers.gross_amount(F.col("quantity"), F.col("unit_price"))
    return t.lines.select("order_id", "order_line_id", numbers.abs_diff(
        gross, F.col("net_amount")).alias("discount_amount"))


@query("runtime_type_profile", sql("""
    SELECT CASE WHEN order_total IS NULL THEN 'null' WHEN TRY_CAST(order_total AS DOUBLE) IS NOT NULL THEN 'number'
                ELSE 'text' END AS kind, COUNT(*) AS n FROM bronze_sales GROUP BY 1"""))
def runtime_type_profile(t):
    return t.bronze_sales.groupBy(text.text_kind(F.col("order_total")).alias("kind")).agg(
        F.count("*").alias("n"))


@query("normalized_key", sql("""
    SELECT lower(trim(email)) AS norm_email, COUNT(*) AS n FROM bronze_customers WHERE trim(email) <> '' GROUP BY 1"""))
def normalized_key(t):
    key = text.normalized_key(F.col("email"))
    return t.bronze_customers.groupBy(key.alias("norm_email")).agg(F.count("*").alias("n")).where(
        "norm_email <> ''")
