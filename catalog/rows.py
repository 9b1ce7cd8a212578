"""Projection, filters and CASE."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.model_sql import sql
from catalog.registry import query


@query("project_columns", """
    SELECT l_orderkey AS order_id, l_linenumber AS order_line_id, l_quantity AS units,
           l_extendedprice * (1 - l_discount) AS discounted_price FROM lineitem""")
def project_columns(t):
    return t.raw("lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("order_line_id"),
        F.col("l_quantity").alias("units"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("discounted_price"))


@query("filter_compare", """
    SELECT p_partkey, p_name, p_brand, p_retailprice FROM part
    WHERE p_retailprice >= 930 AND p_size < 30 AND p_size > 2 AND p_brand != 'Brand#1'
      AND p_type = 'PROMO' AND p_name <= 'small'""")
def filter_compare(t):
    price, size = F.col("p_retailprice"), F.col("p_size")
    return t.raw("part").where(
        (price >= 930) & (size < 30) & (size > 2) & (F.col("p_brand") != "Brand#1")
        & (F.col("p_type") == "PROMO") & (F.col("p_name") <= "small")
    ).select("p_partkey", "p_name", "p_brand", "p_retailprice")


@query("filter_and_or", """
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE (o_orderstatus = 'F' AND o_totalprice > 200000) OR (o_orderpriority = '1-URGENT' AND NOT o_orderstatus = 'O')""")
def filter_and_or(t):
    status, urgent = F.col("o_orderstatus"), F.col("o_orderpriority") == "1-URGENT"
    return t.raw("orders").where(
        ((status == "F") & (F.col("o_totalprice") > 200000)) | (urgent & ~(status == "O"))
    ).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("filter_in_list", sql("""
    SELECT customer_id, customer_segment, state FROM cust
    WHERE customer_segment IN ('Retail', 'VIP') AND (state NOT IN ('CA', 'NY', 'TX') OR state IS NULL)"""))
def filter_in_list(t):
    state = F.col("state")
    return t.customers.where(
        F.col("customer_segment").isin("Retail", "VIP")
        & (~state.isin("CA", "NY", "TX") | state.isNull())
    ).select("customer_id", "customer_segment", "state")


def _midnight(day: str):
    """A literal without a zone, like the stored column: no session zone shifts the comparison."""
    return F.lit(f"{day} 00:00:00").cast("timestamp_ntz")


@query("filter_between", """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderdate BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' AND o_totalprice BETWEEN 100000 AND 300000""")
def filter_between(t):
    return t.raw("orders").where(
        F.col("o_orderdate").between(_midnight("1996-01-01"), _midnight("1996-12-31"))
        & F.col("o_totalprice").between(100000, 300000)
    ).select("o_orderkey", "o_custkey", "o_totalprice")


@query("filter_null", sql("""
    SELECT order_id, order_line_id, product_id, ship_date FROM lines_feed
    WHERE quantity IS NULL AND ship_date IS NOT NULL"""))
def filter_null(t):
    return t.lines_feed.where(F.col("quantity").isNull() & F.col("ship_date").isNotNull()).select(
        "order_id", "order_line_id", "product_id", "ship_date")


@query("filter_like", """
    SELECT p_partkey, p_name, CAST(p_name ILIKE 'RED%' AS INTEGER) AS is_prefix,
           CAST(p_name ILIKE '%BOLT' AS INTEGER) AS is_suffix, CAST(p_name ILIKE '%ge%' AS INTEGER) AS is_inside,
           CAST(p_name ILIKE '_LUE %' AS INTEGER) AS is_wildcard
    FROM part WHERE p_name ILIKE 'RED%' OR p_name ILIKE '%BOLT' OR p_name ILIKE '%ge%' OR p_name ILIKE '_LUE %'""")
def filter_like(t):
    masks = {"is_prefix": "RED%", "is_suffix": "%BOLT", "is_inside": "%ge%", "is_wildcard": "_LUE %"}
    name = F.col("p_name")
    flags = [name.ilike(m).cast("int").alias(n) for n, m in masks.items()]
    return t.raw("part").select("p_partkey", "p_name", *flags).where(
        F.greatest(*[F.col(n) for n in masks]) == 1)


@query("filter_glob_digits", sql("""
    SELECT customer_id, phone FROM bronze_customers
    WHERE regexp_full_match(phone, '[0-9]{10}') OR phone GLOB 'unlist*'"""))
def filter_glob_digits(t):
    phone = F.col("phone")
    return t.bronze_customers.where(
        phone.rlike(r"^[0-9]{10}$") | phone.startswith("unlist")).select("customer_id", "phone")


@query("filter_date_range_sargable", """
    SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1997""")
def filter_date_range_sargable(t):
    """Half-open range on the stored column, so row groups outside 1997 are skipped."""
    day = F.col("o_orderdate")
    return t.raw("orders").where(
        (day >= _midnight("1997-01-01")) & (day < _midnight("1998-01-01"))
    ).select("o_orderkey", "o_totalprice")


@query("case_searched", """
    SELECT p_partkey, CASE WHEN p_retailprice < 930 THEN 'Budget' WHEN p_retailprice < 970 THEN 'Mid'
                           ELSE 'Premium' END AS price_band FROM part""")
def case_searched(t):
    price = F.col("p_retailprice")
    band = F.when(price < 930, "Budget").when(price < 970, "Mid").otherwise("Premium")
    return t.raw("part").select("p_partkey", band.alias("price_band"))


@query("case_simple_map", sql("SELECT order_id, payment_method, order_status FROM headers"))
def case_simple_map(t):
    return t.headers.select("order_id", "payment_method", "order_status")


@query("order_by_case", sql("""
    SELECT COALESCE(order_status, 'Unknown') AS status, COUNT(*) AS orders FROM headers GROUP BY 1
    ORDER BY CASE status WHEN 'Completed' THEN 0 WHEN 'Returned' THEN 1 WHEN 'Cancelled' THEN 2 ELSE 3 END"""))
def order_by_case(t):
    status = F.coalesce("order_status", F.lit("Unknown")).alias("status")
    counts = t.headers.groupBy(status).agg(F.count("*").alias("orders"))
    rank = F.when(F.col("status") == "Completed", 0).when(F.col("status") == "Returned", 1).when(
        F.col("status") == "Cancelled", 2).otherwise(3)
    return counts.orderBy(rank)


@query("select_distinct", sql("SELECT DISTINCT category, subcategory, brand FROM prod"))
def select_distinct(t):
    return t.products.select("category", "subcategory", "brand").distinct()
