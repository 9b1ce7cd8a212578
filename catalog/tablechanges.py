"""Upserts, slowly changing dimensions, updates, deletes and schema changes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from assaymill.functions.numbers import nearest_cent
from assaymill.operators import changes, keymap
from assaymill.runtime import new_scratch_path
from assaymill.sources import sinks
from catalog.model_sql import DUP, sql
from catalog.registry import query

AS_OF = dt.date(2000, 7, 1)


def _changed_products(t):
    """Tomorrow's price list: Footwear costs more, one brand is listed under new ids,
    another is no longer listed."""
    price = F.col("unit_price") * F.when(F.col("category") == "Footwear", 1.1).otherwise(1.0)
    moved = F.when(F.col("brand") == "Brand#7", F.col("product_id") + DUP)
    return t.products.where("brand <> 'Brand#13'").select(
        moved.otherwise(F.col("product_id")).alias("product_id"), "product_name", "brand",
        nearest_cent(price).alias("unit_price"))


CHANGED = f"""
    SELECT CASE WHEN brand = 'Brand#7' THEN product_id + {DUP} ELSE product_id END AS product_id, product_name, brand,
           floor(unit_price * CASE WHEN category = 'Footwear' THEN 1.1::DOUBLE ELSE 1.0::DOUBLE END * 100 + 0.5::DOUBLE) / 100 AS unit_price
    FROM prod WHERE brand <> 'Brand#13'"""


@query("scd1_upsert", sql("""
    SELECT product_id, product_name, brand, unit_price FROM changed
    UNION ALL SELECT product_id, product_name, brand, unit_price FROM prod
    WHERE product_id NOT IN (SELECT product_id FROM changed)""", changed=CHANGED))
def scd1_upsert(t):
    current = t.products.select("product_id", "product_name", "brand", "unit_price")
    return changes.scd1_upsert(current, _changed_products(t), "product_id")


@query("upsert_in_folders", sql("""
    SELECT product_id, product_name, brand, unit_price FROM changed WHERE brand = 'Brand#7'
    UNION ALL SELECT product_id, product_name, brand, unit_price FROM prod
    WHERE product_id NOT IN (SELECT product_id FROM changed WHERE brand = 'Brand#7')""", changed=CHANGED))
def upsert_in_folders(t):
    """The same upsert into a table in hash folders, of which only those with a changed key are rewritten."""
    path = new_scratch_path(t.spark, "products")
    sinks.write_folders(t.products.select("product_id", "product_name", "brand", "unit_price"), path, "product_id", 16)
    updates = _changed_products(t).where("brand = 'Brand#7'")
    return sinks.merge_folders(path, updates, "product_id", 16,
                               lambda rows, new: changes.scd1_upsert(rows, new, "product_id"))


@query("scd2_window_view", sql("""
    SELECT employee_id, hire_date, termination_date, hire_date AS valid_from,
           COALESCE(termination_date, DATE '9999-12-31') AS valid_to,
           CASE WHEN termination_date IS NULL THEN 1 ELSE 0 END AS is_current FROM emp"""))
def scd2_window_view(t):
    return changes.scd2_window_view(
        t.employees.select("employee_id", "hire_date", "termination_date"),
        "hire_date", "termination_date")


HISTORY = """
    SELECT product_id, brand, unit_price, created_at AS valid_from, DATE '9999-12-31' AS valid_to, 1 AS is_current FROM prod
    UNION ALL SELECT product_id, 'Unbranded', unit_price, created_at - 400, created_at - 1, 0 FROM prod WHERE category = 'Climbing'"""


@query("scd2_merge", sql("""
    SELECT h.product_id, h.brand, h.unit_price, valid_from,
           CASE WHEN is_current = 1 AND (c.unit_price <> h.unit_price OR c.brand <> h.brand) THEN DATE '2000-06-30' ELSE valid_to END AS valid_to,
           CASE WHEN is_current = 1 AND (c.unit_price <> h.unit_price OR c.brand <> h.brand) THEN 0 ELSE is_current END AS is_current
    FROM history h LEFT JOIN changed c USING (product_id)
    UNION ALL
    SELECT c.product_id, c.brand, c.unit_price, DATE '2000-07-01', DATE '9999-12-31', 1
    FROM changed c LEFT JOIN (SELECT * FROM history WHERE is_current = 1) h USING (product_id)
    WHERE h.product_id IS NULL OR c.unit_price <> h.unit_price OR c.brand <> h.brand""",
    history=HISTORY, changed=CHANGED))
def scd2_merge(t):
    return changes.scd2_merge(_history(t), _changed_products(t), "product_id", ["brand", "unit_price"], F.lit(AS_OF))


def _history(t):
    made = F.col("created_at")
    open_end = F.lit("9999-12-31").cast("date")
    versions = t.products.select(
        "product_id", "brand", "unit_price", made.alias("valid_from"), open_end.alias("valid_to"),
        F.lit(1).alias("is_current"))
    earlier = t.products.where("category = 'Climbing'").select(
        "product_id", F.lit("Unbranded").alias("brand"), "unit_price",
        F.date_sub(made, 400).alias("valid_from"), F.date_sub(made, 1).alias("valid_to"),
        F.lit(0).alias("is_current"))
    return versions.unionByName(earlier)


MERGED = """
    SELECT product_id, valid_from FROM history
    UNION ALL
    SELECT c.product_id, DATE '2000-07-01' FROM changed c LEFT JOIN (SELECT * FROM history WHERE is_current = 1) h USING (product_id)
    WHERE h.product_id IS NULL OR c.unit_price <> h.unit_price OR c.brand <> h.brand"""
KEYED = """
    SELECT product_id, valid_from, row_number() OVER (ORDER BY later, product_id, valid_from) AS version_sk
    FROM (SELECT *, (product_id, valid_from) NOT IN (SELECT (product_id, valid_from) FROM history) AS later FROM merged)"""
VERSION = ["product_id", "valid_from"]


def _loaded_twice(t):
    """The history before and after the merge, and the key map after either load, written each time."""
    before = _history(t)
    after = changes.scd2_merge(before, _changed_products(t), "product_id", ["brand", "unit_price"], F.lit(AS_OF))
    first = sinks.create_or_replace(keymap.extend_keys(before, VERSION, "version_sk"), new_scratch_path(t.spark, "keys"))
    second = keymap.extend_keys(after, VERSION, "version_sk", first)
    return after, sinks.create_or_replace(second, new_scratch_path(t.spark, "keys"))


@query("kept_version_keys", sql("SELECT * FROM keyed", history=HISTORY, changed=CHANGED, merged=MERGED, keyed=KEYED))
def kept_version_keys(t):
    """One number per product version over two loads; those of the first load stay."""
    return _loaded_twice(t)[1]


@query("fact_version_lookup", sql("""
    SELECT version_sk, COUNT(*) AS order_lines, MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date
    FROM fact f JOIN (SELECT *, LEAD(valid_from) OVER (PARTITION BY product_id ORDER BY valid_from) AS upto FROM keyed) v
      ON f.product_id = v.product_id AND f.order_date >= v.valid_from AND (upto IS NULL OR f.order_date < upto)
    GROUP BY version_sk""", history=HISTORY, changed=CHANGED, merged=MERGED, keyed=KEYED))
def fact_version_lookup(t):
    """Lines by the version of their product on the order date."""
    history, keys = _loaded_twice(t)
    sold = t.fact.select("order_id", "order_line_id", "product_id", "order_date")
    found = keymap.version_of(sold, history, keys, "product_id", "order_date", "version_sk")
    return found.groupBy("version_sk").agg(
        F.count("*").alias("order_lines"), F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"))


@query("conditional_update", sql(f"""
    SELECT customer_id, CASE WHEN state = 'CA' THEN 0 ELSE is_active END AS is_active,
           CASE WHEN state = 'CA' THEN 'Wholesale' ELSE customer_segment END AS customer_segment, state FROM cust"""))
def conditional_update(t):
    people = t.customers.select("customer_id", "is_active", "customer_segment", "state")
    return changes.conditional_update(people, F.col("state") == "CA", {
        "is_active": F.lit(0), "customer_segment": F.lit("Wholesale")})


@query("delete_rows", sql("""
    SELECT order_id, customer_id, order_status FROM headers WHERE order_status IS DISTINCT FROM 'Cancelled'"""))
def delete_rows(t):
    orders = t.headers.select("order_id", "customer_id", "order_status")
    return changes.delete_rows(orders, F.col("order_status") == "Cancelled")


@query("add_column_default", sql("SELECT employee_id, full_name, 'full-time' AS contract FROM emp"))
def add_column_default(t):
    return changes.add_column_default(
        t.employees.select("employee_id", "full_name"), "contract", F.lit("full-time"))


@query("rename_column", sql("SELECT employee_id, full_name AS rep_name FROM emp"))
def rename_column(t):
    return changes.rename_column(t.employees.select("employee_id", "full_name"), "full_name", "rep_name")


@query("drop_column", sql("SELECT * EXCLUDE (email, is_manager) FROM emp"))
def drop_column(t):
    return changes.drop_column(changes.drop_column(t.employees, "email"), "is_manager")


NEW_CUSTOMERS = StructType([
    StructField("customer_id", LongType()), StructField("full_name", StringType()),
    StructField("signup_year", IntegerType()), StructField("customer_segment", StringType()),
    StructField("loyalty_points", LongType()),
])


@query("rebuild_with_schema", sql("""
    SELECT customer_id, full_name, CAST(year(signup_date) AS INTEGER) AS signup_year,
           COALESCE(customer_segment, 'unknown') AS customer_segment, CAST(0 AS BIGINT) AS loyalty_points FROM cust"""))
def rebuild_with_schema(t):
    old = t.customers.select("customer_id", "full_name", "customer_segment", F.date_format(
        "signup_date", "yyyy").alias("signup_year"))
    return changes.rebuild_with_schema(
        old, NEW_CUSTOMERS, {"customer_segment": "unknown", "loyalty_points": 0})
