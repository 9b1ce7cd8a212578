"""Silver layer: raw text in, typed and standardised rows out. No row is dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.functions import dates, numbers, text
from assaymill.operators.joins import flag_orphans
from assaymill.operators.keys import flag_duplicates


def _with_full_name(df: DataFrame, columns: list[str]) -> DataFrame:
    full = F.concat(F.col("first_name"), F.lit(" "), F.col("last_name"))
    return df.withColumn("full_name", full).select(*columns)


def silver_customers(bronze: DataFrame) -> DataFrame:
    cleaned = bronze.select(
        "customer_id",
        text.clean_name(F.col("first_name")).alias("first_name"),
        text.clean_name(F.col("last_name")).alias("last_name"),
        text.clean_email(F.col("email")).alias("email"),
        text.normalize_phone(F.col("phone")).alias("phone"),
        text.normalize_state(F.col("state")).alias("state"),
        dates.parse_mixed_date(F.col("signup_date")).alias("signup_date"),
        text.standardize_boolean(F.col("is_active")).alias("is_active"),
        text.standardize_segment(F.col("customer_segment")).alias("customer_segment"),
    )
    return _with_full_name(cleaned, CUSTOMER_COLUMNS)


def silver_products(bronze: DataFrame) -> DataFrame:
    cleaned = bronze.select(
        "product_id",
        F.trim("product_name").alias("product_name"),
        text.standardize_category(F.col("category")).alias("category"),
        text.blank_to_null(F.col("subcategory")).alias("subcategory"),
        F.trim("brand").alias("brand"),
        "unit_cost",
        "unit_price",
        text.standardize_boolean(F.col("is_discontinued")).alias("is_discontinued"),
        F.trim("sku").alias("sku"),
        numbers.parse_weight(F.col("weight_kg")).alias("weight_kg"),
        dates.parse_mixed_date(F.col("created_at")).alias("created_at"),
    )
    return flag_duplicates(cleaned, "sku", "sku_is_duplicate").select(*PRODUCT_COLUMNS)


def silver_employees(bronze: DataFrame) -> DataFrame:
    cleaned = bronze.select(
        "employee_id",
        text.clean_name(F.col("first_name"), collapse=False).alias("first_name"),
        text.clean_name(F.col("last_name"), collapse=False).alias("last_name"),
        text.standardize_department(F.col("department")).alias("department"),
        text.standardize_region(F.col("region")).alias("region"),
        dates.parse_mixed_date(F.col("hire_date")).alias("hire_date"),
        dates.parse_mixed_date(F.col("termination_date")).alias("termination_date"),
        text.standardize_boolean(F.col("is_manager")).alias("is_manager"),
        text.clean_email(F.col("email")).alias("email"),
    )
    return _with_full_name(cleaned, EMPLOYEE_COLUMNS)


def silver_calendar(bronze: DataFrame) -> DataFrame:
    day = F.col("date")
    if dict(bronze.dtypes)["date"] == "string":
        day = dates.parse_mixed_date(day)
    return bronze.select("datekey", day.alias("date"))


def price_lines(lines: DataFrame) -> DataFrame:
    """Repair the discount and recompute the line total from its parts."""
    fixed = lines.withColumn("discount_pct", numbers.fix_discount_pct(F.col("discount_pct")))
    total = numbers.net_amount(F.col("quantity"), F.col("unit_price"), F.col("discount_pct"))
    return fixed.withColumn("net_amount", total)


def silver_sales(bronze: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    parsed = bronze.select(
        "order_id", "order_line_id", "customer_id", "product_id", "employee_id",
        dates.parse_mixed_date(F.col("order_date")).alias("order_date"),
        dates.parse_mixed_date(F.col("ship_date")).alias("ship_date"),
        "quantity", "unit_price", "discount_pct",
        F.col("order_total").alias("order_total_raw"),
        text.standardize_payment_method(F.col("payment_method")).alias("payment_method"),
        text.standardize_order_status(F.col("order_status")).alias("order_status"),
        text.standardize_channel(F.col("channel")).alias("channel"),
    )
    priced = price_lines(parsed)
    flagged = flag_orphans(priced, "customer_id", customers, "is_customer_orphan")
    return flag_orphans(flagged, "product_id", products, "is_product_orphan").select(*SALES_COLUMNS)


# Output columns of each silver table, in order.
CUSTOMER_COLUMNS = [
    "customer_id", "first_name", "last_name", "full_name", "email", "phone", "state",
    "signup_date", "is_active", "customer_segment",
]
PRODUCT_COLUMNS = [
    "product_id", "product_name", "category", "subcategory", "brand", "unit_cost", "unit_price",
    "is_discontinued", "sku", "sku_is_duplicate", "weight_kg", "created_at",
]
EMPLOYEE_COLUMNS = [
    "employee_id", "first_name", "last_name", "full_name", "department", "region", "hire_date",
    "termination_date", "is_manager", "email",
]
SALES_COLUMNS = [
    "order_id", "order_line_id", "customer_id", "product_id", "employee_id", "order_date",
    "ship_date", "quantity", "unit_price", "discount_pct", "net_amount", "order_total_raw",
    "payment_method", "order_status", "channel", "is_customer_orphan", "is_product_orphan",
]
