"""Declared schemas of the raw tables. Raw text stays text; no key is declared."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

# Raw column names and types.
_RAW = {
    "bronze_customers": {
        "customer_id": "long", "first_name": "text", "last_name": "text", "email": "text",
        "phone": "text", "state": "text", "signup_date": "text", "is_active": "text",
        "customer_segment": "text",
    },
    "bronze_products": {
        "product_id": "long", "product_name": "text", "category": "text", "subcategory": "text",
        "brand": "text", "unit_cost": "double", "unit_price": "double",
        "is_discontinued": "text", "sku": "text", "weight_kg": "text", "created_at": "text",
    },
    "bronze_employees": {
        "employee_id": "long", "first_name": "text", "last_name": "text", "department": "text",
        "region": "text", "hire_date": "text", "termination_date": "text",
        "is_manager": "text", "email": "text",
    },
    "bronze_sales": {
        "order_id": "long", "order_line_id": "int", "customer_id": "long", "product_id": "long",
        "employee_id": "long", "order_date": "text", "ship_date": "text", "quantity": "int",
        "unit_price": "double", "discount_pct": "double", "order_total": "text",
        "payment_method": "text", "order_status": "text", "channel": "text",
    },
    "bronze_calendar": {"datekey": "int", "date": "text"},
}
_TYPES = {"long": LongType, "int": IntegerType, "double": DoubleType, "text": StringType}

BRONZE_SCHEMAS = {
    table: StructType([StructField(name, _TYPES[kind]()) for name, kind in columns.items()])
    for table, columns in _RAW.items()
}
