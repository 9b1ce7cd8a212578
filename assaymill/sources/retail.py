"""The retail model over the given order tables, typed and dirty.

``*_feed`` functions give typed rows that carry the defects a cleaning layer
cannot repair (missing keys, orphans, whole-number discounts, repeated people).
``dirty_*`` functions render the same rows as raw text, the bronze layer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.functions.numbers import nearest_cent, net_amount
from assaymill.functions.text import STATE_CODES, lookup
from assaymill.sources import synth

# How the given tables' codes are read in the retail model.
PAYMENT_BY_PRIORITY = {
    "1-URGENT": "Credit Card", "2-HIGH": "Debit Card", "3-MEDIUM": "PayPal",
    "4-NOT SPECIFIED": "Cash", "5-LOW": "Gift Card",
}
STATUS_BY_CODE = {"F": "Completed", "O": "Returned", "P": "Cancelled"}
CHANNEL_BY_CODE = {"O": "Online", "F": "In-Store"}
CATEGORY_BY_TYPE = {
    "STANDARD": "Footwear", "ECONOMY": "Camping & Hiking", "MEDIUM": "Climbing",
    "PROMO": "Nutrition & Hydration", "LARGE": "Water Sports", "SMALL": "Accessories",
}
SEGMENT_BY_MARKET = {
    "AUTOMOBILE": "Retail", "BUILDING": "Retail", "FURNITURE": "Wholesale",
    "HOUSEHOLD": "Wholesale", "MACHINERY": "VIP",
}
REGION_BY_NAME = {
    "AFRICA": "South", "AMERICA": "West", "ASIA": "East", "EUROPE": "Northeast",
    "MIDDLE EAST": "Central",
}
FIRST_NAMES = ["Ada", "Bruno", "Chloe", "Dario", "Mary ann", "Farid", "Greta", "Hugo"]
LAST_NAMES = ["Vale", "Mercer", "O'hara", "Lindqvist", "Stone", "Marsh"]
DEPARTMENT_CYCLE = ["Sales", "Support", "Warehouse", "Management"]
SALES_EMAIL_HOST = "example.com"


def _decode(c: Column, table: dict[str, str]) -> Column:
    out = F
    for code, value in table.items():
        out = out.when(c == code, value)
    return out


def header_feed(orders: DataFrame) -> DataFrame:
    """One row per order: who, when, how paid, which state."""
    k = F.col("o_orderkey")
    feed = orders.select(
        k.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        synth.null_when(F.to_date("o_orderdate"), k % 200 == 7).alias("order_date"),
        _decode(F.col("o_orderpriority"), PAYMENT_BY_PRIORITY).alias("payment_method"),
        synth.null_when(_decode(F.col("o_orderstatus"), STATUS_BY_CODE), k % 11 == 5).alias(
            "order_status"
        ),
    )
    return synth.inject_orphans(feed, "customer_id", F.col("order_id") % 100 == 0)


def line_feed(lineitem: DataFrame) -> DataFrame:
    """One row per order line, without the header's columns."""
    o, n, p = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    points = (F.col("l_discount") * 300 + 0.5).cast("int")
    units = F.col("l_quantity").cast("int")
    feed = lineitem.select(
        o.alias("order_id"),
        n.alias("order_line_id"),
        p.alias("product_id"),
        synth.null_when(F.col("l_suppkey"), o % 10 == 0).alias("employee_id"),
        synth.null_when(F.to_date("l_shipdate"), o % 7 == 3).alias("ship_date"),
        F.when((o + p) % 60 == 1, -units)
        .when((o + p) % 60 == 2, 0)
        .when((o + p) % 60 != 0, units)
        .alias("quantity"),
        nearest_cent(F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.when((o + n) % 67 == 0, points.cast("double")).otherwise(points / 100).alias(
            "discount_pct"
        ),
        _decode(F.col("l_linestatus"), CHANNEL_BY_CODE).alias("channel"),
    )
    orphan = (F.col("order_id") * 10 + F.col("order_line_id")) % 97 == 0
    return synth.inject_orphans(feed, "product_id", orphan)


SALES_COLUMNS = [
    "order_id", "order_line_id", "customer_id", "product_id", "employee_id", "order_date",
    "ship_date", "quantity", "unit_price", "discount_pct", "payment_method", "order_status",
    "channel",
]


def sales_feed(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines with their header. Both sides may be large: no broadcast hint, and the
    header is unique per order, so a heavy order is split by the skew-join rule."""
    return line_feed(lineitem).join(header_feed(orders), "order_id").select(*SALES_COLUMNS)


def customer_feed(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    first, last = synth.pick(FIRST_NAMES, k), synth.pick(LAST_NAMES, F.floor(k / 8))
    states = list(STATE_CODES.values())
    email = F.concat(
        F.replace(F.lower(first), F.lit(" ")), F.lit("."), F.replace(F.lower(last), F.lit("'")),
        k.cast("string"), F.lit("@" + SALES_EMAIL_HOST),
    )
    people = customer.select(
        k.alias("source_key"),
        k.alias("customer_id"),
        first.alias("first_name"),
        last.alias("last_name"),
        synth.null_when(email, (k % 25 == 3) | (k % 50 == 4)).alias("email"),
        (k % 800 + 200).cast("string").alias("area"),
        (k % 900 + 100).cast("string").alias("prefix"),
        (k % 9000 + 1000).cast("string").alias("line"),
        synth.null_when(synth.pick(states, k), k % 33 == 5).alias("state"),
        F.date_add(F.lit("1993-01-01").cast("date"), (k * 37 % 3000).cast("int")).alias(
            "signup_date"
        ),
        F.when(k % 11 < 5, 1).when(k % 11 < 10, 0).alias("is_active"),
        synth.null_when(_decode(F.col("c_mktsegment"), SEGMENT_BY_MARKET), k % 31 == 7).alias(
            "customer_segment"
        ),
    )
    doubled = synth.inject_duplicates(people, "customer_id", F.col("source_key") % 20 == 0)
    return doubled.withColumn(
        "signup_date", F.date_add("signup_date", F.col("is_copy") * 100)
    )


def typed_customers(feed: DataFrame) -> DataFrame:
    k = F.col("source_key")
    phone = F.concat(
        F.lit("("), F.col("area"), F.lit(") "), F.col("prefix"), F.lit("-"), F.col("line")
    )
    return feed.select(
        "customer_id", "first_name", "last_name",
        F.concat_ws(" ", "first_name", "last_name").alias("full_name"),
        "email",
        F.when(k % 40 == 11, "unlisted").when(~(k % 40).isin(9, 10), phone).alias("phone"),
        "state", "signup_date", "is_active", "customer_segment",
    )


def dirty_customers(feed: DataFrame) -> DataFrame:
    k, copy = F.col("source_key"), F.col("is_copy") == 1
    full = lookup(F.col("state"), {code: name.title() for name, code in STATE_CODES.items()})
    dotted = lookup(full, synth.DOTTED_STATES)
    state = (
        F.when(k % 4 == 0, F.col("state")).when(k % 4 == 1, F.lower("state"))
        .when(k % 4 == 2, full).otherwise(F.lower(F.coalesce(dotted, full)))
    )

    def name(column: str) -> Column:
        return F.when(copy, F.concat(F.upper(column), F.lit(" "))).otherwise(
            synth.mixed_case(F.col(column), k)
        )

    email = F.when(copy & (k % 40 == 0), F.upper("email")).when(
        copy, F.concat(F.lit(" "), F.col("email"))
    ).otherwise(F.col("email"))
    phone = synth.mixed_phone(F.col("area"), F.col("prefix"), F.col("line"), k)
    return feed.select(
        "customer_id",
        name("first_name").alias("first_name"),
        name("last_name").alias("last_name"),
        synth.blank_when(email, k % 50 == 4).alias("email"),
        F.when(k % 40 == 11, "unlisted")
        .when(k % 40 == 9, "")
        .when(k % 40 != 10, phone)
        .alias("phone"),
        synth.blank_when(state, k % 66 == 5).alias("state"),
        synth.mixed_date(F.col("signup_date"), k).alias("signup_date"),
        synth.mixed_boolean(F.col("is_active"), k).alias("is_active"),
        synth.mixed_case(F.col("customer_segment"), k + 1).alias("customer_segment"),
    )


def product_feed(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    price = F.col("p_retailprice")
    cost = nearest_cent(price * 0.6)
    return part.select(
        k.alias("product_id"),
        F.col("p_name").alias("product_name"),
        synth.null_when(_decode(F.col("p_type"), CATEGORY_BY_TYPE), k % 101 == 50).alias("category"),
        F.substring_index("p_name", " ", -1).alias("subcategory"),
        F.col("p_brand").alias("brand"),
        F.when(k % 200 == 11, -cost).when(k % 90 != 17, cost).alias("unit_cost"),
        price.alias("unit_price"),
        F.when(k % 11 < 5, 1).when(k % 11 < 10, 0).alias("is_discontinued"),
        F.concat(F.lit("SKU-"), F.when(k % 50 == 0, k + 1).otherwise(k).cast("string")).alias("sku"),
        synth.null_when(k * 7 % 250 / 10, k % 13 == 5).alias("weight_kg"),
        F.date_add(F.lit("1994-06-01").cast("date"), (k * 13 % 900).cast("int")).alias("created_at"),
    )


def dirty_products(feed: DataFrame) -> DataFrame:
    k = F.col("product_id")
    weight = F.col("weight_kg").cast("decimal(5,1)").cast("string")
    return feed.select(
        "product_id",
        F.concat(F.col("product_name"), F.when(k % 6 == 0, " ").otherwise("")).alias("product_name"),
        F.coalesce(synth.mixed_category(F.col("category"), k), F.lit("Misc ")).alias("category"),
        synth.blank_when(F.col("subcategory"), k % 70 == 1).alias("subcategory"),
        F.concat(F.when(k % 8 == 0, " ").otherwise(""), F.col("brand")).alias("brand"),
        "unit_cost", "unit_price",
        synth.mixed_boolean(F.col("is_discontinued"), k).alias("is_discontinued"),
        F.concat(F.col("sku"), F.when(k % 9 == 0, " ").otherwise("")).alias("sku"),
        F.when(k % 2 == 0, F.concat(weight, F.lit(" kg"))).otherwise(weight).alias("weight_kg"),
        synth.mixed_date(F.col("created_at"), k).alias("created_at"),
    )


def typed_products(feed: DataFrame) -> DataFrame:
    return feed.withColumn(
        "subcategory", synth.null_when(F.col("subcategory"), F.col("product_id") % 70 == 1)
    )


def employee_feed(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    first, last = synth.pick(FIRST_NAMES, k + 3), synth.pick(LAST_NAMES, k)
    hired = F.date_add(F.lit("1994-01-01").cast("date"), (k * 53 % 1500).cast("int"))
    left = F.date_add(hired, (k * 29 % 1500 + 200).cast("int"))
    where = nation.join(region, nation.n_regionkey == region.r_regionkey)
    email = F.concat(
        F.replace(F.lower(first), F.lit(" ")), F.lit("."), k.cast("string"),
        F.lit("@" + SALES_EMAIL_HOST),
    )
    return supplier.join(where, supplier.s_nationkey == where.n_nationkey).select(
        k.alias("employee_id"),
        first.alias("first_name"),
        last.alias("last_name"),
        synth.pick(DEPARTMENT_CYCLE, k).alias("department"),
        _decode(F.col("r_name"), REGION_BY_NAME).alias("region"),
        hired.alias("hire_date"),
        synth.null_when(left, k % 7 != 0).alias("termination_date"),
        (k % 5 == 0).cast("int").alias("is_manager"),
        synth.null_when(email, k % 25 == 3).alias("email"),
    )


def typed_employees(feed: DataFrame) -> DataFrame:
    return feed.select(
        "employee_id", "first_name", "last_name",
        F.concat_ws(" ", "first_name", "last_name").alias("full_name"),
        "department", "region", "hire_date", "termination_date", "is_manager", "email",
    )


def dirty_employees(feed: DataFrame) -> DataFrame:
    k = F.col("employee_id")
    pad = F.when(k % 3 == 0, " ").otherwise("")
    return feed.select(
        "employee_id",
        F.concat(pad, F.upper("first_name")).alias("first_name"),
        F.concat(F.lower("last_name"), pad).alias("last_name"),
        synth.mixed_case(F.col("department"), k + 2).alias("department"),
        synth.mixed_case(F.col("region"), k + 1).alias("region"),
        synth.mixed_date(F.col("hire_date"), k).alias("hire_date"),
        synth.mixed_date(F.col("termination_date"), k + 1).alias("termination_date"),
        synth.mixed_boolean(F.col("is_manager"), k).alias("is_manager"),
        F.upper(synth.blank_when(F.col("email"), k % 50 == 3)).alias("email"),
    )


def dirty_sales(feed: DataFrame) -> DataFrame:
    o, n = F.col("order_id"), F.col("order_line_id")
    fixed = F.when(F.col("discount_pct") > 1, F.col("discount_pct") / 100).otherwise(
        F.col("discount_pct")
    )
    correct = net_amount(F.col("quantity"), F.col("unit_price"), fixed)
    stale = F.round(F.coalesce(F.col("quantity"), F.lit(0)) * F.col("unit_price"), 2)
    method = F.when(
        (F.col("payment_method") == "Credit Card") & (o % 6 == 0), F.lit("CC")
    ).otherwise(synth.mixed_case_plain(F.col("payment_method"), o))
    channel = F.when(
        (F.col("channel") == "In-Store") & (n % 2 == 0), F.lit("in store")
    ).otherwise(synth.mixed_case_plain(F.col("channel"), n))
    return feed.select(
        "order_id", "order_line_id", "customer_id", "product_id", "employee_id",
        synth.mixed_date(F.col("order_date"), o).alias("order_date"),
        synth.mixed_date(F.col("ship_date"), o + n).alias("ship_date"),
        "quantity", "unit_price", "discount_pct",
        synth.mixed_total(correct, stale, o + n).alias("order_total"),
        method.alias("payment_method"),
        synth.mixed_case_plain(F.col("order_status"), o + 1).alias("order_status"),
        channel.alias("channel"),
    )
