"""Data-quality reports and layer profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaymill.functions import text
from assaymill.functions.numbers import money_sum
from assaymill.operators import joins, keys, quality
from assaymill.plans import gold, silver
from catalog.model_sql import esum, isum, q, rnd, sql
from catalog.registry import query


def _orphans(key: str, parent: str) -> str:
    return (f"SELECT '{key}' AS foreign_key, COUNT(*) AS orphan_lines, COUNT(DISTINCT {key}) AS orphan_ids, "
            f"MIN({key}) AS sample_id FROM fact WHERE {key} IS NULL OR {key} NOT IN (SELECT {key} FROM {parent})")


@query("orphan_fk_report", sql(" UNION ALL ".join([
    _orphans("customer_id", "cust"), _orphans("product_id", "prod"), _orphans("employee_id", "emp")])))
def orphan_fk_report(t):
    return quality.orphan_fk_report({
        "customer_id": (t.fact, t.customers), "product_id": (t.lines, t.products),
        "employee_id": (t.lines, t.employees)})


@query("fact_null_orphan_counters", sql(f"""
    SELECT COUNT(*) FILTER (employee_id IS NULL) AS null_employee_id, COUNT(*) FILTER (order_date IS NULL) AS null_order_date,
           {isum('is_customer_orphan')} AS orphan_customer_rows, {isum('is_product_orphan')} AS orphan_product_rows
    FROM flagged_fact"""))
def fact_null_orphan_counters(t):
    return quality.counters(t.flagged_fact, {
        "null_employee_id": F.col("employee_id").isNull(),
        "null_order_date": F.col("order_date").isNull(),
        "orphan_customer_rows": F.col("is_customer_orphan") == 1,
        "orphan_product_rows": F.col("is_product_orphan") == 1})


NET_RAW = rnd("quantity * unit_price * (1 - discount_pct)")
STORED = r"COALESCE(TRY_CAST(regexp_extract(trim(order_total), '^[+-]?[0-9]+(\.[0-9]+)?') AS DOUBLE), 0)"


@query("stale_total_detector", sql(f"""
    SELECT order_id, order_line_id, quantity, unit_price, discount_pct, order_total, pre_discount_total, net_amount
    FROM (SELECT *, {rnd('quantity * unit_price')} AS pre_discount_total, {NET_RAW} AS net_amount, {STORED} AS stored
          FROM bronze_sales WHERE discount_pct > 0 AND discount_pct <= 1 AND order_total NOT LIKE '$%')
    WHERE stored <> net_amount AND ABS(stored - pre_discount_total) < 0.02::DOUBLE"""))
def stale_total_detector(t):
    return quality.stale_totals(t.bronze_sales).select(
        "order_id", "order_line_id", "quantity", "unit_price", "discount_pct", "order_total",
        "pre_discount_total", "net_amount")


@query("junk_totals", sql("""
    SELECT order_total, COUNT(*) AS order_lines FROM bronze_sales
    WHERE trim(order_total) IN ('TBD', 'N/A') OR trim(order_total) LIKE '$%' GROUP BY order_total"""))
def junk_totals(t):
    return quality.junk_totals(t.bronze_sales)


def _surplus(name: str, key: str, table: str) -> str:
    return (f"SELECT 'UNIQUE {name}' AS constraint_name, COUNT({key}) - COUNT(DISTINCT {key}) AS violations FROM {table}")


@query("constraint_check", sql(" UNION ALL ".join([
    "SELECT 'NOT NULL customer_id' AS constraint_name, COUNT(*) FILTER (customer_id IS NULL) AS violations FROM bronze_customers",
    "SELECT 'NOT NULL email', COUNT(*) FILTER (email IS NULL) FROM bronze_customers",
    "SELECT 'CHECK segment', COUNT(*) FILTER (customer_segment NOT IN ('Retail', 'Wholesale', 'VIP')) FROM bronze_customers",
    "SELECT 'CHECK email not blank', COUNT(*) FILTER (email = '') FROM bronze_customers",
    _surplus("customer_id", "customer_id", "bronze_customers"),
    _surplus("email", "email", "bronze_customers"),
    _surplus("normalized email", "lower(trim(email))", "bronze_customers"),
    """SELECT 'FOREIGN KEY customer_id', COUNT(*) FROM headers WHERE customer_id IS NOT NULL
       AND customer_id NOT IN (SELECT customer_id FROM cust)""",
    "SELECT 'CHECK quantity', COUNT(*) FILTER (NOT quantity > 0) FROM lines_feed",
    "SELECT 'CHECK discount', COUNT(*) FILTER (NOT discount_pct BETWEEN 0 AND 1) FROM lines_feed",
])))
def constraint_check(t):
    segment, email = F.col("customer_segment"), F.col("email")
    people = quality.constraint_violations(
        t.bronze_customers,
        not_null=["customer_id", "email"],
        checks={"segment": segment.isin("Retail", "Wholesale", "VIP"), "email not blank": email != ""},
        unique={"customer_id": F.col("customer_id"), "email": email,
                "normalized email": text.normalized_key(email)})
    orders = quality.constraint_violations(t.headers, foreign={"customer_id": t.customers})
    lines = quality.constraint_violations(t.lines_feed, checks={
        "quantity": F.col("quantity") > 0, "discount": F.col("discount_pct").between(0, 1)})
    return quality.stacked([people, orders, lines])


@query("unmapped_values", sql("""
    SELECT category AS raw_value, COUNT(*) AS n FROM bronze_products
    WHERE product_id IN (SELECT product_id FROM prod WHERE category IS NULL) GROUP BY 1"""))
def unmapped_values(t):
    return quality.unmapped_values(
        t.bronze_products, "category", text.standardize_category(F.col("category")))


@query("value_at_risk", sql(f"""
    SELECT {isum('quantity')} AS quantity_at_risk, {esum('net_amount')} AS net_at_risk FROM flagged_fact
    WHERE is_customer_orphan = 1"""))
def value_at_risk(t):
    flagged = joins.flag_orphans(t.fact, "customer_id", t.customers, "is_customer_orphan")
    return flagged.where("is_customer_orphan = 1").agg(
        F.sum("quantity").alias("quantity_at_risk"),
        money_sum(F.col("net_amount")).alias("net_at_risk"))


CHECKS = [
    ("bronze_customers rows", "SELECT COUNT(*) FROM cust_feed", "SELECT COUNT(*) FROM bronze_customers"),
    ("bronze_products rows", "SELECT COUNT(*) FROM part", "SELECT COUNT(*) FROM bronze_products"),
    ("bronze_employees rows", "SELECT COUNT(*) FROM supplier", "SELECT COUNT(*) FROM bronze_employees"),
    ("bronze_sales rows", "SELECT COUNT(*) FROM lineitem", "SELECT COUNT(*) FROM bronze_sales"),
    ("dim_date rows", "SELECT date_diff('day', make_date(year(min(o_orderdate)), 1, 1), make_date(year(max(o_orderdate)), 12, 31)) + 1 FROM orders", "SELECT COUNT(*) FROM cal"),
    ("fact_sales rows", "SELECT COUNT(*) FROM lineitem", "SELECT COUNT(*) FROM fact"),
    ("repeated line keys", "SELECT 0", "SELECT COUNT(*) FROM (SELECT order_id FROM lines GROUP BY order_id, order_line_id HAVING COUNT(*) > 1)"),
    ("near-duplicate customers", "SELECT COUNT(*) FROM customer WHERE c_custkey % 20 = 0",
     "SELECT COUNT(e) - COUNT(DISTINCT e) FROM (SELECT lower(trim(email)) AS e FROM bronze_customers) WHERE e <> ''"),
]
# Counters without an expectation: of each table its rules, in one pass.
COUNTED = {
    "bronze_customers": {"customer email missing": "email IS NULL", "customer email blank": "email = ''"},
    "silver_products": {"product sku shared": "sku_is_duplicate = 1", "product cost negative": "unit_cost < 0"},
    "flagged_fact": {"customer orphan lines": "is_customer_orphan = 1", "product orphan lines": "is_product_orphan = 1",
                     "shipped before order": "ship_date < order_date"},
    "bronze_sales": {
        "quantity negative": "quantity < 0", "quantity zero": "quantity = 0", "quantity missing": "quantity IS NULL",
        "discount above 1": "discount_pct > 1", "employee missing": "employee_id IS NULL",
        "order date missing": "order_date IS NULL", "order total missing": "order_total IS NULL",
        "order total TBD": "order_total = 'TBD'", "order total N/A": "order_total = 'N/A'"},
}


def _counters_sql(table: str, rules: dict[str, str]) -> str:
    counts = ", ".join(f'COUNT(*) FILTER ({rule}) AS "{name}"' for name, rule in rules.items())
    return (f"SELECT check_name, CAST(NULL AS BIGINT), actual, CAST(NULL AS INTEGER) FROM "
            f"(UNPIVOT (SELECT {counts} FROM {table}) ON COLUMNS(*) INTO NAME check_name VALUE actual)")


@query("build_validation", sql(" UNION ALL ".join(
    [f"SELECT {q(n)} AS check_name, CAST(({e}) AS BIGINT) AS expected, ({a}) AS actual, CAST(({e}) = ({a}) AS INTEGER) AS ok"
     for n, e, a in CHECKS]
    + [_counters_sql(table, rules) for table, rules in COUNTED.items()])))
def build_validation(t):
    """Hard checks with expectation and verdict, then informational counters.

    All counters of one table, its row count included, share one pass over it.
    """
    customers, sales = t.bronze_customers, t.bronze_sales
    products = keys.flag_duplicates(
        t.bronze_products.withColumn("sku", F.trim("sku")), "sku", "shared")
    dated = silver.silver_sales(sales, customers, t.bronze_products)
    total, quantity, every = F.col("order_total"), F.col("quantity"), F.lit(True)
    passes = [
        (customers, {
            "bronze_customers rows": every, "customer email missing": F.col("email").isNull(),
            "customer email blank": F.col("email") == ""}),
        (products, {
            "bronze_products rows": every, "product sku shared": F.col("shared") == 1,
            "product cost negative": F.col("unit_cost") < 0}),
        (t.bronze_employees, {"bronze_employees rows": every}),
        (sales, {
            "bronze_sales rows": every, "employee missing": F.col("employee_id").isNull(),
            "order date missing": F.col("order_date").isNull(),
            "order total missing": total.isNull(), "order total TBD": total == "TBD",
            "order total N/A": total == "N/A", "quantity negative": quantity < 0,
            "quantity zero": quantity == 0, "quantity missing": quantity.isNull(),
            "discount above 1": F.col("discount_pct") > 1}),
        (dated, {
            "fact_sales rows": every, "customer orphan lines": F.col("is_customer_orphan") == 1,
            "product orphan lines": F.col("is_product_orphan") == 1,
            "shipped before order": F.col("ship_date") < F.col("order_date")}),
        (t.calendar, {"dim_date rows": every}),
        (keys.grain_check(t.lines, ["order_id", "order_line_id"]), {"repeated line keys": every}),
    ]
    given = F.col("check_name")
    lines_given = t.raw("lineitem").agg(F.count("*")).scalar()
    # The calendar is expected to have every day of the years that have orders.
    first, last = F.year(F.min("o_orderdate")), F.year(F.max("o_orderdate"))
    span = t.raw("orders").agg((F.datediff(
        F.make_date(last, F.lit(12), F.lit(31)), F.make_date(first, F.lit(1), F.lit(1))) + 1).cast("long")).scalar()
    expected = (
        F.when(given == "bronze_customers rows", t.customer_feed.agg(F.count("*")).scalar())
        .when(given == "bronze_products rows", t.raw("part").agg(F.count("*")).scalar())
        .when(given == "bronze_employees rows", t.raw("supplier").agg(F.count("*")).scalar())
        .when(given.isin("bronze_sales rows", "fact_sales rows"), lines_given)
        .when(given == "dim_date rows", span)
        .when(given == "repeated line keys", F.lit(0).cast("long"))
        .when(given == "near-duplicate customers", t.raw("customer").where("c_custkey % 20 = 0").agg(F.count("*")).scalar())
    )
    # Surplus rows with the same address once case and outer spaces are ignored.
    addresses = customers.select(text.normalized_key(F.col("email")).alias("address")).where("address <> ''")
    near = addresses.groupBy("address").count().agg(
        F.lit("near-duplicate customers").alias("check_name"),
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("actual"))
    counted = quality.stacked(
        [*(quality.unpivot_counters(quality.counters(df, rules)) for df, rules in passes), near])
    return counted.withColumn("expected", expected).withColumn(
        "ok", (F.col("expected") == F.col("actual")).cast("int"))


@query("layer_row_counts", sql("""
    SELECT 'sales' AS thread, (SELECT COUNT(*) FROM bronze_sales) AS bronze, (SELECT COUNT(*) FROM silver_sales) AS silver,
           (SELECT COUNT(*) FROM fact) AS gold
    UNION ALL SELECT 'customers', (SELECT COUNT(*) FROM bronze_customers), (SELECT COUNT(*) FROM cust),
           (SELECT COUNT(*) FROM cust)"""))
def layer_row_counts(t):
    silver_people = silver.silver_customers(t.bronze_customers)
    silver_lines = silver.silver_sales(t.bronze_sales, t.bronze_customers, t.bronze_products)
    return quality.layer_row_counts({
        "sales": {"bronze": t.bronze_sales, "silver": silver_lines,
                  "gold": gold.fact_sales(silver_lines)},
        "customers": {"bronze": t.bronze_customers, "silver": silver_people,
                      "gold": gold.dim_customer(silver_people)},
    })


@query("table_profile", sql("""
    SELECT 'bronze_customers' AS table_name, 'Bronze' AS tier, COUNT(*) AS row_count, 9 AS column_count FROM bronze_customers
    UNION ALL SELECT 'silver_customers', 'Silver', COUNT(*), 10 FROM cust
    UNION ALL SELECT 'dim_product', 'Gold', COUNT(*), 12 FROM silver_products
    UNION ALL SELECT 'agg_daily_sales', 'Gold (Aggregations)', COUNT(*), 7 FROM daily"""))
def table_profile(t):
    return quality.table_profile({
        "bronze_customers": t.bronze_customers,
        "silver_customers": silver.silver_customers(t.bronze_customers),
        "dim_product": gold.dim_product(silver.silver_products(t.bronze_products)),
        "agg_daily_sales": t.daily,
    })


@query("join_inflation_check", sql("""
    SELECT 'before_joins' AS check_name, COUNT(*) AS actual FROM fact
    UNION ALL SELECT 'after_joins', COUNT(*) FROM fact JOIN cust USING (customer_id) JOIN prod USING (product_id)
    JOIN emp USING (employee_id)"""))
def join_inflation_check(t):
    return quality.join_inflation_check(t.fact, [
        (t.customers, "customer_id"), (t.products, "product_id"), (t.employees, "employee_id")])
