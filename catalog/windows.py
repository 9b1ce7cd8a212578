"""Windows, numbering, ranking and deduplication."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from assaymill.functions.numbers import money_sum
from assaymill.functions.text import normalized_key
from assaymill.operators import groups, joins, keys, ordered, windows
from assaymill.plans import analytics, gold
from assaymill.runtime import dealt, pinned
from catalog.model_sql import rnd, sql
from catalog.registry import query

def _ltv(t):
    return t.ltv.select("customer_id", "customer_segment", "order_count")


@query("row_number", sql("""
    SELECT customer_id, customer_segment, order_count,
           row_number() OVER (PARTITION BY customer_segment ORDER BY order_count DESC, customer_id) AS row_num FROM ltv"""))
def row_number(t):
    order = [ordered.descending("order_count"), "customer_id"]
    return ordered.row_numbers(_ltv(t), ["customer_segment"], order)


@query("rank", sql("""
    SELECT product_id, product_name, category, unit_price,
           rank() OVER (PARTITION BY category ORDER BY unit_price DESC) AS price_rank FROM prod"""))
def rank(t):
    return ordered.ranks(t.products.select("product_id", "product_name", "category", "unit_price"),
                         ["category"], "unit_price", rank="price_rank")


@query("dense_rank", sql("""
    SELECT employee_id, full_name, region, line_count,
           dense_rank() OVER (PARTITION BY region ORDER BY line_count DESC) AS region_rank
    FROM (SELECT employee_id, full_name, region, COUNT(*) AS line_count FROM emp JOIN lines USING (employee_id) GROUP BY ALL)"""))
def dense_rank(t):
    per_rep = t.lines.groupBy("employee_id").agg(F.count("*").alias("line_count"))
    people = t.employees.select("employee_id", "full_name", "region").join(per_rep, "employee_id")
    return ordered.ranks(people, ["region"], "line_count", dense_rank="region_rank")


@query("running_total", sql("""
    SELECT order_date, total_net_amount,
           SUM(CAST(ROUND(total_net_amount * 100) AS BIGINT)) OVER (ORDER BY order_date)::DOUBLE / 100 AS running_total
    FROM daily"""))
def running_total(t):
    return windows.running_total(
        t.daily.select("order_date", "total_net_amount"), "total_net_amount", ["order_date"])


@query("running_total_partitioned", sql("""
    SELECT category, year, month, total_net_amount,
           SUM(CAST(ROUND(total_net_amount * 100) AS BIGINT)) OVER (PARTITION BY category ORDER BY year, month)::DOUBLE / 100 AS running_total
    FROM monthly"""))
def running_total_partitioned(t):
    sales = t.monthly.select("category", "year", "month", "total_net_amount")
    return windows.running_total(
        sales, "total_net_amount", ["year", "month"], ["category"], frame="range")


@query("moving_average", sql(f"""
    SELECT order_date, total_net_amount, {rnd("SUM(c) OVER w3::DOUBLE / 100 / COUNT(c) OVER w3")} AS moving_avg_3d,
           {rnd("SUM(c) OVER w7::DOUBLE / 100 / COUNT(c) OVER w7")} AS moving_avg_7d
    FROM (SELECT *, CAST(ROUND(total_net_amount * 100) AS BIGINT) AS c FROM daily)
    WINDOW w3 AS (ORDER BY order_date ROWS 2 PRECEDING), w7 AS (ORDER BY order_date ROWS 6 PRECEDING)"""))
def moving_average(t):
    days = t.daily.select("order_date", "total_net_amount")
    for n in (3, 7):
        days = windows.moving_average(
            days, "total_net_amount", ["order_date"], n, name=f"moving_avg_{n}d")
    return days


@query("running_max", sql("""
    SELECT order_date, total_net_amount, MAX(total_net_amount) OVER (ORDER BY order_date) AS running_max FROM daily"""))
def running_max(t):
    return windows.running_max(
        t.daily.select("order_date", "total_net_amount"), "total_net_amount", ["order_date"])


@query("first_crossing", sql("""
    SELECT order_date, running_total FROM (
        SELECT order_date, SUM(CAST(ROUND(total_net_amount * 100) AS BIGINT)) OVER (ORDER BY order_date)::DOUBLE / 100 AS running_total
        FROM daily) WHERE running_total > 10000000 ORDER BY order_date LIMIT 1"""))
def first_crossing(t):
    days = t.daily.select("order_date", "total_net_amount")
    return windows.first_crossing(days, "total_net_amount", ["order_date"], 10_000_000).drop(
        "total_net_amount")


@query("partition_total_share", sql(f"""
    SELECT category, product_id, total_revenue, SUM(CAST(ROUND(total_revenue * 100) AS BIGINT)) OVER (PARTITION BY category)::DOUBLE / 100 AS group_total,
           {rnd("100.0::DOUBLE * total_revenue / (SUM(CAST(ROUND(total_revenue * 100) AS BIGINT)) OVER (PARTITION BY category)::DOUBLE / 100)", 1)} AS pct_of_group
    FROM product_revenue"""))
def partition_total_share(t):
    revenue = analytics.product_revenue(t.lines, t.products).drop("product_name")
    return groups.share_of_group(revenue, ["category"], "total_revenue")


@query("lag_change", sql(f"""
    SELECT category, year, month, total_net_amount, prior AS prior_amount, {rnd("total_net_amount - prior")} AS change,
           {rnd("100.0::DOUBLE * (total_net_amount - prior) / NULLIF(prior, 0)", 1)} AS pct_change
    FROM (SELECT *, LAG(total_net_amount) OVER (PARTITION BY category ORDER BY year, month) AS prior FROM monthly)"""))
def lag_change(t):
    return windows.period_change(
        t.monthly.select("category", "year", "month", "total_net_amount"), "total_net_amount",
        ["year", "month"], ["category"])


@query("lead_next", sql("""
    SELECT year, month, month_total, LEAD(month_total) OVER (ORDER BY year, month) AS next_month_total FROM month_net"""))
def lead_next(t):
    return windows.next_value(analytics.month_totals(t.monthly), "month_total", ["year", "month"],
                              name="next_month_total")


@query("gap_between_events", sql("""
    SELECT customer_id, order_date, prev_date, CAST(order_date - prev_date AS INTEGER) AS days_since_prev FROM (
        SELECT customer_id, order_date, LAG(order_date) OVER (PARTITION BY customer_id ORDER BY order_date) AS prev_date
        FROM (SELECT DISTINCT customer_id, order_date FROM headers WHERE order_date IS NOT NULL))"""))
def gap_between_events(t):
    return windows.gap_between_events(t.headers, "customer_id", "order_date")


@query("largest_drops", sql(f"""
    SELECT year, month, month_total, {rnd("month_total - prior")} AS change FROM (
        SELECT *, LAG(month_total) OVER (ORDER BY year, month) AS prior FROM month_net)
    WHERE prior IS NOT NULL ORDER BY month_total - prior, year, month LIMIT 3"""))
def largest_drops(t):
    months = analytics.month_totals(t.monthly)
    return windows.largest_drops(months, "month_total", ["year", "month"], 3).select(
        "year", "month", "month_total", "change")


# Line grain: two channels hold all lines, so each is a group of about half the table.
LINE = ["channel", "order_date", "order_id", "order_line_id", "product_id", "net_amount"]
LINE_ORDER = LINE[1:]
LINE_W = f"PARTITION BY channel ORDER BY {', '.join(f'{c} NULLS FIRST' for c in LINE_ORDER)}"


@query("line_moving_average", sql(f"""
    SELECT {", ".join(LINE)}, {rnd("SUM(c) OVER w::DOUBLE / 100 / COUNT(c) OVER w")} AS moving_avg_5
    FROM (SELECT *, CAST(ROUND(net_amount * 100) AS BIGINT) AS c FROM fact)
    WINDOW w AS ({LINE_W} ROWS 4 PRECEDING)"""))
def line_moving_average(t):
    return ordered.moving_mean(t.fact.select(*LINE), ["channel"], LINE_ORDER, "net_amount", "moving_avg_5", 5)


@query("line_running_max", sql(f"""
    SELECT {", ".join(LINE)}, MAX(net_amount) OVER ({LINE_W} ROWS UNBOUNDED PRECEDING) AS running_max FROM fact"""))
def line_running_max(t):
    return ordered.running_extreme(t.fact.select(*LINE), ["channel"], LINE_ORDER, "net_amount", "running_max")


@query("line_change", sql(f"""
    SELECT {", ".join(LINE)}, LAG(net_amount) OVER ({LINE_W}) AS prior_amount,
           {rnd(f"net_amount - LAG(net_amount) OVER ({LINE_W})")} AS change FROM fact"""))
def line_change(t):
    beside = ordered.previous_value(t.fact.select(*LINE), ["channel"], LINE_ORDER, "net_amount", "prior_amount")
    return beside.withColumn("change", F.round(F.col("net_amount") - F.col("prior_amount"), 2))


@query("line_next", sql(f"""
    SELECT {", ".join(LINE)}, LEAD(net_amount, 2) OVER ({LINE_W}) AS amount_after_next FROM fact"""))
def line_next(t):
    return ordered.following_value(t.fact.select(*LINE), ["channel"], LINE_ORDER, "net_amount", "amount_after_next", 2)


@query("line_last_known", sql(f"""
    SELECT {", ".join(LINE)}, employee_id,
           LAST_VALUE(employee_id IGNORE NULLS) OVER ({LINE_W}, employee_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS last_employee_id
    FROM fact"""))
def line_last_known(t):
    lines = t.fact.select(*LINE, "employee_id")
    return ordered.last_known(lines, ["channel"], [*LINE_ORDER, "employee_id"], "employee_id", "last_employee_id")


@query("count_over_flag", sql("""
    SELECT product_id, sku, CASE WHEN COUNT(*) OVER (PARTITION BY sku) > 1 THEN 1 ELSE 0 END AS sku_is_duplicate FROM prod"""))
def count_over_flag(t):
    return keys.flag_duplicates(t.products.select("product_id", "sku"), "sku", "sku_is_duplicate")


@query("latest_per_entity", sql("""
    SELECT customer_id, order_id, order_date FROM headers WHERE order_date IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id DESC) = 1"""))
def latest_per_entity(t):
    dated = t.headers.where("order_date IS NOT NULL").select("customer_id", "order_id", "order_date")
    return keys.latest_per_entity(dated, "customer_id", ["order_date", "order_id"])


@query("top_n_per_group", sql("""
    SELECT category, product_id, product_name, total_revenue, CAST(rn AS INTEGER) AS rn FROM (
        SELECT *, row_number() OVER (PARTITION BY category ORDER BY total_revenue DESC, product_id) AS rn FROM product_revenue)
    WHERE rn <= 2"""))
def top_n_per_group(t):
    revenue = analytics.product_revenue(t.lines, t.products)
    order = [F.col("total_revenue").desc(), F.col("product_id").asc()]
    return keys.top_n_per_group(revenue, ["category"], order, 2)


@query("worst_per_group", sql("""
    SELECT category, product_id, product_name, total_revenue, CAST(rn AS INTEGER) AS rn FROM (
        SELECT *, row_number() OVER (PARTITION BY category ORDER BY total_revenue, product_id) AS rn FROM product_revenue)
    WHERE rn = 1"""))
def worst_per_group(t):
    revenue = analytics.product_revenue(t.lines, t.products)
    order = [F.col("total_revenue").asc(), F.col("product_id").asc()]
    return keys.top_n_per_group(revenue, ["category"], order, 1)


@query("top_share_per_group", sql(f"""
    SELECT category, product_id, product_name, total_revenue, group_total,
           {rnd("100.0::DOUBLE * total_revenue / group_total", 1)} AS pct_of_group, CAST(rn AS INTEGER) AS rn FROM (
        SELECT *, row_number() OVER (PARTITION BY category ORDER BY total_revenue DESC, product_id) AS rn,
               SUM(CAST(ROUND(total_revenue * 100) AS BIGINT)) OVER (PARTITION BY category)::DOUBLE / 100 AS group_total
        FROM product_revenue)
    WHERE rn <= 3"""))
def top_share_per_group(t):
    """Best three products per category with their share of it; revenue is computed once."""
    revenue = pinned(analytics.product_revenue(t.lines, t.products))
    shares = groups.share_of_group(revenue, ["category"], "total_revenue")
    order = [F.col("total_revenue").desc(), F.col("product_id").asc()]
    return keys.top_n_per_group(shares, ["category"], order, 3)


@query("quarter_change", sql(f"""
    SELECT year, quarter, quarter_total, prior AS prior_amount, {rnd("quarter_total - prior")} AS change,
           {rnd("100.0::DOUBLE * (quarter_total - prior) / NULLIF(prior, 0)", 1)} AS pct_change
    FROM (SELECT *, LAG(quarter_total) OVER (ORDER BY year, quarter) AS prior FROM (
        SELECT year, CAST((month - 1) // 3 + 1 AS INTEGER) AS quarter,
               SUM(CAST(ROUND(total_net_amount * 100) AS BIGINT))::DOUBLE / 100 AS quarter_total
        FROM monthly GROUP BY 1, 2))"""))
def quarter_change(t):
    quarters = gold.agg_quarterly_by_category(t.fact, t.calendar, t.products).groupBy(
        "year", "quarter").agg(money_sum(F.col("total_net_amount")).alias("quarter_total"))
    return windows.period_change(quarters, "quarter_total", ["year", "quarter"])


@query("top_category_per_year_with_yoy", sql(f"""
    SELECT year, category, year_revenue, prev_year_revenue, {rnd("year_revenue - prev_year_revenue")} AS yoy_change FROM (
        SELECT *, LAG(year_revenue) OVER (PARTITION BY category ORDER BY year) AS prev_year_revenue,
               rank() OVER (PARTITION BY year ORDER BY year_revenue DESC) AS rnk FROM category_year)
    WHERE rnk = 1"""))
def top_category_per_year_with_yoy(t):
    yearly = analytics.category_years(t.monthly)
    by_year = Window.partitionBy("category").orderBy("year")
    with_prev = yearly.withColumn("prev_year_revenue", F.lag("year_revenue").over(by_year))
    best = keys.top_rank_per_group(with_prev, ["year"], "year_revenue")
    change = F.round(F.col("year_revenue") - F.col("prev_year_revenue"), 2)
    return best.withColumn("yoy_change", change).drop("rnk")


EMAIL_ORDER = "PARTITION BY lower(trim(email)) ORDER BY signup_date, customer_id"


def _email_key():
    return normalized_key(F.col("email")), [F.col("signup_date"), F.col("customer_id")]


@query("dedup_by_key", sql(f"""
    SELECT * FROM cust WHERE trim(email) <> '' QUALIFY row_number() OVER ({EMAIL_ORDER}) = 1"""))
def dedup_by_key(t):
    return keys.dedup_by_key(t.customers, *_email_key())


@query("duplicate_listing", sql("""
    SELECT customer_id, email, lower(trim(email)) AS norm_email,
           row_number() OVER (PARTITION BY lower(trim(email)) ORDER BY customer_id) AS rn
    FROM bronze_customers WHERE trim(email) <> '' QUALIFY COUNT(*) OVER (PARTITION BY lower(trim(email))) > 1"""))
def duplicate_listing(t):
    listed = keys.duplicate_listing(
        t.bronze_customers.select("customer_id", "email"), normalized_key(F.col("email")),
        ["customer_id"])
    return listed.withColumnRenamed("norm_key", "norm_email")


@query("dedup_impact", sql(f"""
    SELECT COUNT(*) AS fact_rows_at_risk, COUNT(DISTINCT customer_id) AS customers_at_risk FROM fact
    WHERE customer_id IN (SELECT customer_id FROM cust WHERE trim(email) <> ''
                          QUALIFY row_number() OVER ({EMAIL_ORDER.replace('signup_date,', 'signup_date DESC,')}) > 1)"""))
def dedup_impact(t):
    """Keeping the latest sign-up drops the earlier rows, the ones that have orders."""
    key, _ = _email_key()
    newest = [-F.unix_date("signup_date"), F.col("customer_id")]
    losers = dealt(keys.dedup_losers(t.customers, key, newest, "customer_id"))
    lost = joins.semi_join(t.fact.select("customer_id", "order_id"), losers, "customer_id")
    per_customer = lost.groupBy("customer_id").agg(F.count("*").alias("n"))
    return per_customer.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("fact_rows_at_risk"),
        F.count("*").alias("customers_at_risk"))


@query("surrogate_key", sql("""
    SELECT row_number() OVER (ORDER BY customer_id) AS customer_sk, customer_id, full_name FROM cust"""))
def surrogate_key(t):
    return ordered.surrogate_key(t.customers.select("customer_id", "full_name"), "customer_id", "customer_sk")
