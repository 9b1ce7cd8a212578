"""Analyses: cohorts, lifetime value, tiers, margins and lead times."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from assaymill.functions import dates
from assaymill.operators import windows
from assaymill.operators.joins import semi_join
from assaymill.plans import analytics, gold
from catalog.model_sql import esum, rnd, sql
from catalog.registry import query

SNAPSHOT = dt.date(2001, 12, 31)


@query("cohort_summary", sql(f"""
    SELECT strftime(signup_date, '%Y-%m') AS cohort_month, COUNT(DISTINCT c.customer_id) AS cohort_size,
           COUNT(DISTINCT f.customer_id) AS active_customers, {esum('net_amount')} AS cohort_net_amount
    FROM cust c LEFT JOIN (SELECT * FROM fact WHERE order_date IS NOT NULL) f ON f.customer_id = c.customer_id
    GROUP BY 1"""))
def cohort_summary(t):
    return analytics.cohort_summary(t.customers, t.fact)


@query("cohort_retention", sql("""
    SELECT strftime(signup_date, '%Y-%m') AS cohort_month,
           CAST(datediff('month', signup_date, order_date) AS INTEGER) AS months_since_signup,
           COUNT(DISTINCT c.customer_id) AS active_customers
    FROM cust c JOIN headers h ON h.customer_id = c.customer_id WHERE order_date IS NOT NULL GROUP BY 1, 2"""))
def cohort_retention(t):
    return analytics.cohort_retention(t.customers, t.headers)


@query("cohort_activation_90d", sql(f"""
    SELECT CAST(year(signup_date) AS INTEGER) AS signup_year, COUNT(*) AS cohort_size,
           COUNT(*) FILTER (first_date - signup_date BETWEEN 0 AND 90) AS activated,
           {rnd("100.0::DOUBLE * COUNT(*) FILTER (first_date - signup_date BETWEEN 0 AND 90) / COUNT(*)")} AS activation_rate_pct
    FROM cust LEFT JOIN (SELECT customer_id, MIN(order_date) AS first_date FROM headers GROUP BY 1) USING (customer_id)
    GROUP BY 1"""))
def cohort_activation_90d(t):
    return analytics.cohort_activation(t.customers, t.headers, 90)


@query("ltv_by_segment", sql(f"""
    SELECT customer_segment, COUNT(*) AS customers, COUNT(*) FILTER (order_count = 0) AS zero_order_customers,
           {rnd(f"{esum('lifetime_net_amount')} / COUNT(*)")} AS avg_ltv, {esum('lifetime_net_amount')} AS segment_total_ltv
    FROM ltv GROUP BY customer_segment"""))
def ltv_by_segment(t):
    return analytics.ltv_by_segment(t.ltv)


@query("segment_orders", sql("""
    SELECT customer_segment, COUNT(DISTINCT c.customer_id) AS customers, COUNT(DISTINCT h.order_id) AS orders
    FROM cust c LEFT JOIN headers h ON h.customer_id = c.customer_id GROUP BY customer_segment"""))
def segment_orders(t):
    return analytics.segment_orders(t.customers, t.headers)


# The labels of the tiers, each with its least and greatest count.
FREQUENCY = [("No Orders", 0, 0), ("Light (1-8 orders)", 1, 8), ("Regular (9-14 orders)", 9, 14),
             ("Frequent (15+ orders)", 15, None)]
BREADTH = [("No Purchases", 0, 0), ("Narrow (1-2 categories)", 1, 2), ("Moderate (3-4 categories)", 3, 4),
           ("Broad (5+ categories)", 5, None)]


def _tiers(per_customer: str, bounds: list, tier: str, average: str) -> str:
    """Customers by segment and tier: a table of bounds, met by range."""
    rows = ", ".join(f"('{label}', {low}, {'NULL' if high is None else high})" for label, low, high in bounds)
    return sql(f"""
    SELECT COALESCE(customer_segment, 'Unknown') AS customer_segment, label AS {tier},
           COUNT(*) AS num_customers, {rnd("SUM(n) / COUNT(*)")} AS {average}
    FROM counted JOIN bounds ON n >= low AND n <= COALESCE(high, n) GROUP BY ALL""",
               counted=per_customer, bounds=f"SELECT * FROM (VALUES {rows}) AS v(label, low, high)")


@query("frequency_tiers", _tiers("""
    SELECT customer_segment, (SELECT COUNT(order_id) FROM headers h WHERE h.customer_id = c.customer_id) AS n
    FROM cust c""", FREQUENCY, "frequency_tier", "avg_orders"))
def frequency_tiers(t):
    return analytics.frequency_tiers(t.customers, t.headers)


@query("category_breadth_tiers", _tiers("""
    SELECT customer_segment, COALESCE(k, 0) AS n FROM cust LEFT JOIN (
      SELECT customer_id, COUNT(DISTINCT category) AS k FROM fact JOIN prod USING (product_id) GROUP BY customer_id)
    USING (customer_id)""", BREADTH, "breadth_tier", "avg_categories"))
def category_breadth_tiers(t):
    return analytics.category_breadth_tiers(t.customers, t.fact, t.products)


@query("gross_margin_by_category", sql(f"""
    SELECT category, {esum('net_amount')} AS total_revenue, {esum('quantity * unit_cost')} AS total_cost,
           {rnd(f"{esum('net_amount')} - {esum('quantity * unit_cost')}")} AS gross_margin
    FROM lines JOIN (SELECT product_id, category, unit_cost FROM prod WHERE unit_cost IS NOT NULL) USING (product_id)
    GROUP BY category"""))
def gross_margin_by_category(t):
    return analytics.gross_margin_by_category(t.lines, t.products)


@query("ship_lead_time", sql(f"""
    SELECT channel, COUNT(*) AS shipped_lines, {rnd("SUM(ship_date - order_date) / COUNT(*)")} AS avg_days_to_ship,
           COUNT(*) FILTER (ship_date < order_date) AS shipped_before_order
    FROM fact WHERE order_date IS NOT NULL AND ship_date IS NOT NULL GROUP BY channel"""))
def ship_lead_time(t):
    return analytics.ship_lead_time(t.fact)


@query("ship_before_order", sql("""
    SELECT order_id, order_line_id, order_date, ship_date, CAST(order_date - ship_date AS INTEGER) AS days_early
    FROM fact WHERE ship_date < order_date"""))
def ship_before_order(t):
    early = t.fact.where(F.col("ship_date") < F.col("order_date"))
    return early.select("order_id", "order_line_id", "order_date", "ship_date",
                        F.datediff("order_date", "ship_date").alias("days_early"))


@query("exclusive_channel_customers", sql("""
    SELECT customer_id, full_name, MIN(f.channel) AS only_channel
    FROM cust c JOIN fact f USING (customer_id)
    GROUP BY customer_id, full_name HAVING COUNT(DISTINCT f.channel) = 1"""))
def exclusive_channel_customers(t):
    """Customers all of whose purchases went through one channel, whichever it is."""
    return analytics.exclusive_channel_customers(t.customers, t.fact)


@query("weekend_signups", sql("""
    SELECT CAST(year(signup_date) AS INTEGER) AS signup_year, COUNT(*) AS weekend_signups FROM cust
    WHERE strftime(signup_date, '%w') IN ('0', '6') GROUP BY 1"""))
def weekend_signups(t):
    weekend = t.customers.where(dates.is_weekend(F.col("signup_date")) == 1)
    return weekend.groupBy(F.year("signup_date").alias("signup_year")).agg(
        F.count("*").alias("weekend_signups"))


@query("zero_activity_days", sql("SELECT order_date, day_name FROM daily WHERE order_line_count = 0"))
def zero_activity_days(t):
    return gold.agg_daily_sales(t.sales_days, t.fact).where("order_line_count = 0").select(
        "order_date", "day_name")


def _inactive_sql(member: str, members: str, events: str) -> str:
    """Every member with every day, less the active ones; consecutive days share a number."""
    return sql(f"""
    SELECT {member}, MIN(date) AS first_day, MAX(date) AS last_day, CAST(COUNT(*) AS INTEGER) AS days
    FROM (SELECT {member}, date, date - CAST(row_number() OVER (PARTITION BY {member} ORDER BY date) AS INTEGER) AS island
          FROM (SELECT DISTINCT {member} FROM {members} WHERE {member} IS NOT NULL) m, window_days
          WHERE NOT EXISTS (SELECT 1 FROM active a WHERE a.{member} = m.{member} AND a.order_date = date))
    GROUP BY {member}, island""", active=f"SELECT DISTINCT {member}, order_date FROM {events}")


def _inactive(t, members, events, member):
    first, last = (t.order_days.agg(f("date")).scalar() for f in (F.min, F.max))
    return windows.inactive_spans(members, events, member, "order_date", first, last)


@query("inactive_days_by_customer", _inactive_sql("customer_id", "cust", "headers"))
def inactive_days_by_customer(t):
    return _inactive(t, t.customers, semi_join(t.headers, t.customers, "customer_id"), "customer_id")


@query("inactive_days_by_category", _inactive_sql("category", "prod", "fact JOIN prod USING (product_id)"))
def inactive_days_by_category(t):
    goods = t.products.select("product_id", "category")
    return _inactive(t, goods, t.fact.select("product_id", "order_date").join(goods, "product_id"), "category")


@query("after_termination_share", sql(f"""
    SELECT employee_id, full_name, termination_date, COUNT(*) AS total_lines,
           COUNT(*) FILTER (order_date > termination_date) AS lines_after_term,
           {rnd("100.0::DOUBLE * COUNT(*) FILTER (order_date > termination_date) / COUNT(*)", 1)} AS pct_after_term
    FROM fact JOIN emp USING (employee_id) WHERE termination_date IS NOT NULL AND order_date IS NOT NULL
    GROUP BY employee_id, full_name, termination_date"""))
def after_termination_share(t):
    return analytics.after_termination_share(t.fact, t.employees)


@query("tenure_by_status", sql(f"""
    SELECT CASE WHEN termination_date IS NULL THEN 'active' ELSE 'terminated' END AS status, COUNT(*) AS n,
           {rnd("SUM(COALESCE(termination_date, DATE '2001-12-31') - hire_date) / COUNT(*)", 1)} AS avg_tenure_days
    FROM emp GROUP BY 1"""))
def tenure_by_status(t):
    return analytics.tenure_by_status(t.employees, F.lit(SNAPSHOT))


@query("repeat_purchase_pairs", sql("""
    SELECT customer_id, product_id, COUNT(*) AS n FROM fact GROUP BY ALL HAVING COUNT(*) > 1"""))
def repeat_purchase_pairs(t):
    return analytics.repeat_purchase_pairs(t.fact)
