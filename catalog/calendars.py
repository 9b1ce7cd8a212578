"""Date and calendar functions over order, ship and event dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from assaymill.functions import dates
from catalog.model_sql import datekey, rnd, sql
from catalog.registry import query

SNAPSHOT = dt.date(2001, 12, 31)


def _days(t):
    return t.raw("orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))


def _days_sql(columns: str) -> str:
    return f"SELECT o_orderkey, {columns} FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders)"


@query("date_parts", _days_sql("""
    CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, monthname(day) AS month_name,
    CAST((month(day) - 1) // 3 + 1 AS INTEGER) AS quarter, CAST(day(day) AS INTEGER) AS day_of_month,
    CAST(strftime(day, '%w') AS INTEGER) AS day_of_week, strftime(day, '%A') AS day_name,
    CASE WHEN strftime(day, '%w') IN ('0', '6') THEN 1 ELSE 0 END AS is_weekend"""))
def date_parts(t):
    parts = dates.date_parts(F.col("day"))
    return _days(t).select("o_orderkey", *[c.alias(n) for n, c in parts.items()])


@query("date_key", sql(f"SELECT order_id, order_date, {datekey('order_date')} AS datekey FROM headers"))
def date_key(t):
    return t.headers.select(
        "order_id", "order_date", dates.date_key(F.col("order_date")).alias("datekey"))


@query("fiscal_year_quarter", _days_sql("""
    CAST(year(day + INTERVAL 3 MONTH) AS INTEGER) AS fiscal_year,
    CAST(quarter(CAST(date_trunc('month', day) + INTERVAL 3 MONTH AS DATE)) AS INTEGER) AS fiscal_quarter"""))
def fiscal_year_quarter(t):
    day = F.col("day")
    return _days(t).select("o_orderkey", dates.fiscal_year(day).alias("fiscal_year"),
                           dates.fiscal_quarter(day).alias("fiscal_quarter"))


@query("days_between", sql("""
    SELECT order_id, order_line_id, CAST(ship_date - order_date AS INTEGER) AS days_to_ship FROM sales_feed
    WHERE order_date IS NOT NULL AND ship_date IS NOT NULL"""))
def days_between(t):
    dated = t.sales_feed.where("order_date IS NOT NULL AND ship_date IS NOT NULL")
    return dated.select("order_id", "order_line_id",
                        F.datediff("ship_date", "order_date").alias("days_to_ship"))


@query("tenure_years", sql(f"""
    SELECT employee_id, hire_date, termination_date,
           {rnd("(COALESCE(termination_date, DATE '2001-12-31') - hire_date) / 365.25::DOUBLE", 1)} AS tenure_years FROM emp"""))
def tenure_years(t):
    years = dates.tenure_years(F.col("hire_date"), F.col("termination_date"), F.lit(SNAPSHOT))
    return t.employees.select(
        "employee_id", "hire_date", "termination_date", years.alias("tenure_years"))


@query("month_start_end", _days_sql("""
    CAST(date_trunc('month', day) AS DATE) AS month_start, last_day(day) AS month_end"""))
def month_start_end(t):
    day = F.col("day")
    return _days(t).select("o_orderkey", dates.month_start(day).alias("month_start"),
                           dates.month_end(day).alias("month_end"))


@query("year_month_bucket", _days_sql("strftime(day, '%Y-%m') AS year_month"))
def year_month_bucket(t):
    return _days(t).select("o_orderkey", dates.year_month(F.col("day")).alias("year_month"))


@query("months_between_buckets", sql("""
    SELECT order_id, order_line_id, CAST(datediff('month', order_date, ship_date) AS INTEGER) AS months_to_ship
    FROM sales_feed WHERE order_date IS NOT NULL AND ship_date IS NOT NULL"""))
def months_between_buckets(t):
    dated = t.sales_feed.where("order_date IS NOT NULL AND ship_date IS NOT NULL")
    months = dates.month_number(F.col("ship_date")) - dates.month_number(F.col("order_date"))
    return dated.select("order_id", "order_line_id", months.alias("months_to_ship"))


@query("add_interval", _days_sql("""
    CAST(day + INTERVAL 30 DAY AS DATE) AS due_date,
    CAST(date_trunc('month', day) + INTERVAL 1 MONTH AS DATE) AS next_month_start"""))
def add_interval(t):
    return _days(t).select(
        "o_orderkey", F.date_add("day", 30).alias("due_date"),
        F.add_months(dates.month_start(F.col("day")), 1).alias("next_month_start"))


@query("local_time_us_dst", """
    WITH bounds AS (
        SELECT event_id, date_trunc('second', ts) AS utc, CAST(ts AS DATE) AS day,
               make_date(CAST(year(ts) AS INTEGER), 3, 1) AS mar, make_date(CAST(year(ts) AS INTEGER), 11, 1) AS nov FROM events)
    SELECT event_id, strftime(utc - CASE WHEN day >= mar + CAST((7 - dayofweek(mar)) % 7 + 7 AS INTEGER)
                                          AND day < nov + CAST((7 - dayofweek(nov)) % 7 AS INTEGER)
                                         THEN INTERVAL 5 HOUR ELSE INTERVAL 6 HOUR END, '%Y-%m-%d %H:%M:%S') AS local_time
    FROM bounds""")
def local_time_us_dst(t):
    local = dates.local_time_us_dst(F.col("ts"))
    return t.raw("events", "event_id", "ts").select(
        "event_id", F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("local_time"))


LAST_FRIDAY = "CAST({e} - CAST((dayofweek({e}) + 2) % 7 AS INTEGER) AS DATE)"


@query("last_friday_month_end", _days_sql(f"""
    CASE WHEN month(day) = 12 THEN last_day(day) ELSE {LAST_FRIDAY.format(e='last_day(day)')} END AS calculated_month_end"""))
def last_friday_month_end(t):
    return _days(t).select(
        "o_orderkey", dates.calculated_month_end(F.col("day")).alias("calculated_month_end"))


@query("trimester_end", _days_sql(f"""
    CASE WHEN month(day) > 8 THEN make_date(CAST(year(day) AS INTEGER), 12, 31)
         WHEN month(day) > 4 THEN {LAST_FRIDAY.format(e='make_date(CAST(year(day) AS INTEGER), 8, 31)')}
         ELSE {LAST_FRIDAY.format(e='make_date(CAST(year(day) AS INTEGER), 4, 30)')} END AS trimester_end"""))
def trimester_end(t):
    return _days(t).select("o_orderkey", dates.trimester_end(F.col("day")).alias("trimester_end"))
