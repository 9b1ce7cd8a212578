"""Named measures by slices of the model, and the group-bys of the report pages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from assaymill.functions.numbers import money_sum
from assaymill.operators import presence, quality
from assaymill.plans import bi
from assaymill.plans.measures import measures, prior_year, same_period_last_year
from assaymill.runtime import new_scratch_path, tasks_for
from assaymill.sources.sinks import create_or_replace
from catalog.model_sql import esum, isum, sql
from catalog.registry import query

GROSS, NET, COGS = esum("quantity * unit_price"), esum("net_amount"), esum("quantity * unit_cost")
ORDERS, CUSTOMERS = "COUNT(DISTINCT order_id)", "COUNT(DISTINCT customer_id)"


def ratio(num: str, den: str) -> str:
    return f"COALESCE(({num}) / NULLIF(({den}), 0), 0)"


def margin() -> str:
    return f"ROUND(({NET} - {COGS}) * 100) / 100"


MODEL = """
    SELECT fact.*, p.category, p.brand, p.product_name, p.unit_cost, d.year, d.month, d.month_name, d.date
    FROM fact LEFT JOIN (SELECT product_id, category, brand, product_name, unit_cost FROM prod) p USING (product_id)
    LEFT JOIN cal d USING (datekey)"""


def _model(t, *attributes: str):
    """The fact with the dimension attributes a slice asks for, by left joins."""
    goods = t.products.select("product_id", *[
        a for a in ("category", "brand", "product_name", "unit_cost") if a in attributes])
    days = t.calendar.select("datekey", *[
        a for a in ("year", "month", "month_name", "date") if a in attributes])
    out = t.fact
    if len(goods.columns) > 1:
        # Not broadcast, the join also gets as many tasks as the lines need.
        out = out.join(goods.repartition(_tasks(t), "product_id"), "product_id", "left")
    if len(days.columns) > 1:
        out = out.join(days, "datekey", "left")
    return out


def _tasks(t) -> int:
    return tasks_for(t.spark, t.raw("lineitem").count())


def _register(name: str, expression: str) -> None:
    statement = sql(f"SELECT category, year, {expression} AS {name} FROM model GROUP BY category, year",
                    model=MODEL)
    attributes = ["category", "year"] + (["unit_cost"] if "unit_cost" in expression else [])
    query(name, statement)(lambda t: measures(_model(t, *attributes), [name], ["category", "year"], tasks=_tasks(t)))


_register("total_gross_revenue", GROSS)
_register("total_net_revenue", NET)
_register("total_units_sold", isum("quantity"))
_register("total_orders", ORDERS)
_register("average_order_value", ratio(NET, ORDERS))
_register("active_customer_count", CUSTOMERS)
_register("overall_discount_rate", ratio(f"{GROSS} - {NET}", GROSS))
_register("total_cogs", COGS)
_register("gross_margin", margin())
_register("gross_margin_pct", ratio(margin(), NET))

MONTHS = f"SELECT year, month, {NET} AS total_net_revenue FROM model GROUP BY year, month"


@query("net_revenue_py", sql("""
    SELECT c.year, c.month, c.total_net_revenue, p.total_net_revenue AS net_revenue_py
    FROM months c LEFT JOIN months p ON p.year = c.year - 1 AND p.month = c.month""", model=MODEL, months=MONTHS))
def net_revenue_py(t):
    return prior_year(_model(t, "year", "month")).drop("net_revenue_yoy_pct")


@query("net_revenue_yoy_pct", sql("""
    SELECT c.year, c.month, c.total_net_revenue, p.total_net_revenue AS net_revenue_py,
           COALESCE((c.total_net_revenue - p.total_net_revenue) / NULLIF(p.total_net_revenue, 0), 0) AS net_revenue_yoy_pct
    FROM months c LEFT JOIN months p ON p.year = c.year - 1 AND p.month = c.month""", model=MODEL, months=MONTHS))
def net_revenue_yoy_pct(t):
    return prior_year(_model(t, "year", "month"))


def _slices_sql(*groups: str) -> str:
    return sql(" UNION ALL ".join(
        f"SELECT '{g or 'all'}' AS slice, CAST({g or 'NULL'} AS VARCHAR) AS member, {ORDERS} AS total_orders, "
        f"{CUSTOMERS} AS active_customer_count FROM model {f'GROUP BY {g}' if g else ''}" for g in groups), model=MODEL)


@query("distinct_counts_by_slices", _slices_sql("category", "year", "month", ""))
def distinct_counts_by_slices(t):
    """Two distinct counts for four groupings from one kept pre-aggregation."""
    path = new_scratch_path(t.spark, "presence")
    kept = create_or_replace(presence.presence(
        _model(t, "category", "year", "month"), ["category", "year", "month"],
        {"total_orders": "order_id", "active_customer_count": "customer_id"}), path)
    names = ["total_orders", "active_customer_count"]
    return quality.stacked([
        presence.distinct_counts(kept, [g] if g else [], names).select(
            F.lit(g or "all").alias("slice"), (F.col(g) if g else F.lit(None)).cast("string").alias("member"), *names)
        for g in ("category", "year", "month", "")])


# A page cut to these days: it begins inside a month and ends with a February after a leap year.
PAGE_FROM, PAGE_TO = dt.date(1997, 1, 15), dt.date(2001, 2, 28)


def _last_year_sql(keys: list[str], source: str = "fact") -> str:
    """Chosen days and the days a year before, each set joined with the lines by itself."""
    days = [k for k in keys if k != "category"]
    named, given = ", ".join([*days, "k"]), ", ".join([*keys, "k"])
    chosen = (f"SELECT *, date AS day, 1 AS k FROM cal WHERE date BETWEEN DATE '{PAGE_FROM}' AND DATE '{PAGE_TO}'")
    alike = " AND ".join(f"o.{d} = c.{d}" for d in [*days, "k"])
    earlier = f"""
        SELECT {named}, CAST(date - INTERVAL 1 YEAR AS DATE) AS date FROM chosen UNION
        SELECT {named}, CAST(date - INTERVAL 1 YEAR AS DATE) + 1 FROM chosen c
        WHERE strftime(date, '%m-%d') = '02-28' AND month(CAST(date - INTERVAL 1 YEAR AS DATE) + 1) = 2
          AND EXISTS (SELECT 1 FROM chosen o WHERE o.date = c.date - 1 AND {alike})"""
    now = f"SELECT {given}, {NET} AS total_net_revenue FROM chosen JOIN {source} ON order_date = date GROUP BY {given}"
    before = f"SELECT {given}, {NET} AS net_revenue_py FROM earlier JOIN {source} ON order_date = date GROUP BY {given}"
    return sql(f"""
        SELECT {"".join(f"{k}, " for k in keys)}total_net_revenue, net_revenue_py,
               COALESCE((total_net_revenue - net_revenue_py) / NULLIF(net_revenue_py, 0), 0) AS net_revenue_yoy_pct
        FROM now_side FULL JOIN before_side USING ({given})""",
        chosen=chosen, earlier=earlier, now_side=now, before_side=before,
        sold="SELECT fact.*, p.category FROM fact JOIN (SELECT product_id, category FROM prod WHERE category IS NOT NULL) p USING (product_id)")


def _on_page(t):
    return t.calendar.withColumn("day", F.col("date")), F.col("date").between(PAGE_FROM, PAGE_TO)


@query("prior_year_days", _last_year_sql(["day"]))
def prior_year_days(t):
    """Every chosen day next to the same day a year earlier, which may lie outside the page."""
    calendar, chosen = _on_page(t)
    return same_period_last_year(t.fact, calendar, ["day"], chosen=chosen)


@query("prior_year_months", _last_year_sql(["year", "month", "category"], "sold"))
def prior_year_months(t):
    """Months cut by the page's filter, by category."""
    calendar, chosen = _on_page(t)
    goods = t.products.where("category IS NOT NULL").select("product_id", "category")
    return same_period_last_year(t.fact.join(goods, "product_id"), calendar, ["year", "month"], ["category"], chosen)


@query("prior_year_page", _last_year_sql([]))
def prior_year_page(t):
    """One figure for the whole page."""
    calendar, chosen = _on_page(t)
    return same_period_last_year(t.fact, calendar, chosen=chosen)


FROM_DAY, TO_DAY = dt.date(1997, 1, 1), dt.date(1999, 12, 31)


@query("visual_queries", sql(f"""
    SELECT product_name, category, brand, {NET} AS total_net_revenue, {isum('quantity')} AS total_units_sold,
           {ORDERS} AS total_orders, {margin()} AS gross_margin
    FROM model GROUP BY product_name, category, brand""", model=MODEL))
def visual_queries(t):
    """Product ranking table, over all dates."""
    return measures(
        _model(t, "product_name", "category", "brand", "unit_cost"),
        ["total_net_revenue", "total_units_sold", "total_orders", "gross_margin"],
        ["product_name", "category", "brand"], tasks=_tasks(t))


@query("visual_category_bar", sql(f"""
    SELECT category, {NET} AS total_net_revenue, {GROSS} AS total_gross_revenue,
           {ratio(f"{GROSS} - {NET}", GROSS)} AS overall_discount_rate FROM model GROUP BY category""", model=MODEL))
def visual_category_bar(t):
    return measures(_model(t, "category"),
                    ["total_net_revenue", "total_gross_revenue", "overall_discount_rate"], ["category"])


REGIONS = ["Central", "East", "Northeast", "South", "West"]


@query("visual_region_matrix", sql(f"""
    SELECT category, {", ".join(
        esum(f"CASE WHEN region = '{r}' THEN net_amount END") + f" AS {r.lower()}" for r in REGIONS)}
    FROM lines LEFT JOIN emp USING (employee_id) LEFT JOIN (SELECT product_id, category FROM prod) USING (product_id)
    GROUP BY category"""))
def visual_region_matrix(t):
    """Category by region; the region list is the model's fixed one, so no extra pass finds it."""
    sold = t.lines.join(t.employees.select("employee_id", "region"), "employee_id", "left").join(
        t.products.select("product_id", "category"), "product_id", "left")
    wide = bi.matrix(sold, "category", "region", REGIONS, money_sum(F.col("net_amount")))
    return wide.withColumnsRenamed({r: r.lower() for r in REGIONS})


@query("visual_state_segment", sql(f"""
    SELECT state, customer_segment, {NET} AS total_net_revenue, {ORDERS} AS total_orders,
           COUNT(DISTINCT f.customer_id) AS active_customer_count
    FROM fact f LEFT JOIN cust c ON c.customer_id = f.customer_id GROUP BY state, customer_segment"""))
def visual_state_segment(t):
    people = t.customers.select("customer_id", "state", "customer_segment")
    return measures(t.fact.join(people, "customer_id", "left"),
                    ["total_net_revenue", "total_orders", "active_customer_count"],
                    ["state", "customer_segment"])


@query("visual_month_bar", sql(f"""
    SELECT month_name, {NET} AS total_net_revenue, {isum('quantity')} AS total_units_sold FROM model
    GROUP BY month_name""", model=MODEL))
def visual_month_bar(t):
    return measures(_model(t, "month_name"), ["total_net_revenue", "total_units_sold"], ["month_name"])


@query("visual_daily_trend", sql(f"""
    SELECT order_date, {NET} AS total_net_revenue, {ratio(NET, ORDERS)} AS average_order_value FROM fact
    WHERE order_date BETWEEN DATE '{FROM_DAY}' AND DATE '{TO_DAY}' GROUP BY order_date"""))
def visual_daily_trend(t):
    return measures(t.fact, ["total_net_revenue", "average_order_value"], ["order_date"],
                    F.col("order_date").between(FROM_DAY, TO_DAY), _tasks(t))
