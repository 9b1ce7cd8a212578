"""Named measures over the fact, evaluated for any group-by set and filter.

A measure is an expression over a few base aggregates. Only the base aggregates
that the requested measures need are computed, all in one pass over the fact.
Distinct counts shuffle on (group, id), so a heavy group spreads over its ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaymill.functions.numbers import money_sum, product_sum, safe_ratio

def _sums() -> dict[str, Column]:
    q = F.col("quantity")
    return {
        "_gross": product_sum(q * F.col("unit_price")),
        "_net": money_sum(F.col("net_amount")),
        "_units": F.sum("quantity"),
        "_cogs": product_sum(q * F.col("unit_cost")),
    }


_DISTINCT = {"_orders": "order_id", "_customers": "customer_id"}


def _definitions() -> dict[str, tuple[list[str], Column]]:
    """Measure -> (base aggregates it needs, expression over them)."""
    margin = F.col("_net") - F.col("_cogs")
    return {
        "total_gross_revenue": (["_gross"], F.col("_gross")),
        "total_net_revenue": (["_net"], F.col("_net")),
        "total_units_sold": (["_units"], F.col("_units")),
        "total_orders": (["_orders"], F.col("_orders")),
        "average_order_value": (
            ["_net", "_orders"], safe_ratio(F.col("_net"), F.col("_orders"), 0.0)),
        "active_customer_count": (["_customers"], F.col("_customers")),
        "overall_discount_rate": (
            ["_gross", "_net"],
            safe_ratio(F.col("_gross") - F.col("_net"), F.col("_gross"), 0.0)),
        "total_cogs": (["_cogs"], F.col("_cogs")),
        "gross_margin": (["_net", "_cogs"], F.round(margin, 2)),
        "gross_margin_pct": (
            ["_net", "_cogs"], safe_ratio(F.round(margin, 2), F.col("_net"), 0.0)),
    }


def measures(
    df: DataFrame, names: Sequence[str], by: Sequence[str] = (), where: Column | None = None, tasks: int = 0
) -> DataFrame:
    """The named measures per combination of ``by`` over the rows that pass ``where``.

    ``df`` is the fact with the dimension attributes it is sliced by. A distinct count of one id holds the
    pairs (group, id) in hash tables; with ``tasks`` the rows are first dealt to that many tasks by group and id.
    """
    defined = _definitions()
    rows = df if where is None else df.where(where)
    needed = list(dict.fromkeys(base for n in names for base in defined[n][0]))
    sums = {k: v for k, v in _sums().items() if k in needed}
    distinct = {k: c for k, c in _DISTINCT.items() if k in needed}
    sums |= {k: F.count_distinct(c) for k, c in distinct.items()}
    if tasks and len(distinct) == 1:
        rows = rows.repartition(tasks, *by, *distinct.values())
    out = rows.groupBy(*by).agg(*[v.alias(k) for k, v in sums.items()])
    return out.select(*by, *[defined[n][1].alias(n) for n in names])


def prior_year(
    df: DataFrame, by: Sequence[str] = ("year", "month"), value: str = "total_net_revenue"
) -> DataFrame:
    """Net revenue next to the same period one year earlier; ``by`` contains ``year``.

    A window over the aggregated periods: one row per year and group, read once.
    """
    current = measures(df, [value], by)
    others = [b for b in by if b != "year"]
    last_year = Window.partitionBy(*others).orderBy("year").rangeBetween(-1, -1)
    # Rows without a year are peers of themselves, not of an earlier year.
    earlier = F.when(F.col("year").isNotNull(), F.max(value).over(last_year))
    before = F.col("net_revenue_py")
    growth = safe_ratio(F.col(value) - before, before, 0.0)
    return current.withColumn("net_revenue_py", earlier).withColumn("net_revenue_yoy_pct", growth)


def _same_days_last_year(days: DataFrame, by: Sequence[str]) -> DataFrame:
    """The days one year before those of each group, every day once.

    29 February maps to the 28th. A group that holds both 27 and 28 February ends with its
    month, so where the year before is a leap year it takes in the 29th as well.
    """
    shifted = days.select(*by, F.add_months("date", -12).alias("date"))
    ends = (F.month("date") == 2) & F.dayofmonth("date").isin(27, 28)
    whole = days.where(ends).groupBy(*by, F.year("date").alias("_year")).agg(
        F.count_if(F.dayofmonth("date") == 27).alias("_27"), F.count_if(F.dayofmonth("date") == 28).alias("_28"))
    leap = F.last_day(F.make_date(F.col("_year") - 1, F.lit(2), F.lit(1)))
    added = whole.where((F.col("_27") > 0) & (F.col("_28") > 0) & (F.dayofmonth(leap) == 29)).select(*by, leap.alias("date"))
    return shifted.unionByName(added).distinct()


def same_period_last_year(
    df: DataFrame,
    calendar: DataFrame,
    calendar_by: Sequence[str] = (),
    by: Sequence[str] = (),
    chosen: Column | None = None,
    day: str = "order_date",
    amount: str = "net_amount",
) -> DataFrame:
    """Net revenue of the chosen days next to that of the same days one year earlier.

    ``chosen`` filters ``calendar`` (one row per ``date``), as a date filter on a page does; the
    earlier days come from the chosen ones and may lie outside them. Groups are
    ``calendar_by``, columns of the calendar, and ``by``, columns of ``df``; a group shows up when
    either side has rows. The lines are read once and summed to days before they meet
    the days' two roles.
    """
    days = calendar if chosen is None else calendar.where(chosen)
    days = days.select(*calendar_by, "date")
    roles = days.withColumn("_now", F.lit(True)).unionByName(
        _same_days_last_year(days, calendar_by).withColumn("_now", F.lit(False)))
    cents = F.sum(F.rint(F.col(amount) * 100).cast("long"))
    totals = df.groupBy(F.col(day).alias("date"), *by).agg(cents.alias("_cents"))
    both = totals.join(roles, "date").groupBy(*calendar_by, *by).agg(
        (F.sum(F.when(F.col("_now"), F.col("_cents"))) / 100).alias("total_net_revenue"),
        (F.sum(F.when(~F.col("_now"), F.col("_cents"))) / 100).alias("net_revenue_py"))
    growth = safe_ratio(F.col("total_net_revenue") - F.col("net_revenue_py"), F.col("net_revenue_py"), 0.0)
    return both.withColumn("net_revenue_yoy_pct", growth)
