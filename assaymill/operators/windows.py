"""Windows along periods: running totals, moving averages, changes and gaps.

Meant for rows that are already aggregated to days, months, years or distinct
days per entity, so the calendar bounds every group. For rows at line grain use
``operators.ordered``, which splits groups of any size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from assaymill.functions.numbers import percentage


def along(order: Sequence[str], by: Sequence[str] = ()) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(*order)


def money_over(value: str, w: WindowSpec) -> Column:
    """Money summed over a window frame, in whole cents."""
    return F.sum(F.rint(F.col(value) * 100).cast("long")).over(w) / 100


def running_total(
    df: DataFrame, value: str, order: Sequence[str], by: Sequence[str] = (), frame: str = "rows",
    name: str = "running_total",
) -> DataFrame:
    """Cumulative money. ``frame="range"`` counts rows that tie on ``order`` together."""
    w = along(order, by)
    edge = (Window.unboundedPreceding, Window.currentRow)
    w = w.rowsBetween(*edge) if frame == "rows" else w.rangeBetween(*edge)
    return df.withColumn(name, money_over(value, w))


def running_max(
    df: DataFrame, value: str, order: Sequence[str], by: Sequence[str] = (),
    name: str = "running_max",
) -> DataFrame:
    w = along(order, by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.max(value).over(w))


def moving_average(
    df: DataFrame, value: str, order: Sequence[str], n: int, by: Sequence[str] = (),
    name: str | None = None,
) -> DataFrame:
    """Mean of the last ``n`` rows; fewer at the start."""
    w = along(order, by).rowsBetween(1 - n, Window.currentRow)
    mean = F.round(money_over(value, w) / F.count(value).over(w), 2)
    return df.withColumn(name or f"moving_avg_{n}", mean)


def first_crossing(df: DataFrame, value: str, order: Sequence[str], threshold: float) -> DataFrame:
    """The first row where the running total exceeds ``threshold``."""
    running = running_total(df, value, order)
    return running.where(F.col("running_total") > threshold).orderBy(*order).limit(1)


def period_change(
    df: DataFrame, value: str, order: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Previous value, change and percentage change."""
    change = F.col(value) - F.col("prior_amount")
    return df.withColumn("prior_amount", F.lag(value).over(along(order, by))).select(
        "*", F.round(change, 2).alias("change"),
        percentage(change, F.col("prior_amount"), 1).alias("pct_change"))


def largest_drops(df: DataFrame, value: str, order: Sequence[str], n: int) -> DataFrame:
    """The ``n`` most negative changes."""
    changes = period_change(df, value, order).where("change IS NOT NULL")
    return changes.orderBy("change", *order).limit(n)


def next_value(
    df: DataFrame, value: str, order: Sequence[str], by: Sequence[str] = (), name: str = "next"
) -> DataFrame:
    return df.withColumn(name, F.lead(value).over(along(order, by)))


def gap_between_events(df: DataFrame, entity: str, day: str) -> DataFrame:
    """Days since the entity's previous active day.

    Distinct days first: an entity then has at most as many rows as the calendar
    has days, however many events it had.
    """
    days = df.where(F.col(day).isNotNull()).select(entity, day).distinct()
    return days.withColumn("prev_date", F.lag(day).over(along([day], [entity]))).withColumn(
        "days_since_prev", F.datediff(day, "prev_date"))


def inactive_spans(
    members: DataFrame, events: DataFrame, member: str, day: str, first: Column, last: Column
) -> DataFrame:
    """For every member, the stretches from ``first`` to ``last`` without an event: member, first_day, last_day, days.

    Islands instead of a calendar per member: the work is linear in active days. A member
    without any event has one stretch; ``first`` and ``last`` are literals or scalar subqueries.
    """
    days = events.where(F.col(member).isNotNull() & F.col(day).between(first, last)).select(member, F.col(day).alias("_day")).distinct()
    w = along(["_day"], [member])
    beside = days.select(member, "_day", F.lag("_day").over(w).alias("_before"), F.lead("_day").over(w).alias("_after"))

    def span(start: Column, end: Column) -> Column:
        return F.struct(start.alias("first_day"), end.alias("last_day"))

    ahead = F.when(F.col("_before").isNull(), span(first, F.date_sub("_day", 1)))
    behind = span(F.date_add("_day", 1), F.coalesce(F.date_sub("_after", 1), last))
    spans = beside.select(member, F.inline(F.array_compact(F.array(ahead, behind))))
    idle = members.select(member).where(F.col(member).isNotNull()).distinct().join(days, member, "left_anti")
    whole = idle.select(member, first.alias("first_day"), last.alias("last_day"))
    found = spans.unionByName(whole).where("first_day <= last_day")
    return found.withColumn("days", F.datediff("last_day", "first_day") + 1)
