"""Dates and calendars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date shapes as (pattern of the whole text, 1-based start of year, month, day).
DATE_SHAPES = (
    (r"(?s)^[0-9]{4}-[0-9]{2}-[0-9]{2}( ..:..:..)?\z", (1, 6, 9)),
    (r"^[0-9]{2}/[0-9]{2}/[0-9]{4}\z", (7, 1, 4)),
)

# End date of an open version, snapshot length of a year.
OPEN_END = "9999-12-31"
DAYS_PER_YEAR = 365.25


def parse_mixed_date(c: Column) -> Column:
    """Date from any accepted shape; other shapes and impossible dates give NULL.

    The shape only says where the parts stand: the text is put into one order and converted once.
    """
    iso = None
    for pattern, (year, month, day) in DATE_SHAPES:
        if (year, month, day) == (1, 6, 9):
            text = F.substring(c, 1, 10)
        else:
            text = F.concat_ws("-", F.substring(c, year, 4), F.substring(c, month, 2), F.substring(c, day, 2))
        iso = F.when(c.rlike(pattern), text) if iso is None else iso.when(c.rlike(pattern), text)
    return iso.try_cast("date")


def date_key(d: Column) -> Column:
    """``YYYYMMDD`` as an integer, NULL for NULL. Arithmetic, so no text is built per row."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def day_of_week(d: Column) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(d) - 1


def is_weekend(d: Column) -> Column:
    return F.dayofweek(d).isin(1, 7).cast("int")


def date_parts(d: Column) -> dict[str, Column]:
    """The usual attributes of a calendar day, in output order."""
    return {
        "year": F.year(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "quarter": F.quarter(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_week": day_of_week(d),
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": is_weekend(d),
    }


def fiscal_year(d: Column, start_month: int = 10) -> Column:
    """The fiscal year is named after the calendar year in which it ends."""
    return F.year(d) + (F.month(d) >= start_month).cast("int")


def fiscal_quarter(d: Column, start_month: int = 10) -> Column:
    return F.floor(F.pmod(F.month(d) - start_month, F.lit(12)) / 3).cast("int") + 1


def tenure_years(start: Column, end: Column, snapshot: Column) -> Column:
    return F.round(F.datediff(F.coalesce(end, snapshot), start) / DAYS_PER_YEAR, 1)


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def month_end(d: Column) -> Column:
    return F.last_day(d)


def year_month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def month_number(d: Column) -> Column:
    """Months since year 0; differences are whole calendar months."""
    return F.year(d) * 12 + F.month(d)


def nth_sunday(year: Column, month: int, n: int) -> Column:
    first = F.make_date(year, F.lit(month), F.lit(1))
    return F.next_day(F.date_sub(first, 1), "Sunday") + F.expr(f"INTERVAL {7 * (n - 1)} DAY")


def local_time_us_dst(utc: Column, standard_offset_hours: int = -6) -> Column:
    """UTC to US local time; summer time is decided by the UTC date alone."""
    day = F.to_date(utc)
    summer = (day >= nth_sunday(F.year(utc), 3, 2)) & (day < nth_sunday(F.year(utc), 11, 1))
    hours = F.when(summer, standard_offset_hours + 1).otherwise(standard_offset_hours)
    return F.date_trunc("second", utc) + F.make_dt_interval(F.lit(0), hours)


def last_friday(d: Column) -> Column:
    end = F.last_day(d)
    return F.date_sub(end, F.pmod(F.dayofweek(end) - 6, F.lit(7)))


def calculated_month_end(d: Column) -> Column:
    """Last Friday of the month, but the 31st in December."""
    return F.when(F.month(d) == 12, F.last_day(d)).otherwise(last_friday(d))


def trimester_end(d: Column) -> Column:
    """Last Friday of April or August, or 31 December."""
    closing = F.ceil(F.month(d) / 4).cast("int") * 4
    return calculated_month_end(F.make_date(F.year(d), closing, F.lit(1)))
