"""Interval join, inactive spans and prior-year days against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from assaymill.operators import intervals, windows
from assaymill.plans.measures import same_period_last_year

DAY0 = dt.date(1996, 1, 1)


def day(n):
    return DAY0 + dt.timedelta(days=n)


def brute(events, versions):
    return sorted(((k, e, i, s, t) for k, e, i in events for w, s, t in versions
                   if k is not None and k == w and e and s and s <= e and (t is None or e <= t)), key=str)


def joined(spark, events, versions, kind="date"):
    left = spark.createDataFrame(events, f"k int, at {kind}, i int")
    right = spark.createDataFrame(versions, f"k int, s {kind}, t {kind}")
    return intervals.point_in_time_join(left, right, "k", "at", "s", "t")


def test_against_every_pair(spark):
    r = random.Random(3)
    events = [(r.choice([None, 0, 0, 1, 2, 5]), r.choice([None, *map(day, range(900))]), i) for i in range(600)]
    versions = [(0, day(5), day(5)), (0, day(5), day(5)), (1, day(50), day(40)), (7, day(0), None), (None, day(0), None), (2, None, day(4))]
    for _ in range(150):  # overlapping, open, nested, beginning after the last event
        start = r.randrange(-100, 1000)
        versions.append((r.choice([0, 1, 2]), day(start), r.choice([None, day(start + r.randrange(1200)), day(start + r.randrange(5))])))
    got = sorted(map(tuple, joined(spark, events, versions).select("k", "at", "i", "s", "t").collect()), key=str)
    want = brute(events, versions)
    assert got == want and len(want) > 1000


def test_timestamps_within_a_day(spark):
    at = dt.datetime(2000, 1, 1, 12)
    hour = dt.timedelta(hours=1)
    events = [(1, at, 1), (1, at + hour, 2), (1, at - 30 * hour, 3)]
    got = joined(spark, events, [(1, at, at + hour / 2), (1, at - 48 * hour, None)], "timestamp_ntz")
    assert sorted(r.i for r in got.collect()) == [1, 1, 2, 3]


@pytest.mark.parametrize("events,versions", [([], []), ([(1, day(0), 1)], []), ([], [(1, day(0), None)]), ([(1, None, 1)], [(1, day(0), None)])])
def test_empty_sides(spark, events, versions):
    assert joined(spark, events, versions).count() == 0


def test_one_key_with_many_versions_has_few_candidates(spark):
    """10^4 versions and 10^5 events of one key: 10^9 pairs by the key alone."""
    days = 40_000
    versions = spark.range(10_000).select(F.lit(1).alias("k"), F.date_add(F.lit(DAY0), (F.col("id") * 4).cast("int")).alias("s"), F.when(
        F.col("id") < 9_900, F.date_add(F.lit(DAY0), (F.col("id") * 4 + 3).cast("int"))).alias("t"))
    events = spark.range(100_000).select(F.lit(1).alias("k"), F.date_add(F.lit(DAY0), (F.col("id") * 7919 % days).cast("int")).alias("at"))
    near = intervals.candidates(events, versions, "k", "at", "s", "t").count()
    result = intervals.point_in_time_join(events, versions, "k", "at", "s", "t").count()
    assert result >= 100_000 and near <= 3 * result
    early = events.where(F.col("at") < F.lit(day(30_000)))  # the open versions begin after all of these
    assert intervals.candidates(early, versions, "k", "at", "s", "t").count() < 200_000


def test_inactive_spans(spark):
    r = random.Random(8)
    events = [(r.choice([None, "a", "b", "c"]), r.choice([None, *map(day, range(-20, 140))])) for _ in range(160)]
    events += [("a", day(0)), ("b", day(99)), ("x", day(3))]
    members = [(m,) for m in ("a", "b", "c", "d", "d", None, "x")]
    got = windows.inactive_spans(spark.createDataFrame(members, "m string"), spark.createDataFrame(events, "m string, d date"),
                                 "m", "d", F.lit(day(0)), F.lit(day(99))).collect()
    want = set()
    for m in "abcdx":
        idle = [n for n in range(100) if (m, day(n)) not in events]
        starts = [n for n in idle if n - 1 not in idle]
        ends = [n for n in idle if n + 1 not in idle]
        want |= {(m, day(a), day(b), b - a + 1) for a, b in zip(starts, ends, strict=True)}
    assert {tuple(x) for x in got} == want and len(got) == len(want)


def prior(d):
    return d.replace(year=d.year - 1) if (d.month, d.day) != (2, 29) else dt.date(d.year - 1, 2, 28)


@pytest.mark.parametrize("grain", ["day", "month", "page"])
@pytest.mark.parametrize("span", [(dt.date(2001, 2, 27), dt.date(2001, 3, 2)), (dt.date(2001, 2, 28), dt.date(2001, 3, 2)),
                                  (dt.date(2000, 2, 20), dt.date(2001, 3, 5)), (dt.date(1990, 1, 1), dt.date(1990, 2, 1))])
def test_same_days_last_year(spark, grain, span):
    lines = [(dt.date(1999, 1, 1) + dt.timedelta(days=i), i + 0.25) for i in range(800)]
    df = spark.createDataFrame([*lines, (None, 5.0)], "order_date date, net_amount double")
    days = spark.createDataFrame([(dt.date(1989, 12, 1) + dt.timedelta(days=i),) for i in range(4500)], "date date")
    calendar = days.select("date", F.col("date").alias("day"), F.trunc("date", "MM").alias("month"))
    by = {"day": ["day"], "month": ["month"], "page": []}[grain]
    got = same_period_last_year(df, calendar, by, chosen=F.col("date").between(*span)).collect()
    key = {"day": lambda d: d, "month": lambda d: d.replace(day=1), "page": lambda d: None}[grain]
    chosen = [span[0] + dt.timedelta(days=i) for i in range((span[1] - span[0]).days + 1)]
    want = {}
    for g in {key(d) for d in chosen}:
        mine = [d for d in chosen if key(d) == g]
        earlier = {prior(d) for d in mine}
        for y in {d.year for d in mine}:
            if dt.date(y, 2, 27) in mine and dt.date(y, 2, 28) in mine and (y - 1) % 4 == 0:
                earlier.add(dt.date(y - 1, 2, 29))
        sums = [[v for d, v in lines if d in set(side)] for side in (mine, earlier)]
        now, before = (sum(s) if s else None for s in sums)
        if now is not None or before is not None or grain == "page":
            growth = (now - before) / before if now is not None and before else 0.0
            want[g] = (now, before, pytest.approx(growth))
    assert {(r[grain] if by else None): tuple(r)[len(by):] for r in got} == want
