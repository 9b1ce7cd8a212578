"""Running values and neighbours in slices and chunks equal plain windows, whatever the group's size."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from assaymill.operators import ordered
from assaymill.operators.ordered import descending


@pytest.fixture(scope="module")
def rows(spark):
    """One key holds a third of the rows; keys, order and values have nulls and repeats; clashing extra column."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(11)
    data = [(None if i % 50 == 0 else "hot" * 40 if i % 3 == 0 else f"k{rng.randrange(30)}", rng.choice([None, *range(40)]),
             i, rng.choice([None, None, rng.randrange(-500, 500) / 4]), "x") for i in range(6000)]
    rng.shuffle(data)
    yield spark.createDataFrame(data, "g string, d int, id int, v double, value string").repartition(8)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def orders(which):
    return [(["d", "id"], [F.col("d").asc_nulls_first(), F.col("id").asc()]),
            ([descending("d"), "id"], [F.col("d").desc_nulls_last(), F.col("id").asc()])][which]


def same(got, want):
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.select(*got.columns).collect()), key=str)


@pytest.mark.parametrize("which", [0, 1])
@pytest.mark.parametrize("group", [["g"], []])
def test_running_values(rows, which, group):
    order, plain = orders(which)
    w = Window.partitionBy(*group).orderBy(*plain).rowsBetween(Window.unboundedPreceding, 0)
    same(ordered.running_extreme(rows, group, order, "v", "m"), rows.withColumn("m", F.max("v").over(w)))
    same(ordered.running_extreme(rows, group, order, "v", "m", largest=False), rows.withColumn("m", F.min("v").over(w)))
    same(ordered.last_known(rows, group, order, "v", "m"), rows.withColumn("m", F.last("v", ignorenulls=True).over(w)))


@pytest.mark.parametrize("which,chunk", [(0, 7), (1, 100), (0, 1 << 16)])
def test_neighbours_across_chunks(rows, which, chunk):
    order, plain = orders(which)
    w = Window.partitionBy("g").orderBy(*plain)
    same(ordered.previous_value(rows, ["g"], order, "v", "m", 7, chunk), rows.withColumn("m", F.lag("v", 7).over(w)))
    same(ordered.following_value(rows, ["g"], order, "v", "m", 2, chunk), rows.withColumn("m", F.lead("v", 2).over(w)))
    cents = F.sum(F.rint(F.col("v") * 100).cast("long")).over(w.rowsBetween(-4, 0)) / 100
    mean = F.round(cents / F.count("v").over(w.rowsBetween(-4, 0)), 2)
    same(ordered.moving_mean(rows, ["g"], order, "v", "m", 5, chunk), rows.withColumn("m", mean))


def test_a_window_wider_than_a_chunk_is_refused(rows):
    with pytest.raises(ValueError, match="reaches"):
        ordered.previous_value(rows, ["g"], ["id"], "v", "m", 8, chunk=7)


def test_hot_group_spreads_over_tasks(rows):
    found = ordered.sliced(rows, ["g", "d", "id"]).where("g LIKE 'hot%'").groupBy("_slice").count().collect()
    assert len(found) >= 3 and max(r["count"] for r in found) < 2000


def test_building_starts_no_job_beyond_the_bounds_and_writes_nothing(spark, rows, monkeypatch):
    from pyspark.sql import DataFrame

    monkeypatch.setattr(type(rows), "checkpoint", lambda *a, **k: pytest.fail("checkpoint"))
    ran = []
    for name in ("count", "toArrow", "collect"):
        plain = getattr(type(rows), name)
        monkeypatch.setattr(type(rows), name, lambda self, *a, f=plain, n=name: (ran.append((n, self.columns)), f(self, *a))[1])
    numbered = ordered.row_numbers(rows, ["g"], ["d", "id"])
    assert [n for n, _ in ran] == ["count", "toArrow"] and all("v" not in c for _, c in ran)
    assert isinstance(numbered, DataFrame)


def test_empty_frames(rows):
    none = rows.where("false")
    assert ordered.running_extreme(none, ["g"], ["id"], "v", "m").count() == 0
    assert ordered.last_known(none, ["g"], ["id"], "v", "m").count() == 0
    assert ordered.previous_value(none, [], ["id"], "v", "m").count() == 0
