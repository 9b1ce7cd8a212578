"""Inputs on which earlier versions went wrong."""

import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import check
from assaymill import runtime
from assaymill.operators import changes
from assaymill.plans import gold, silver
from assaymill.plans.measures import measures
from assaymill.sources import sinks
from assaymill.sources.schemas import BRONZE_SCHEMAS
from catalog.registry import ORACLES, QUERIES


def test_measures_keep_parts_of_a_cent(spark):
    lines = spark.range(100).select(
        F.lit(1).alias("quantity"), F.lit(0.004).alias("unit_price"), F.lit(0.002).alias("unit_cost"),
        F.lit(0.0).alias("net_amount"))
    row = measures(lines, ["total_gross_revenue", "total_cogs"]).first()
    assert (row.total_gross_revenue, row.total_cogs) == (0.4, 0.2)


def test_insert_takes_the_types_of_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a")], "id int, name string").write.parquet(path)
    out = sinks.insert_select(spark.createDataFrame([(2, 5)], "id long, other long"), path)
    assert sorted((r.id, r.name) for r in out.collect()) == [(1, "a"), (2, None)]
    with pytest.raises(PySparkException):
        sinks.insert_select(spark.createDataFrame([(2**40,)], "id long"), path)
    assert spark.read.parquet(path).count() == 2


def test_second_change_on_one_day_replaces_the_first(spark):
    day = F.lit(dt.date(2021, 1, 1))
    history = spark.createDataFrame(
        [(1, "a", dt.date(2020, 1, 1), dt.date(9999, 12, 31), 1)],
        "id int, v string, valid_from date, valid_to date, is_current int")
    for value in ("b", "c"):
        history = changes.scd2_merge(history, spark.createDataFrame([(1, value)], "id int, v string"), "id", ["v"], day)
    rows = sorted((r.v, str(r.valid_from), str(r.valid_to)) for r in history.collect())
    assert [r[0] for r in rows] == ["a", "c"] and all(r[1] <= r[2] for r in rows)


def test_text_calendar_becomes_dates(spark):
    raw = spark.createDataFrame([(20200229, "2020-02-29")], BRONZE_SCHEMAS["bronze_calendar"])
    days = gold.dim_date(silver.silver_calendar(raw))
    assert dict(days.dtypes)["date"] == "date" and days.first().date == dt.date(2020, 2, 29)


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
@pytest.mark.parametrize("name", ["filter_between", "filter_date_range_sargable"])
def test_results_do_not_depend_on_the_zone(spark, con, sf_dir, zone, name):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert check.differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_scratch_folders_are_removed(spark):
    with runtime.scratch(spark):
        path = runtime.new_scratch_path(spark, "x")
        spark.range(3).write.parquet(path)
        local = path.removeprefix("file:")
        assert os.path.exists(local)
    assert not os.path.exists(local)


def test_rollups_shrink_before_they_meet_products(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(1000).selectExpr(
            "20200101 datekey", "id % 7 product_id", "1 quantity", "1.0D net_amount")
        days = spark.createDataFrame([(20200101, 2020)], "datekey int, year int")
        goods = spark.range(7).selectExpr("id product_id", "'c' category")
        out = gold.rollup(fact, days, [(goods, "product_id")], ["year", "category"])
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.rindex("HashAggregate") > plan.rindex("SortMergeJoin"), "no aggregate below the joins"
    assert [r.order_line_count for r in out.collect()] == [1000]


@pytest.mark.parametrize("name,order", [
    ("sort_multi", "customer_segment NULLS FIRST, signup_date DESC NULLS LAST, customer_id"),
    ("order_by_case", "list_position(['Completed', 'Returned', 'Cancelled'], status) NULLS LAST"),
])
def test_sorted_queries_return_their_order(spark, con, sf_dir, name, order):
    df = QUERIES[name](spark, sf_dir)
    columns = ", ".join(df.columns)
    expected = con.execute(f"SELECT {columns} FROM ({ORACLES[name]}) ORDER BY {order}").fetchall()
    assert len(expected) > 1 and [tuple(r) for r in df.collect()] == expected
