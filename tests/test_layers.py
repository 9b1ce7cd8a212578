"""Layer properties on the given tables."""

import pytest
from pyspark.sql import functions as F

from assaymill.plans import gold, measures, silver
from assaymill.plans.medallion import run_medallion
from catalog.inputs import Tables


@pytest.fixture(scope="module")
def t(spark, sf_dir):
    return Tables(spark, sf_dir)


def same(a, b):
    columns = sorted(set(a.columns) & set(b.columns))
    return a.select(*columns).exceptAll(b.select(*columns)).isEmpty() and b.select(
        *columns).exceptAll(a.select(*columns)).isEmpty()


def test_cleaning_undoes_the_noise(t):
    assert same(silver.silver_customers(t.bronze_customers), t.customers)
    assert same(silver.silver_products(t.bronze_products), t.products)
    assert same(silver.silver_employees(t.bronze_employees), t.employees)
    sales = silver.silver_sales(t.bronze_sales, t.bronze_customers, t.bronze_products)
    assert same(gold.fact_sales(sales), t.flagged_fact)


def test_noise_is_repeatable(t, spark, sf_dir):
    assert same(t.bronze_sales, Tables(spark, sf_dir).bronze_sales.repartition(5))


def test_rows_survive_every_layer(t, spark, tmp_path):
    layers = run_medallion(t.bronze, str(tmp_path / "layers"))
    given = t.raw("lineitem").count()
    for name in ("bronze_sales", "silver_sales", "fact_sales"):
        assert layers[name].count() == given
    rolled = layers["agg_monthly_sales_by_category"].agg(F.sum("order_line_count")).first()[0]
    lost = layers["fact_sales"].where("datekey IS NULL OR is_product_orphan = 1").count()
    assert rolled + lost == given and lost > 0
    again = run_medallion(t.bronze, str(tmp_path / "again"))
    assert same(layers["agg_customer_ltv"], again["agg_customer_ltv"])


def test_ltv_status_filter(t):
    every = gold.agg_customer_ltv(t.customers, t.fact)
    done = gold.agg_customer_ltv(t.customers, t.fact, "Completed")
    assert every.count() == done.count()
    known = t.fact.where("order_status = 'Completed'").join(t.customers, "customer_id", "left_semi")
    assert done.agg(F.sum("order_line_count")).first()[0] == known.count()


def test_measures_without_slices(t):
    names = ["total_net_revenue", "total_orders", "active_customer_count", "overall_discount_rate"]
    row = measures.measures(t.fact, names).collect()[0]
    assert row.total_orders == t.fact.select("order_id").distinct().count()
    empty = measures.measures(t.fact, names, where=F.lit(False)).collect()[0]
    assert empty.total_net_revenue is None and empty.overall_discount_rate == 0.0


def test_only_needed_columns_are_read(t):
    plan = gold.daily_totals(t.fact)._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan and "l_tax" not in plan and "l_shipdate" not in plan


def test_date_range_reaches_the_scan(spark, sf_dir):
    import __spark_entry__ as registered

    df = registered.queries()["filter_date_range_sargable"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
