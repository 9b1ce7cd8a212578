"""The raw lines are made by the pass that reads them, and only the columns it reads."""

from catalog.inputs import Tables


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_raw_lines_are_not_written(spark, sf_dir):
    t = Tables(spark, sf_dir)
    files = t.bronze_sales.inputFiles()
    assert files and all("/lineitem.parquet" in f or "/orders.parquet" in f for f in files)
    plan = _plan(t.bronze_sales.select("order_id", "order_total"))
    assert "date_format" not in plan.lower() and "dateformat" not in plan.lower()
    assert t.bronze_sales.count() == t.raw("lineitem").count()
