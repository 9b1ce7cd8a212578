"""A distinct count that is dealt to more tasks gives the same measures."""

from pyspark.sql import functions as F

from assaymill.plans.measures import measures


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_distinct_pairs_are_dealt(spark):
    rows = spark.createDataFrame(
        [(None if i % 7 == 0 else f"g{i % 3}", i // 4 if i % 11 else None, 1.25, i) for i in range(400)],
        "g string, order_id long, net_amount double, quantity int")
    names = ["total_net_revenue", "total_orders", "total_units_sold"]
    plain, dealt = measures(rows, names, ["g"]), measures(rows, names, ["g"], tasks=37)
    assert sorted(map(tuple, dealt.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    assert "37" in _plan(dealt) and dealt.where(F.col("total_orders") > 0).count() == 4
