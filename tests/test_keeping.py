"""Tables that are kept over several loads: keys, folders, published versions, presence and totals."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from assaymill.operators import changes, keymap, ordered, presence
from assaymill.plans import gold, refresh
from assaymill.sources import series, sinks


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=str)


def test_keys_stay_over_two_loads(spark, tmp_path):
    first = spark.createDataFrame([("b", 1), ("a", 1), ("a", 1), (None, 2)], "k string, v int")
    kept = sinks.create_or_replace(keymap.extend_keys(first, ["k", "v"], "sk"), f"{tmp_path}/1")
    assert rows(kept) == rows(spark.createDataFrame([(None, 2, 1), ("a", 1, 2), ("b", 1, 3)], "k string, v int, sk long"))
    more = spark.createDataFrame([("0", 9), ("a", 1), ("a", 2), (None, 2), (None, None)], "k string, v int")
    again = keymap.extend_keys(more, ["k", "v"], "sk", kept)
    found = {(r.k, r.v): r.sk for r in again.collect()}
    assert {k: found[k] for k in [(None, 2), ("a", 1), ("b", 1)]} == {(None, 2): 1, ("a", 1): 2, ("b", 1): 3}
    assert {k: found[k] for k in [(None, None), ("0", 9), ("a", 2)]} == {(None, None): 4, ("0", 9): 5, ("a", 2): 6}
    assert rows(keymap.extend_keys(more.where("false"), ["k", "v"], "sk", kept)) == rows(kept)
    looked = keymap.with_key(spark.createDataFrame([(None, 2, 0), ("q", 1, 1)], "k string, v int, i int"), again, ["k", "v"], "sk")
    assert {(r.i, r.sk) for r in looked.collect()} == {(0, 1), (1, None)}


def test_fact_finds_its_version(spark):
    d = lambda n: dt.date(2000, 1, n)
    history = spark.createDataFrame([(1, d(1), d(9)), (1, d(10), None), (2, d(5), None)], "k int, valid_from date, valid_to date")
    keys = keymap.extend_keys(history, ["k", "valid_from"], "sk")
    facts = spark.createDataFrame([(1, d(9)), (1, d(10)), (2, d(4)), (2, d(6))], "k int, at date")
    assert set(rows(keymap.version_of(facts, history, keys, "k", "at", "sk"))) == {(1, d(9), 1), (1, d(10), 2), (2, d(6), 3)}


def test_repeated_or_missing_keys_in_updates_fail(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    history = target.selectExpr("*", "date'2000-01-01' AS valid_from", "date'9999-12-31' AS valid_to", "1 AS is_current")
    for bad in ([(2, "x"), (2, "y")], [(None, "x")]):
        updates = spark.createDataFrame(bad, "k int, v string")
        with pytest.raises(Exception, match="repeated or missing k"):
            changes.scd1_upsert(target, updates, "k").collect()
        with pytest.raises(Exception, match="repeated or missing k"):
            changes.scd2_merge(history, updates, "k", ["v"], F.lit(dt.date(2001, 1, 1))).collect()
    assert rows(changes.scd1_upsert(target, updates.where("false"), "k")) == [(1, "a")]


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_untouched_folders_keep_their_files(spark, tmp_path):
    path = f"{tmp_path}/t"
    table = sinks.write_folders(spark.range(1000).select("id", F.lit("old").alias("v")), path, "id", 8)
    assert table.count() == 1000
    before = files(path)
    updates = spark.createDataFrame([(5, "new"), (5000, "added")], "id long, v string")
    got = sinks.merge_folders(path, updates, "id", 8, lambda old, new: changes.scd1_upsert(old, new, "id"))
    assert rows(got.where("v <> 'old'")) == [(5, "new"), (5000, "added")] and got.count() == 1001
    after = files(path)
    touched = {r[0] for r in updates.select(sinks._folder("id", 8)).collect()}
    kept = {f for f in before if int(f.split("folder=")[1].split("/")[0]) not in touched}
    assert len(kept) >= 6 and all(after.get(f) == before[f] for f in kept)
    with pytest.raises(Exception, match="repeated"):
        sinks.merge_folders(path, updates.union(updates), "id", 8, lambda old, new: changes.scd1_upsert(old, new, "id"))
    assert rows(spark.read.parquet(path).where("v <> 'old'").select("id", "v")) == [(5, "new"), (5000, "added")]


def test_a_failed_build_leaves_the_old_rows(spark, tmp_path):
    path = f"{tmp_path}/layer"
    first = sinks.publish(spark.range(10), path)
    with pytest.raises(Exception, match="broken"):
        sinks.publish(spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("broken")))), path)
    assert sinks.published(spark, path).count() == 10
    second = sinks.publish(sinks.published(spark, path).where("id < 3"), path)
    assert second.count() == 3 and first.count() == 10  # a reader of the version before goes on
    sinks.publish(spark.range(1), path)
    assert len([d for d in os.listdir(path) if d.startswith("version-")]) == 2


def test_presence_counts_add_up(spark):
    data = [(i % 7, i % 3, i * 5 % 997, (i * 31 % 40) * 100_000 if i % 9 else None) for i in range(3000)]
    df = spark.createDataFrame(data, "d int, g int, a long, b long")
    kept = presence.presence(df, ["d", "g"], {"na": "a", "nb": "b"})
    for by in (["d"], ["g"], []):
        got = presence.distinct_counts(kept, by, ["na", "nb"])
        want = df.groupBy(*by).agg(F.countDistinct("a").alias("na"), F.countDistinct("b").alias("nb"))
        assert rows(got, *by, "na", "nb") == rows(want, *by, "na", "nb")
        assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()


def test_long_series_goes_by_blocks(spark):
    df = spark.createDataFrame([(1, 3), (2, 0), (3, None), (4, 200_001)], "k int, upto int")
    got = series.numbers_up_to(df, F.col("upto"))
    assert got.dtypes == [("k", "int"), ("upto", "int"), ("n", "int")]
    assert rows(got.groupBy("k").agg(F.count("*"), F.min("n"), F.max("n"), F.countDistinct("n"))) == [(1, 3, 1, 3, 3), (4, 200_001, 1, 200_001, 200_001)]
    one = spark.createDataFrame([(1, 10**8)], "k int, upto long")
    assert series.numbers_up_to(one, F.col("upto")).agg(F.sum("n")).first()[0] == 10**8 * (10**8 + 1) // 2


def test_deep_page(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("v"), F.col("id").alias("_place2"))
    got = [r.v for r in ordered.page(df, ["v"], 15_000, 25).collect()]
    assert got == list(range(15_000, 15_025))
    assert [r.v for r in ordered.page(df, [ordered.descending("v")], 19_990, 25).collect()] == list(range(9, -1, -1))
    assert ordered.page(df, ["v"], 30_000, 5).count() == 0 and ordered.page(df.where("false"), ["v"], 0, 5).count() == 0


def test_refresh_touches_its_months_alone(spark, tmp_path):
    products = spark.createDataFrame([(1, "x"), (2, None)], "product_id int, category string")
    lines = spark.range(2000).select(
        (F.col("id") % 300).alias("order_id"), F.col("id").alias("order_line_id"), (F.col("id") % 300 % 40).alias("customer_id"),
        (F.col("id") % 3 + 1).cast("int").alias("product_id"), F.date_add(F.lit(dt.date(2000, 1, 1)), (F.col("id") % 366).cast("int")).alias("order_date"),
        F.when(F.col("id") % 5 > 0, 2).alias("quantity"), (F.col("id") / 4).alias("net_amount"))
    lines = lines.withColumn("datekey", F.date_format("order_date", "yyyyMMdd").cast("int"))
    undated = lines.where("order_line_id = 7").withColumns({"datekey": F.lit(None).cast("int"), "order_date": F.lit(None).cast("date")})
    lines = lines.unionByName(undated)
    path = f"{tmp_path}/kept"
    late = (F.col("order_line_id") % 13 == 0) & F.col("order_date").between(dt.date(2000, 3, 1), dt.date(2000, 4, 20))
    late = F.coalesce(late, F.lit(False))
    refresh.start(path, lines.where(~late), products)
    before = files(f"{path}/days")
    assert refresh.add(path, lines.where(late & (F.col("order_line_id") % 2 == 0)), products) == [200003, 200004]
    refresh.add(path, lines.where(late & (F.col("order_line_id") % 2 == 1)), products)
    after = files(f"{path}/days")
    assert sum(after.get(f) == t for f, t in before.items()) == len(before) - 2
    spine = series.spine_over(lines, "order_date")
    calendar = gold.dim_date(spine)
    assert rows(refresh.daily(spark, path, calendar)) == rows(gold.agg_daily_sales(calendar, lines))
    monthly = gold.agg_monthly_sales_by_category(lines, calendar, products)
    assert rows(refresh.monthly_by_category(spark, path, calendar), *monthly.columns) == rows(monthly)
    people = spark.range(45).select(F.col("id").alias("customer_id"), *[F.lit("n").alias(c) for c in ("full_name", "customer_segment", "state")])
    ltv = gold.agg_customer_ltv(people, lines)
    assert rows(refresh.customer_ltv(spark, path, people), *ltv.columns) == rows(ltv)
