import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from assaymill.functions.text import normalized_key
from assaymill.operators import changes, groups, joins, keys, ordered, quality
from assaymill.plans import bi
from assaymill.sources import series, sinks, tables
from catalog import datasets
from catalog.inputs import Tables


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=str)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows, one is NULL, and values repeat.

    Small slices are not merged here, so groups do cross slice borders.
    """
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(5)
    data = [(None if i % 50 == 0 else 0 if i % 3 == 0 else rng.randrange(40), rng.randrange(30), i)
            for i in range(6000)]
    rng.shuffle(data)
    yield spark.createDataFrame(data, "g int, v int, id int").repartition(8)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_row_numbers_equal_a_window(skewed):
    w = Window.partitionBy("g").orderBy("v", "id")
    want = skewed.withColumn("n", F.row_number().over(w).cast("long"))
    got = ordered.row_numbers(skewed, ["g"], ["v", "id"], "n")
    assert rows(got) == rows(want)


def test_running_sum_crosses_slices(skewed):
    w = Window.partitionBy("g").orderBy("v", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumn("s", F.sum("id").over(w))
    got = ordered.prefix_sums(skewed, ["g"], [F.col("v"), F.col("id")], {"s": F.col("id")})
    assert rows(got) == rows(want)


def test_slices_stay_even_under_a_hot_key(skewed):
    cut = ordered.sliced(skewed, ["g", "v", "id"])
    sizes = [r["count"] for r in cut.groupBy("_slice").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 6000 / 3


def test_ranks_equal_a_window(skewed):
    w = Window.partitionBy("g").orderBy(F.col("v").desc())
    want = skewed.withColumn("r", F.rank().over(w).cast("long")).withColumn(
        "d", F.dense_rank().over(w).cast("long"))
    got = ordered.ranks(skewed, ["g"], "v", rank="r", dense_rank="d")
    assert rows(got, "g", "v", "id", "r", "d") == rows(want, "g", "v", "id", "r", "d")


def test_surrogate_key_is_dense(skewed):
    got = ordered.surrogate_key(skewed, "id", "sk").collect()
    assert sorted((r.id + 1, r.sk) for r in got) == [(i, i) for i in range(1, 6001)]


def test_numbering_an_empty_frame(skewed):
    assert ordered.row_numbers(skewed.where("false"), ["g"], ["id"]).count() == 0


def test_group_value_and_share(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0)], "k string, v double")
    got = groups.share_of_group(df, ["k"], "v")
    assert rows(got, "k", "v", "pct_of_group") == [("a", 1.0, 25.0), ("a", 3.0, 75.0), (None, 5.0, 100.0)]


def test_not_in_null_trap(spark):
    left = spark.createDataFrame([(1,), (2,), (3,), (None,)], "id int")
    trap = spark.createDataFrame([(2,), (None,)], "id int")
    assert rows(joins.not_in(left, "id", trap)) == []
    assert rows(joins.not_in(left, "id", trap.where("id IS NOT NULL"))) == [(1,), (3,)]
    assert len(rows(joins.not_in(left, "id", trap.where("false")))) == 4
    assert rows(joins.anti_join(left, trap, "id")) == [(1,), (3,), (None,)]


def test_duplicate_pairs_are_linear(spark):
    df = spark.createDataFrame(
        [(i, " A@x ") for i in range(50)] + [(99, "b@x"), (100, ""), (101, None)],
        "id int, email string")
    got = joins.duplicate_pairs(df, normalized_key(F.col("email")), "id", ["email"])
    assert rows(got, "orig_id", "dup_id") == sorted([(0, i) for i in range(1, 50)], key=str)


def test_dedup_and_losers(spark):
    df = spark.createDataFrame(
        [(1, "A@x", "2020-02-01"), (2, " a@x", "2020-01-01"), (3, "b@x", "2020-01-01"),
         (4, None, "2020-01-01"), (5, "  ", "2020-01-01")], "id int, email string, day string")
    key, order = normalized_key(F.col("email")), [F.col("day"), F.col("id")]
    assert rows(keys.dedup_by_key(df, key, order), "id") == [(2,), (3,)]
    assert rows(keys.dedup_losers(df, key, order, "id")) == [(1,)]


def test_top_n_uses_the_group_limit(skewed):
    top = keys.top_n_per_group(skewed, ["g"], [F.col("v").desc(), F.col("id").asc()], 3)
    assert top.groupBy("g").count().where("count > 3").count() == 0
    assert top._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


def test_latest_per_entity(spark):
    df = spark.createDataFrame([(1, 10, 5), (1, 11, 7), (1, 12, 7), (2, 13, 1)], "c int, o int, d int")
    assert rows(keys.latest_per_entity(df, "c", ["d", "o"])) == [(1, 12, 7), (2, 13, 1)]


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "x")], "id int, v string")
    updates = spark.createDataFrame([(1, "b"), (3, "c")], "id int, v string")
    assert rows(changes.scd1_upsert(target, updates, "id")) == [(1, "b"), (2, "x"), (3, "c")]


def test_upsert_can_write_null(spark):
    target = spark.createDataFrame([(1, "a")], "id int, v string")
    updates = spark.createDataFrame([(1, None)], "id int, v string")
    assert rows(changes.scd1_upsert(target, updates, "id")) == [(1, None)]


def test_scd2_merge(spark):
    d = dt.date
    history = spark.createDataFrame([
        (1, "a", d(2020, 1, 1), d(9999, 12, 31), 1), (2, "b", d(2020, 1, 1), d(9999, 12, 31), 1),
        (2, "old", d(2019, 1, 1), d(2019, 12, 31), 0), (4, "gone", d(2020, 1, 1), d(9999, 12, 31), 1),
    ], "id int, v string, valid_from date, valid_to date, is_current int")
    snapshot = spark.createDataFrame([(1, "a"), (2, None), (3, "new")], "id int, v string")
    merged = changes.scd2_merge(history, snapshot, "id", ["v"], F.lit(d(2021, 1, 1)))
    assert rows(merged) == rows(spark.createDataFrame([
        (1, "a", d(2020, 1, 1), d(9999, 12, 31), 1), (2, "b", d(2020, 1, 1), d(2020, 12, 31), 0),
        (2, None, d(2021, 1, 1), d(9999, 12, 31), 1), (2, "old", d(2019, 1, 1), d(2019, 12, 31), 0),
        (3, "new", d(2021, 1, 1), d(9999, 12, 31), 1), (4, "gone", d(2020, 1, 1), d(9999, 12, 31), 1),
    ], merged.schema))
    again = changes.scd2_merge(merged, snapshot, "id", ["v"], F.lit(d(2022, 1, 1)))
    assert rows(again) == rows(merged)


def test_update_and_delete_keep_null_conditions(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 1)], "id int, v int")
    assert rows(changes.delete_rows(df, F.col("v") > 2), "id") == [(2,), (3,)]
    assert rows(changes.conditional_update(df, F.col("v") > 2, {"v": F.lit(0)})) == [
        (1, 0), (2, None), (3, 1)]


def test_constraints(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, None, -1), (2, "b", None)], "id int, n string, q int")
    parents = spark.createDataFrame([(1,)], "id int")
    got = quality.constraint_violations(
        df, unique={"id": F.col("id")}, not_null=["n"], checks={"q > 0": F.col("q") > 0},
        foreign={"id": parents})
    assert dict(rows(got)) == {"NOT NULL n": 1, "CHECK q > 0": 1, "UNIQUE id": 1, "FOREIGN KEY id": 1}


def test_flags_treat_null_as_the_reference_result(spark):
    lines = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id int, k int")
    parents = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(joins.flag_orphans(lines, "k", parents, "o"), "id", "o") == [(1, 0), (2, 1), (3, 1)]
    goods = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (4, None), (5, "y")], "id int, s string")
    assert rows(keys.flag_duplicates(goods, "s", "d"), "id", "d") == [
        (1, 1), (2, 1), (3, 1), (4, 1), (5, 0)]


def test_series(spark):
    spine = series.date_spine(spark, dt.date(2018, 1, 1), dt.date(2038, 12, 31))
    assert spine.count() == 7670 and spine.agg(F.max("datekey")).first()[0] == 20381231
    bound = spark.createDataFrame([(1000.0,)], "b double")
    assert [r[0] for r in series.powers_up_to(bound, F.col("b")).collect()] == [2**i for i in range(11)]
    bound = spark.createDataFrame([(1024.0,)], "b double")
    assert series.powers_up_to(bound, F.col("b")).count() == 11
    months = series.month_series(spark.range(1), F.lit(dt.date(2020, 11, 30)), F.lit(dt.date(2021, 2, 1)))
    assert [r[0] for r in months.collect()] == [
        dt.date(2020, 11, 1), dt.date(2020, 12, 1), dt.date(2021, 1, 1), dt.date(2021, 2, 1)]


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a")], "id int, v string")
    sinks.create_if_absent(first, path)
    assert rows(sinks.create_if_absent(spark.createDataFrame([(7, "z")], "id int, v string"), path)) == [(1, "a")]
    more = spark.createDataFrame([("ignored", 2)], "extra string, id int")
    assert rows(sinks.insert_select(more, path)) == [(1, "a"), (2, None)]
    assert rows(sinks.create_or_replace(first, path)) == [(1, "a")]
    assert rows(sinks.export_csv(first, str(tmp_path / "c"))) == [(1, "a")]
    assert rows(sinks.create_or_replace_view(first, "some_view")) == [(1, "a")]


def test_typed_extract_nulls_what_does_not_convert(spark):
    from pyspark.sql.types import IntegerType, LongType, StructField, StructType

    df = spark.createDataFrame([("7", "x", 1)], "a string, b string, c int")
    schema = StructType([StructField("a", IntegerType()), StructField("b", LongType())])
    assert rows(tables.typed_extract(df, schema)) == [(7, None)]


def test_lookup_small_keeps_unmatched_lines(spark):
    lines = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id int, k int")
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "k int, name string")
    assert rows(bi.lookup_small(lines, dim, "k"), "id", "name") == [(1, "one"), (2, None), (3, None)]


def counted(df, seen):
    """``df``, counting in ``seen`` how often a row of it is computed."""
    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema)


def test_ordered_operators_compute_their_input_once(spark):
    rows = [(i % 2, i, (i * 37) % 50 if i % 3 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, at int, v int")
    for operate in (
        lambda d: ordered.following_value(d, ["g"], ["at"], "v", "out", 2),
        lambda d: ordered.running_extreme(d, ["g"], ["at"], "v", "out"),
        lambda d: ordered.last_known(d, ["g"], ["at"], "v", "out"),
        lambda d: ordered.page(d, ["at"], 100, 20),
    ):
        seen = spark.sparkContext.accumulator(0)
        assert operate(counted(df, seen)).collect()
        assert seen.value == len(rows)


def test_refreshed_rollups_compute_the_lines_once(spark, tmp_path):
    day = dt.date(2001, 6, 8)
    lines = [(o, n, o % 5, o % 7, day + dt.timedelta(o % 6), 20010608 + o % 6, n, 1.25 * n) for o in range(60) for n in (1, 2)]
    fact = spark.createDataFrame(lines, "order_id long, order_line_id int, customer_id long, product_id long, order_date date, "
                                 "datekey int, quantity int, net_amount double")
    seen = spark.sparkContext.accumulator(0)
    t = Tables(spark, str(tmp_path))
    t.__dict__["fact"] = counted(fact, seen)
    t.__dict__["products"] = spark.createDataFrame([(p, "c") for p in range(7)], "product_id long, category string")
    days = spark.read.parquet(f"{datasets._refreshed(t)}/days")
    assert days.agg({"cents": "sum"}).first()[0] == sum(round(line[-1] * 100) for line in lines)
    assert seen.value == len(lines)
