"""Random inputs against plain Python; each example is one batch, so one Spark job."""

import re
from itertools import accumulate, groupby

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assaymill.functions import numbers, text
from assaymill.operators import ordered

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
pieces = st.lists(st.sampled_from(
    ["1", "20", "3.5", ".5", "-", "+", " ", "kg", "$", "e3", "TBD", "."]), max_size=4).map("".join)


def lead_number(value):
    found = re.match(r"\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)", value)
    return float(found[1]) if found else 0.0


@few
@given(st.lists(pieces, min_size=1, max_size=60))
def test_lenient_double(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    got = df.select("i", numbers.lenient_double(F.col("v")).alias("n")).orderBy("i").collect()
    assert [r.n for r in got] == [lead_number(v) for v in values]


@few
@given(st.lists(st.text(alphabet="aB 'é-", max_size=8), min_size=1, max_size=60))
def test_clean_name_shape(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    for row in df.select("v", text.clean_name(F.col("v")).alias("n")).collect():
        assert row.n == row.n.strip() and row.n[1:] == row.n[1:].lower()
        assert row.n.replace(" ", "").lower() == row.v.replace(" ", "").lower()


@few
@given(st.lists(st.tuples(st.sampled_from([0, 0, 0, 1, 2, None]), st.integers(-5, 5)),
                min_size=1, max_size=200), st.integers(1, 9))
def test_prefix_sums(spark, pairs, slices):
    spark.conf.set("spark.sql.shuffle.partitions", str(slices))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        data = [(g, i, v) for i, (g, v) in enumerate(pairs)]
        df = spark.createDataFrame(data, "g int, i int, v int")
        got = ordered.prefix_sums(df, ["g"], [F.col("i")], {"s": F.col("v")}).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = []
    for _, rows in groupby(sorted(data, key=lambda r: (str(r[0]), r[1])), key=lambda r: r[0]):
        rows = list(rows)
        want += [(*r, s) for r, s in zip(rows, accumulate(r[2] for r in rows), strict=True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
