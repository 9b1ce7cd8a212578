"""A key that holds a third of the rows is split in the joins, and results stay whole."""

import pytest
from pyspark.sql import functions as F

from assaymill.operators import joins, keys, ordered

SPLIT_EARLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4k",
}


@pytest.fixture(scope="module")
def lines(spark):
    for name, value in SPLIT_EARLY.items():
        spark.conf.set(name, value)
    k = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    yield spark.range(0, 90000, 1, 16).select("id", k.alias("k"), F.md5(F.col("id").cast("string")).alias("pad"))
    for name in SPLIT_EARLY:
        spark.conf.unset(name)


@pytest.fixture(scope="module")
def parents(spark):
    # Every key twice, so a careless join would repeat lines.
    return spark.range(0, 9000, 1, 4).select((F.col("id") % 4500).alias("k"))


def run(df):
    rows = df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return rows, "skew=true" in final


def test_orphan_flag(lines, parents):
    rows, split = run(joins.flag_orphans(lines, "k", parents, "orphan"))
    assert split and len(rows) == 90000
    assert sum(r.orphan for r in rows) == sum(1 for i in range(90000) if i % 3 and i % 5000 >= 4500)


def test_flags_start_no_job_and_read_the_lines_once(spark, lines, parents):
    spark.sparkContext.setJobGroup("building", "")
    flagged = joins.flag_orphans(joins.flag_orphans(lines, "k", parents, "a"), "k", parents, "b")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 90000") == 1


def test_star_join(lines, parents):
    rows, split = run(joins.star_join(lines, [(parents.distinct().repartition(3), "k")], "left"))
    assert len(rows) == 90000
    rows, split = run(joins.anti_join(lines, parents, "k"))
    assert split and len(rows) == sum(1 for i in range(90000) if i % 3 and i % 5000 >= 4500)


def test_duplicate_flag(lines):
    rows, split = run(keys.flag_duplicates(lines, "k", "dup"))
    assert split and len(rows) == 90000 and all(r.dup == 1 for r in rows if r.k == 7)


def test_rank_with_one_common_value(lines):
    rows, split = run(ordered.ranks(lines, [], "k", descending=False, rank="r", dense_rank="d"))
    by_key = {r.k: (r.r, r.d) for r in rows}
    assert split and len(rows) == 90000 and by_key[0] == (1, 1)
    below = sum(1 for r in rows if r.k < 7)
    assert by_key[7] == (below + 1, 8)
