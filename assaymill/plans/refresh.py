"""Rollups that follow late lines without a full build.

Two tables are kept: totals per day and category in folders by month, and totals per order in hash
folders of the customer. A batch of late lines is summed the same way and added to
the months and folders it touches; no other file is read or written. The monthly, daily and
customer rollups come from the kept totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaymill.runtime import new_scratch_path
from assaymill.sources.sinks import merge_folders, write_folders

CUSTOMER_FOLDERS = 16
DAY, ORDER = ["month", "datekey", "category"], ["customer_id", "order_id"]


def _day_totals(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Per day and category; lines without a day or a known product are in no rollup of this kind, but in ``has_product`` = false."""
    goods = products.select("product_id", "category", F.lit(True).alias("has_product"))
    per_product = lines.where("datekey IS NOT NULL").groupBy("datekey", "product_id").agg(
        F.count("order_line_id").alias("lines"), F.sum("quantity").alias("units"),
        F.sum(F.rint(F.col("net_amount") * 100).cast("long")).alias("cents"))
    joined = per_product.join(goods, "product_id", "left").withColumn("has_product", F.coalesce("has_product", F.lit(False)))
    return _added_days(joined.withColumn("month", F.floor(F.col("datekey") / 100).cast("int")))


def _added_days(df: DataFrame) -> DataFrame:
    return df.groupBy(*DAY, "has_product").agg(*[F.sum(c).alias(c) for c in ("lines", "units", "cents")])


def _order_totals(lines: DataFrame) -> DataFrame:
    return _added_orders(lines.select(
        *ORDER, F.col("order_line_id").isNotNull().cast("long").alias("lines"),
        F.rint(F.col("net_amount") * 100).cast("long").alias("cents"),
        F.col("order_date").alias("first_date"), F.col("order_date").alias("last_date")))


def _added_orders(df: DataFrame) -> DataFrame:
    return df.groupBy(*ORDER).agg(
        F.sum("lines").alias("lines"), F.sum("cents").alias("cents"),
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))


def start(path: str, lines: DataFrame, products: DataFrame) -> None:
    """The kept totals of the lines known so far."""
    _day_totals(lines, products).repartition("month").write.partitionBy("month").parquet(f"{path}/days")
    write_folders(_order_totals(lines), f"{path}/orders", "customer_id", CUSTOMER_FOLDERS)


def add(path: str, late: DataFrame, products: DataFrame) -> list[int]:
    """Add a batch of late lines; returns the months it touched. A batch is added once."""
    spark = late.sparkSession
    staged = new_scratch_path(spark, "late-days")
    totals = _day_totals(late, products)
    totals.write.parquet(staged)
    fresh = spark.read.parquet(staged)
    months = sorted(r.month for r in fresh.select("month").distinct().toLocalIterator())
    kept = spark.read.parquet(f"{path}/days")
    merged = new_scratch_path(spark, "merged-days")
    _added_days(kept.where(F.col("month").isin(months)).unionByName(fresh)).write.parquet(merged)
    spark.read.parquet(merged).repartition("month").select(*kept.columns).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("month").parquet(f"{path}/days")
    merge_folders(f"{path}/orders", _order_totals(late), "customer_id", CUSTOMER_FOLDERS,
                  lambda rows, new: _added_orders(rows.unionByName(new)))
    return months


def monthly_by_category(spark: SparkSession, path: str, calendar: DataFrame) -> DataFrame:
    days = spark.read.parquet(f"{path}/days").where("has_product").drop("month")
    return days.join(calendar.select("datekey", "year", "month", "month_name"), "datekey").groupBy(
        "year", "month", "month_name", "category").agg(
        F.sum("lines").alias("order_line_count"), F.sum("units").alias("total_quantity"),
        (F.sum("cents") / 100).alias("total_net_amount"))


def daily(spark: SparkSession, path: str, calendar: DataFrame) -> DataFrame:
    totals = spark.read.parquet(f"{path}/days").groupBy("datekey").agg(F.sum("lines").alias("lines"), F.sum("cents").alias("cents"))
    return calendar.join(totals, "datekey", "left").select(
        F.col("date").alias("order_date"), "year", "month", "day_name", "is_weekend",
        F.coalesce("lines", F.lit(0)).alias("order_line_count"),
        F.coalesce(F.col("cents") / 100, F.lit(0.0)).alias("total_net_amount"))


def customer_ltv(spark: SparkSession, path: str, customers: DataFrame) -> DataFrame:
    orders = spark.read.parquet(f"{path}/orders").drop("folder")
    totals = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("n"), F.sum("lines").alias("lines"), F.sum("cents").alias("cents"),
        F.min("first_date").alias("first_order_date"), F.max("last_date").alias("last_order_date"))
    return customers.select("customer_id", "full_name", "customer_segment", "state").join(totals, "customer_id", "left").select(
        "customer_id", "full_name", "customer_segment", "state", F.coalesce("n", F.lit(0)).alias("order_count"),
        F.coalesce("lines", F.lit(0)).alias("order_line_count"),
        F.coalesce(F.col("cents") / 100, F.lit(0.0)).alias("lifetime_net_amount"), "first_order_date", "last_order_date")
