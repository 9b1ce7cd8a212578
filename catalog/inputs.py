"""The frames queries start from, all derived from one folder of given tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assaymill.operators import joins
from assaymill.plans import gold, silver
from assaymill.runtime import new_scratch_path
from assaymill.sources import retail, series
from assaymill.sources.tables import scan_table


# Schemas of the given tables, inferred once per path instead of once per scan.
_SCHEMAS: dict[str, StructType] = {}


# Raw tables written by this session: (application, folder, name) -> path.
_WRITTEN: dict[tuple[str, str, str], str] = {}


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def raw(self, name: str, *columns: str) -> DataFrame:
        path = f"{self.dir}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = scan_table(self.spark, path).schema
        return scan_table(self.spark, path, *columns, schema=_SCHEMAS[path])

    # Typed rows with the defects that no cleaning repairs.
    @cached_property
    def lines_feed(self) -> DataFrame:
        return retail.line_feed(self.raw("lineitem"))

    @cached_property
    def headers(self) -> DataFrame:
        return retail.header_feed(self.raw("orders"))

    @cached_property
    def sales_feed(self) -> DataFrame:
        return retail.sales_feed(self.raw("lineitem"), self.raw("orders"))

    @cached_property
    def customer_feed(self) -> DataFrame:
        return retail.customer_feed(self.raw("customer"))

    @cached_property
    def product_feed(self) -> DataFrame:
        return retail.product_feed(self.raw("part"))

    @cached_property
    def employee_feed(self) -> DataFrame:
        return retail.employee_feed(self.raw("supplier"), self.raw("nation"), self.raw("region"))

    # Gold-shaped frames without the text round trip.
    @cached_property
    def lines(self) -> DataFrame:
        """Priced order lines for queries that need nothing from the order header."""
        return silver.price_lines(self.lines_feed)

    @cached_property
    def fact(self) -> DataFrame:
        """The fact without orphan flags; ``flagged_fact`` has them."""
        return gold.fact_sales(silver.price_lines(self.sales_feed))

    @cached_property
    def flagged_fact(self) -> DataFrame:
        flagged = joins.flag_orphans(
            self.fact, "customer_id", self.customers, "is_customer_orphan")
        flagged = joins.flag_orphans(
            flagged, "product_id", self.products, "is_product_orphan")
        return gold.fact_sales(flagged)

    @cached_property
    def customers(self) -> DataFrame:
        return retail.typed_customers(self.customer_feed)

    @cached_property
    def products(self) -> DataFrame:
        return retail.typed_products(self.product_feed)

    @cached_property
    def employees(self) -> DataFrame:
        return retail.typed_employees(self.employee_feed)

    @cached_property
    def spine(self) -> DataFrame:
        """Every day of the calendar years that have orders."""
        return series.spine_over(self.order_days, "date", whole_years=True)

    @cached_property
    def order_days(self) -> DataFrame:
        return self.raw("orders", "o_orderdate").select(F.to_date("o_orderdate").alias("date"))

    @cached_property
    def calendar(self) -> DataFrame:
        return gold.dim_date(self.spine)

    @cached_property
    def sales_days(self) -> DataFrame:
        """Calendar rows from the first to the last order date."""
        window = series.spine_over(self.order_days, "date")
        return gold.dim_date(window)

    # Raw text.
    def written(self, name: str, df: DataFrame) -> DataFrame:
        """A raw table as cleaning finds it: written once in a session, whole and under a new name, and read back."""
        key = (self.spark.sparkContext.applicationId, self.dir, name)
        if key not in _WRITTEN:
            path = new_scratch_path(self.spark, name)
            df.write.parquet(path)
            _WRITTEN[key] = path
        return scan_table(self.spark, _WRITTEN[key], schema=df.schema)

    @cached_property
    def bronze_sales(self) -> DataFrame:
        """Not written: a pass makes only the columns it reads, and most queries make one pass over the lines."""
        return retail.dirty_sales(self.sales_feed)

    @cached_property
    def bronze_customers(self) -> DataFrame:
        return self.written("bronze_customers", retail.dirty_customers(self.customer_feed))

    @cached_property
    def bronze_products(self) -> DataFrame:
        return self.written("bronze_products", retail.dirty_products(self.product_feed))

    @cached_property
    def bronze_employees(self) -> DataFrame:
        return self.written("bronze_employees", retail.dirty_employees(self.employee_feed))

    @property
    def bronze(self) -> dict[str, DataFrame]:
        return {
            "bronze_customers": self.bronze_customers,
            "bronze_products": self.bronze_products,
            "bronze_employees": self.bronze_employees,
            "bronze_sales": self.bronze_sales,
            "bronze_calendar": self.spine,
        }

    # Rollups that several queries build on.
    @cached_property
    def monthly(self) -> DataFrame:
        return gold.agg_monthly_sales_by_category(self.fact, self.calendar, self.products)

    @cached_property
    def daily(self) -> DataFrame:
        return gold.agg_daily_sales(self.sales_days, self.fact)

    @cached_property
    def ltv(self) -> DataFrame:
        return gold.agg_customer_ltv(self.customers, self.fact)
