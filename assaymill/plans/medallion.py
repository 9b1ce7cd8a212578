"""The whole build, bronze to gold, in dependency order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from assaymill.plans import gold, silver
from assaymill.sources.sinks import publish


def run_medallion(bronze: Mapping[str, DataFrame], path: str | None = None) -> dict[str, DataFrame]:
    """All layers as named frames.

    With ``path`` the tables that several others read (silver and the fact) are
    written there and read back, so each is computed once and a lost executor
    costs a re-read instead of a rebuild; a rebuild over an older one replaces each table at
    once when it is whole (``sinks.published`` reads it). The fact is clustered by day, which
    lets date ranges skip files. Without ``path`` the frames stay lazy.
    """
    out = dict(bronze)

    def keep(name: str, df: DataFrame, *cluster_by: str) -> None:
        out[name] = publish(df, f"{path}/{name}", cluster_by) if path else df

    keep("silver_customers", silver.silver_customers(out["bronze_customers"]))
    keep("silver_products", silver.silver_products(out["bronze_products"]))
    keep("silver_employees", silver.silver_employees(out["bronze_employees"]))
    out["silver_calendar"] = silver.silver_calendar(out["bronze_calendar"])
    keep("silver_sales", silver.silver_sales(
        out["bronze_sales"], out["bronze_customers"], out["bronze_products"]))

    out["dim_customer"] = gold.dim_customer(out["silver_customers"])
    out["dim_product"] = gold.dim_product(out["silver_products"])
    out["dim_employee"] = gold.dim_employee(out["silver_employees"])
    out["dim_date"] = gold.dim_date(out["silver_calendar"])
    keep("fact_sales", gold.fact_sales(out["silver_sales"]),
         "datekey", "order_id", "order_line_id", "product_id")

    fact, calendar = out["fact_sales"], out["dim_date"]
    out["agg_monthly_sales_by_category"] = gold.agg_monthly_sales_by_category(
        fact, calendar, out["dim_product"])
    out["agg_customer_ltv"] = gold.agg_customer_ltv(out["dim_customer"], fact)
    out["agg_daily_sales"] = gold.agg_daily_sales(calendar, fact)
    return out
