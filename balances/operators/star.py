"""Star schema (MT1): dim_customer, dim_product, dim_time, fact_monthly.

The two dimensions used as lookups are a product catalogue and a month
calendar: their size is bounded by the catalogue and the calendar, never by
the fact volume, so broadcasting them into the fact join is safe.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balances.operators.rank import dense_keys

DIM_CUSTOMER_COLS = ["customer_id", "age_group", "gender", "segment", "housing"]


def dim_customer(features: DataFrame) -> DataFrame:
    return features.select(*[c for c in DIM_CUSTOMER_COLS if c in features.columns])  # PF12


def dim_product(panel: DataFrame) -> DataFrame:
    return dense_keys(panel, "product", "product_id")


def dim_time(panel: DataFrame) -> DataFrame:
    d = dense_keys(panel.select(F.col("month").alias("date")), "date", "date_id")
    return d.select("date", "date_id", F.year("date").alias("year"),
                    F.month("date").alias("month"), F.quarter("date").alias("quarter"))  # F9


def fact_monthly(panel: DataFrame, dim_prod: DataFrame, dim_t: DataFrame) -> DataFrame:
    """Fact -> dimension key lookups (left joins on bounded dims)."""
    return (panel
            .join(F.broadcast(dim_prod), "product", "left")
            .join(F.broadcast(dim_t.select(F.col("date").alias("month"), "date_id")), "month", "left")
            .select("customer_id", "product_id", "date_id", "month", "balance_month"))


def star_schema(features: DataFrame, panel: DataFrame) -> dict[str, DataFrame]:
    dp, dt_ = dim_product(panel), dim_time(panel)
    return {"dim_customer": dim_customer(features), "dim_product": dp, "dim_time": dt_,
            "fact_monthly": fact_monthly(panel, dp, dt_)}
