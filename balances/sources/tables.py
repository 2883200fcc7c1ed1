"""Readers for the driver tables and the adapter that maps them onto this
domain (customers, dated balance records per customer and product, an income
estimate).

Adapter (fixed rules, mirrored one-to-one by the oracle SQL in
``balances.plans.oracle``):

* balance records  <- ``orders``: customer_id = o_custkey, source =
  o_orderstatus, product = slug of o_orderpriority, obs_date =
  date(o_orderdate), balance = o_totalprice - balance_center, row_key =
  o_orderkey (tie-break for records on the same day).
* customers <- ``customer`` joined to ``nation`` and ``region`` (age_group =
  region name, segment = market segment, gender from the nation key, housing
  and the financial block derived from the account balance with NULL bands),
  and ``supplier`` as customers without history (id = -s_suppkey, segment
  PARTNER, balance in bands of 2500).
* income estimate <- ``events``: sum of event value per user (only part of
  the customers have one, like the estimator source).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from balances.config import SETTINGS

BALANCE_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("source", T.StringType(), True),
    T.StructField("product", T.StringType(), True),
    T.StructField("obs_date", T.DateType(), True),
    T.StructField("balance", T.DoubleType(), True),
    T.StructField("row_key", T.LongType(), True),
])

CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("age_group", T.StringType(), True),
    T.StructField("gender", T.StringType(), True),
    T.StructField("segment", T.StringType(), True),
    T.StructField("housing", T.StringType(), True),
    *[T.StructField(c, T.DoubleType(), True) for c in SETTINGS.financial_cols],
])


#: Width of the bands a partner's balance is known in.
PARTNER_BAND = 2500


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """IO1: parquet scan; projection and filters push down to the reader."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def product_slug(raw_col) -> F.Column:
    """IO4/J12: raw product name -> slug; an unmapped value fails the job."""
    m = F.create_map(*[F.lit(x) for raw, slug in SETTINGS.products for x in (raw, slug)])
    mapped = m[raw_col]
    return F.when(mapped.isNull(), F.raise_error(
        F.concat(F.lit("unmapped product: "), F.coalesce(raw_col, F.lit("NULL"))))
    ).otherwise(mapped)


def balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders",
                   ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                    "o_orderdate", "o_orderpriority"])
    return o.select(
        F.col("o_custkey").cast("long").alias("customer_id"),
        F.col("o_orderstatus").alias("source"),
        product_slug(F.col("o_orderpriority")).alias("product"),
        F.to_date("o_orderdate").alias("obs_date"),
        (F.col("o_totalprice") - F.lit(SETTINGS.balance_center)).alias("balance"),
        F.col("o_orderkey").cast("long").alias("row_key"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of the bank (``customer``) and, as customers without any
    product history, its partners (``supplier``, ids below zero): these have no
    balance records, amounts in bands, and with a negative balance no financial
    data at all."""
    # nation (25 rows) and region (5 rows) are fixed-size TPC-H dimensions:
    # broadcasting them is bounded regardless of scale factor.
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    geo = F.broadcast(n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name"))
    bank = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    partners = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    bal = F.col("s_acctbal")
    band = F.when(bal >= 0, F.floor(bal / PARTNER_BAND) * float(PARTNER_BAND)).otherwise(bal)
    j = bank.select(
        F.col("c_custkey").cast("long").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("bal"),
        F.col("c_mktsegment").alias("segment")).unionAll(partners.select(
            (-F.col("s_suppkey")).cast("long"), "s_name", "s_nationkey", band, F.lit("PARTNER")))
    j = j.join(geo, j.nation == geo.n_nationkey, "left")
    bal, nation = F.col("bal"), F.col("nation")
    assets = F.when(bal >= 500, bal * 10.0)
    liabilities = F.when(bal >= 500, bal * (nation % 7))
    return j.select(
        F.col("id").alias("customer_id"), "name", F.col("r_name").alias("age_group"),
        F.when(bal < -900, F.lit(None).cast("string"))
         .when(nation % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        "segment",
        F.when(bal < 6500, F.lit(None).cast("string"))
         .when(bal < 8200, F.lit("RENTED")).otherwise(F.lit("OWNED")).alias("housing"),
        F.when(bal >= 0, bal).alias("income"),
        F.when(bal >= 0, bal * (nation + 1) / 20.0).alias("expenses"),
        assets.alias("assets"),
        liabilities.alias("liabilities"),
        (assets - liabilities).alias("equity"),
    )


def income_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimator source: one row per customer that has one (no date)."""
    e = read_table(spark, sf_dir, "events", ["user_id", "value"])
    return (e.groupBy(F.col("user_id").cast("long").alias("customer_id"))
            .agg(F.sum("value").alias("income_estimate"))
            .withColumn("has_income_estimate", F.lit(True)))
