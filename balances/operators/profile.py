"""Descriptive profiles and grouped summaries.

All are partial aggregations (map-side combine); quantiles are exact and read
from ranked values (``order_stats``).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from balances.operators import order_stats

PROFILE_PROBS = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)


def rate_by_category(df: DataFrame, cat_cols, label_col: str) -> DataFrame:
    """A3: for each categorical column, n and label rate per category, NULL
    kept as its own category (dropna=False); one unpivot + one groupBy."""
    long = df.select(label_col, *[F.col(c).cast("string").alias(c) for c in cat_cols]).unpivot(
        [label_col], list(cat_cols), "variable", "category")
    return (long.groupBy("variable", "category")
            .agg(F.count(F.lit(1)).alias("n"), F.avg(label_col).alias("rate")))


def means_by(df: DataFrame, group_col: str, value_cols) -> DataFrame:
    """A4: means of several columns per group."""
    return df.groupBy(group_col).agg(*[F.avg(c).alias(f"mean_{c}") for c in value_cols])


def medians_by(df: DataFrame, group_col: str, value_cols) -> DataFrame:
    """Exact medians of many columns per group, from the ranked values."""
    long = df.select(group_col, *[F.col(c).cast("double").alias(c) for c in value_cols]).unpivot(
        [group_col], list(value_cols), "variable", "value")
    q = order_stats.quantiles(order_stats.value_table(long, ["variable", group_col]), ["variable", group_col], [0.5])
    return q.select("variable", group_col, F.col("value").alias("median"))


def medians_by_label(table: DataFrame) -> DataFrame:
    """A15 from a value table: (variable, y, median) of either label."""
    parts = [order_stats.quantiles(order_stats.of_label(table, y), ["variable"], [0.5]).select(
        "variable", F.lit(y).alias("y"), F.col("value").alias("median")) for y in (0, 1)]
    return parts[0].unionByName(parts[1])


def null_profile(df: DataFrame) -> DataFrame:
    """A5: null count per column in ONE aggregation, then stacked to rows."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stacked = agg.unpivot(["__rows"], cols, "column", "n_null")
    return stacked.select("column", F.col("n_null").cast("long"),
                          F.col("__rows").cast("long").alias("n_rows"))


def describe_values(table: DataFrame) -> DataFrame:
    """A6 from a value table: count, mean, sample std, min, quantiles (.01 .25 .5
    .75 .99), max of every variable. The deviation is taken around the mean."""
    valid = table.where(F.col("value").isNotNull())
    basic = valid.groupBy("variable").agg(
        F.sum("t").alias("count"), (F.sum(F.col("value") * F.col("t")) / F.sum("t")).alias("mean"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    around = valid.join(F.broadcast(basic.select("variable", "mean")), "variable")  # one row per variable
    spread = around.groupBy("variable").agg(F.sum(F.col("t") * F.pow(F.col("value") - F.col("mean"), 2)).alias("_ss"))
    basic = basic.join(spread, "variable").withColumn("std", F.when(F.col("count") > 1, F.sqrt(F.col("_ss") / (F.col("count") - 1)))).drop("_ss")
    q = order_stats.quantiles(table, ["variable"], PROFILE_PROBS[1:-1])
    wide = q.groupBy("variable").pivot("p", list(PROFILE_PROBS[1:-1])).agg(F.first("value"))
    names = {str(p): f"q{int(round(p * 100)):02d}" for p in PROFILE_PROBS[1:-1]}
    wide = wide.select("variable", *[F.col(f"`{k}`").alias(v) for k, v in names.items()])
    return basic.join(wide, "variable", "left")



def crosstab_counts(df: DataFrame, row_col: str, col_col: str) -> DataFrame:
    """Long-form contingency counts (NULL kept as its own level)."""
    return df.groupBy(row_col, col_col).agg(F.count(F.lit(1)).alias("n"))



def flag_overlap(df: DataFrame, flag_cols) -> DataFrame:
    """Intersections of id sets expressed as flags on one row per id."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, a in enumerate(flag_cols):
        aggs.append(F.count_if(F.col(a) == 1).alias(f"n_{a}"))
        for b in flag_cols[i + 1:]:
            aggs.append(F.count_if((F.col(a) == 1) & (F.col(b) == 1)).alias(f"n_{a}_and_{b}"))
    return df.agg(*aggs)


def sum0(c) -> F.Column:
    """pandas-style sum: all-NULL (or empty) sums to 0, not NULL."""
    return F.coalesce(F.sum(c), F.lit(0.0).cast(T.DoubleType()))
