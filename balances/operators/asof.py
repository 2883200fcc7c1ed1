"""As-of operators: global cut, per-source truncation report, snapshot with
6-month mean and half-window trend (T1-T4, PF1, PF2, A2, T14)."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balances.config import SETTINGS
from balances.functions.columns import latest_order_key, safe_divide


def global_cut_frame(records: DataFrame, source_col: str = "source",
                     date_col: str = "obs_date") -> DataFrame:
    """A2: one row ``cut_date`` = min over sources of max(date). Partial
    aggregation per source happens map-side; the result is one row."""
    per_source = records.groupBy(source_col).agg(F.max(date_col).alias("max_date"))
    return per_source.agg(F.min("max_date").alias("cut_date"))


def global_cut(records: DataFrame, **kw) -> dt.date:
    """A2 as a scalar, collected once and used as a literal downstream (so the
    cut filter pushes down into every later scan)."""
    return global_cut_frame(records, **kw).first()["cut_date"]


def window_bounds(cut: dt.date, months: int = SETTINGS.window_months):
    """PF2: [cut - months, cut], half point cut - months//2 (month-end clamp,
    same as add_months)."""
    c = F.lit(cut).cast("date")
    return c, F.add_months(c, -months), F.add_months(c, -(months // 2))


def cut_report(records: DataFrame, cut: dt.date, keys=("customer_id", "product"),
               source_col: str = "source", date_col: str = "obs_date") -> DataFrame:
    """Per source, rows, rows after the cut, groups, groups left with no
    row on/before the cut, max date and lag in days. One aggregation over
    (source, group) then one over source: both partial-aggregated."""
    c = F.lit(cut).cast("date")
    per_group = (records.groupBy(source_col, *keys)
                 .agg(F.count(F.lit(1)).alias("rows"),
                      F.count_if(F.col(date_col) > c).alias("rows_after"),
                      F.min(date_col).alias("min_date"),
                      F.max(date_col).alias("max_date")))
    return (per_group.groupBy(source_col)
            .agg(F.sum("rows").cast("long").alias("rows_total"),
                 F.sum("rows_after").cast("long").alias("rows_after_cut"),
                 F.count(F.lit(1)).cast("long").alias("groups_total"),
                 F.count_if(F.col("min_date") > c).cast("long").alias("groups_dropped"),
                 F.max("max_date").alias("max_date"))
            .withColumn("lag_days", F.datediff(F.col("max_date"), c).cast("long")))


def _latest_key(date_col, tiebreak_col, value_col):
    return F.when(F.col(value_col).isNotNull(), latest_order_key(date_col, tiebreak_col))


def snapshot_aggs(cut: dt.date, date_col="obs_date", value_col="balance",
                  tiebreak_col="row_key", cond=None, prefix: str = "",
                  months: int = SETTINGS.window_months):
    """The T1-T3 aggregate expressions (optionally under a product condition,
    so several products are computed in one groupBy)."""
    c, start, mid = window_bounds(cut, months)
    d, v = F.col(date_col), F.col(value_col)
    base = (d <= c) if cond is None else (cond & (d <= c))
    in_win = base & (d >= start)
    v_base = F.when(base, v)
    return [
        # Last non-null value on/before the cut; last date (nulls skipped
        # per column, so the two may come from different rows).
        F.max_by(v_base, F.when(base, _latest_key(date_col, tiebreak_col, value_col)))
         .alias(f"{prefix}balance_snapshot"),
        F.max(F.when(base, d)).alias(f"{prefix}snapshot_date"),
        # Mean / count of non-null values in [cut - 6m, cut]
        F.avg(F.when(in_win, v)).alias(f"{prefix}balance_mean_6m"),
        F.count(F.when(in_win, v)).cast("int").alias(f"{prefix}n_obs_window"),
        # Mean of second half minus mean of first half (NULL if a half is empty)
        (F.avg(F.when(in_win & (d >= mid), v)) - F.avg(F.when(in_win & (d < mid), v)))
        .alias(f"{prefix}trend_6m"),
        F.max(F.when(base, F.lit(1))).alias(f"{prefix}holding"),
    ]


def balance_snapshot(records: DataFrame, cut: dt.date, keys=("customer_id", "product"),
                     date_col="obs_date", value_col="balance", tiebreak_col="row_key",
                     months: int = SETTINGS.window_months) -> DataFrame:
    """T1-T3 in a single groupBy (the filter on the cut is pushed to the scan).
    Groups whose rows all fall after the cut vanish."""
    c = F.lit(cut).cast("date")
    kept = records.where(F.col(date_col) <= c)
    aggs = snapshot_aggs(cut, date_col, value_col, tiebreak_col, months=months)
    return kept.groupBy(*keys).agg(*aggs).withColumn("holding", F.lit(1))


def relative_trend(trend, mean) -> F.Column:
    """T4: trend / mean, NULL when mean <= 0."""
    return safe_divide(trend, mean, positive_only=True)


def product_pivot(records: DataFrame, cut: dt.date, products, key="customer_id",
                  product_col="product", **kw) -> DataFrame:
    """J1 re-aimed: snapshot features of every product for every customer in
    ONE groupBy(customer) with conditional aggregates (instead of one
    aggregation and one join per product). Hot customers are pre-aggregated
    map-side before the shuffle."""
    c = F.lit(cut).cast("date")
    kept = records.where(F.col(kw.get("date_col", "obs_date")) <= c)
    aggs = []
    for p in products:
        aggs += snapshot_aggs(cut, cond=(F.col(product_col) == p), prefix=f"{p}_", **kw)
    return kept.groupBy(key).agg(*aggs)


def features_at_cuts(records: DataFrame, cuts, products, key="customer_id", product_col="product", **kw) -> DataFrame:
    """T1-T3 of every product as of several cuts, in ONE groupBy(customer) with
    conditional aggregates per (cut, product): one scan, whatever the number of
    cuts. Columns ``c<i>_<product>_...``; a customer appears if any cut has one
    of their records."""
    kept = records.where(F.col(kw.get("date_col", "obs_date")) <= F.lit(max(cuts)).cast("date"))
    aggs = []
    for i, cut in enumerate(cuts):
        for p in products:
            aggs += snapshot_aggs(cut, cond=(F.col(product_col) == p), prefix=f"c{i}_{p}_", **kw)
    return kept.groupBy(key).agg(*aggs)
