"""Monthly panel operators.

Plan shape of ``monthly_panel``: one partial+final aggregation to
(group, month) — hot groups are collapsed map-side to at most one row per
month — then one re-key of those monthly rows by customer, which the window
over (group) ordered by month and the per-customer aggregations downstream
(CV, gold joins) all reuse without another exchange. Each observed month
emits itself plus the months until the next observation (LOCF by
``sequence``), so no grid join and no second window are needed; a group's
window holds at most one row per month, so it is bounded by the calendar, not
by the data volume.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from balances.config import SETTINGS
from balances.functions.columns import latest_order_key, month_index, safe_divide


def month_start(c) -> F.Column:
    """T5: first day of the month."""
    return F.trunc(F.col(c) if isinstance(c, str) else c, "month")


def month_last(records: DataFrame, keys=("customer_id", "product"), date_col="obs_date",
               value_col="balance", tiebreak_col="row_key") -> DataFrame:
    """Last non-null value per (group, month); observed = 1."""
    order = latest_order_key(date_col, tiebreak_col)
    return (records
            .groupBy(*keys, month_start(date_col).alias("month"))
            .agg(F.max_by(F.col(value_col), F.when(F.col(value_col).isNotNull(), order))
                 .alias("balance_month"))
            .withColumn("observed", F.lit(1)))


def panel_runs(records: DataFrame, cut: dt.date | None = None,
               keys=("customer_id", "product"), date_col="obs_date", value_col="balance",
               tiebreak_col="row_key", max_month: dt.date | None = None) -> DataFrame:
    """T7-T9 before the months are listed: per group and observed month the
    carried balance and the last month (``until``) it holds for.

    Rows are cut by DAY first (``date <= cut``), then bucketed; the grid runs
    from each group's first month to the common ``max_month`` (the cut's month
    by default). Groups starting after ``max_month`` are omitted."""
    keys = list(keys)
    if cut is not None:
        records = records.where(F.col(date_col) <= F.lit(cut).cast("date"))
        if max_month is None:
            max_month = cut
    if max_month is None:
        raise ValueError("monthly_panel needs the global cut or an explicit max_month")
    monthly = month_last(records, keys, date_col, value_col, tiebreak_col)
    mmax = F.trunc(F.lit(max_month).cast("date"), "month")
    # re-key the (already map-side collapsed) monthly rows by the entity: the
    # window below and the per-customer aggregations downstream (CV, gold
    # joins) then reuse this partitioning instead of shuffling again; a hot
    # entity brings at most products x months rows here, never its raw rows
    monthly = monthly.where(F.col("month") <= mmax).repartition(keys[0])
    w = Window.partitionBy(*keys).orderBy("month")
    return (monthly
            .withColumn("_next", F.lead("month").over(w))
            .withColumn("_carry", F.last("balance_month", ignorenulls=True).over(
                w.rowsBetween(Window.unboundedPreceding, 0)))
            .select(*keys, "month", F.coalesce(F.add_months(F.col("_next"), -1), mmax).alias("until"),
                    F.col("_carry").alias("balance_month")))


def months_of(runs: DataFrame, since: dt.date | F.Column | None = None) -> DataFrame:
    """The panel's months of ``panel_runs``, or those from month ``since`` on."""
    keys = [c for c in runs.columns if c not in ("month", "until", "balance_month")]
    first = F.col("month")
    if since is not None:
        since = month_start(since if isinstance(since, F.Column) else F.lit(since).cast("date"))
        runs, first = runs.where(F.col("until") >= since), F.greatest(first, since)
    exploded = runs.select(
        *keys, "balance_month", "month",
        F.explode(F.sequence(first, F.col("until"), F.expr("INTERVAL 1 MONTH"))).alias("_m"))
    return exploded.select(
        *keys,
        F.col("_m").alias("month"),
        "balance_month",
        (F.col("_m") == F.col("month")).cast("int").alias("observed"),
    )


def observed_months(runs: DataFrame) -> DataFrame:
    """The panel's observed rows, one a run."""
    return runs.drop("until").withColumn("observed", F.lit(1))


def monthly_panel(records: DataFrame, cut: dt.date | None = None,
                  keys=("customer_id", "product"), date_col="obs_date", value_col="balance",
                  tiebreak_col="row_key", max_month: dt.date | None = None) -> DataFrame:
    """Regular monthly panel with forward fill (never interpolated), every
    month of ``panel_runs``."""
    return months_of(panel_runs(records, cut, keys, date_col, value_col, tiebreak_col, max_month))


def first_month(records: DataFrame, keys=("customer_id",), date_col="obs_date") -> DataFrame:
    """First month with a record per group."""
    return records.groupBy(*keys).agg(month_start(F.min(date_col)).alias("first_month"))


def first_record(records: DataFrame, label_products=SETTINGS.label_products,
                 product_col="product", date_col="obs_date") -> DataFrame:
    """First month over the non-label sources (row-level exclusion, PF3);
    NOT cut-filtered (reference behaviour). Label-only customers are absent."""
    kept = records.where(~F.col(product_col).isin(list(label_products)))
    return first_month(kept, ("customer_id",), date_col)


def tenure_months(cut: dt.date, first_month_col="first_month") -> F.Column:
    """(y_cut - y)*12 + (m_cut - m) via month indices."""
    c = F.lit(cut).cast("date")
    return (month_index(c) - month_index(F.col(first_month_col))).cast("int")


def window_start(cut: dt.date, months: int = SETTINGS.window_months) -> F.Column:
    """First of the ``months`` months that end with the cut's."""
    return F.add_months(F.trunc(F.lit(cut).cast("date"), "month"), -(months - 1))


def liquid_cv(panel: DataFrame, cut: dt.date, liquid=SETTINGS.liquid_products,
              months: int = SETTINGS.window_months,
              min_observed: int = SETTINGS.cv_min_observed_months,
              key="customer_id") -> DataFrame:
    """A10: coefficient of variation (population std / mean) of the monthly
    liquid balance over exactly ``months`` buckets ending at the cut's month;
    NULL + flag when fewer than ``min_observed`` observed months, NULL without
    flag when mean <= 0."""
    c = F.lit(cut).cast("date")
    start = window_start(cut, months)
    per_month = (panel
                 .where(F.col("product").isin(list(liquid))
                        & (F.col("month") >= start) & (F.col("month") <= c))
                 .groupBy(key, "month")
                 .agg(F.sum("balance_month").alias("liquid_month"),
                      F.max("observed").alias("observed")))
    stats = (per_month.groupBy(key)
             .agg(F.avg("liquid_month").alias("mean"),
                  F.stddev_pop("liquid_month").alias("std"),
                  F.sum("observed").alias("n_observed")))
    insufficient = (F.col("n_observed") < min_observed).cast("int")
    return stats.select(
        key,
        F.when(insufficient == 0, safe_divide("std", "mean", positive_only=True))
         .alias("liquid_cv"),
        insufficient.alias("liquid_cv_insufficient"),
    )



def temporal_split_month(panel: DataFrame, k: int = SETTINGS.backtest_months,
                         month_col="month") -> DataFrame:
    """The first validation month = k-th latest distinct month; one row.
    Raises (at run time) when there are <= k distinct months."""
    months = panel.select(month_col).distinct()
    w = Window.orderBy(F.col(month_col).desc())  # distinct months: calendar-bounded
    ranked = months.withColumn("_r", F.row_number().over(w))
    agg = ranked.agg(F.count(F.lit(1)).alias("n_months"),
                     F.max(F.when(F.col("_r") == k, F.col(month_col))).alias("valid_start"))
    return agg.select(
        "n_months",
        F.when(F.col("n_months") <= k, F.raise_error(F.lit(
            f"insufficient history: need more than {k} months")).cast("date"))
         .otherwise(F.col("valid_start")).alias("valid_start"))
