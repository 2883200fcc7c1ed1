"""Customer layer (silver customers) and the wide per-customer feature mart
(gold): J1, J2, PF4-PF9, T4, T13, F2-F5, A10 join, T12 join, R3.

Every input is aggregated by ``customer_id`` (dedupe, product pivot, income
estimate, CV, first record), so all left joins below meet inputs that are
already hash-partitioned on the same key: the joins add no further shuffle.
"""
from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import add, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balances.config import SETTINGS
from balances.functions.columns import all_null, any_null, safe_divide
from balances.operators import asof, panel
from balances.session import materialise

S = SETTINGS


def dedupe_first(df: DataFrame, keys, order_col: str | None = None) -> DataFrame:
    """Keep one row per key, the first by ``order_col`` (a whole number, date
    or timestamp; NULL last), then by the other columns: a total order but for
    rows that are alike.

    Phases: the least order of each key, one fixed-width number, by hash
    aggregation (a key with millions of rows is one row a task before the
    shuffle); the rows that stand there, those that are alike taken as one; and
    only for keys that still have several, the first by the other columns."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    others = [c for c in df.columns if c not in keys]
    order = _order_number(df, order_col) if order_col else F.lit(0).cast("long")
    placed = df.withColumn("_place", order)
    least = placed.groupBy(*keys).agg(F.min("_place").alias("_least")).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], "_least")
    cond = placed["_place"] == least["_least"]
    for k in keys:
        cond = cond & placed[k].eqNullSafe(least[f"_k_{k}"])
    stand = materialise(placed.join(least, cond, "left_semi").select(*keys, *others).distinct(), "first-rows")
    several = stand.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(
        *[F.col(k).alias(f"_k_{k}") for k in keys])
    if several.isEmpty():
        return stand
    cond = F.lit(True)
    for k in keys:
        cond = cond & stand[k].eqNullSafe(several[f"_k_{k}"])
    rest = [order_col, *[c for c in others if c != order_col]] if order_col else others
    picked = stand.join(several, cond, "left_semi").groupBy(*keys).agg(
        F.min_by(F.struct(*others), F.struct(*rest)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])
    return stand.join(several, cond, "left_anti").unionByName(picked)


def _order_number(df: DataFrame, c: str) -> F.Column:
    kind = dict(df.dtypes)[c]
    if kind == "date":
        n = F.unix_date(c).cast("long")
    elif kind.startswith("timestamp"):
        n = F.unix_micros(F.col(c).cast("timestamp"))
    elif kind in ("tinyint", "smallint", "int", "bigint"):
        n = F.col(c).cast("long")
    else:
        raise TypeError(f"rows are ordered by a date, a timestamp or a whole number, not by {kind} {c}")
    return F.coalesce(n, F.lit((1 << 63) - 1))


def clean_customers(raw: DataFrame, key: str = "customer_id") -> DataFrame:
    """Silver customers: dedupe, missing-financial flags (any / all), savings
    capacity (F10)."""
    fin = list(S.financial_cols)
    c = dedupe_first(raw, key)
    return c.select(
        *c.columns,
        any_null(fin).alias("no_financial_any"),
        all_null(fin).alias("no_financial_all"),
        (F.col("income") - F.col("expenses")).alias("savings_capacity"),
    )


def _sum0(cols):
    return reduce(add, [F.coalesce(F.col(c), F.lit(0.0)) for c in cols])


def _count_pos(cols):
    return reduce(add, [(F.coalesce(F.col(c), F.lit(0.0)) > 0).cast("int") for c in cols])


def customer_features(customers: DataFrame, records: DataFrame, estimates: DataFrame,
                      cv: DataFrame, first_rec: DataFrame, cut: dt.date,
                      lift: float | None = None) -> DataFrame:
    """Gold feature mart: one row per customer."""
    products = S.product_slugs
    c = F.lit(cut).cast("date")
    piv = asof.product_pivot(records, cut, products)
    base = customers.join(piv, "customer_id", "left")

    cols = [F.col(x) for x in customers.columns]
    for p in products:
        absent = F.col(f"{p}_holding").isNull()
        cols += [
            F.coalesce(F.col(f"{p}_balance_snapshot"), F.lit(0.0)).alias(f"{p}_balance_snapshot"),
            F.col(f"{p}_snapshot_date"),
            F.when(absent, F.lit(0.0)).otherwise(F.col(f"{p}_balance_mean_6m"))
             .alias(f"{p}_balance_mean_6m"),
            F.when(absent, F.lit(0.0)).otherwise(F.col(f"{p}_trend_6m")).alias(f"{p}_trend_6m"),
            F.coalesce(F.col(f"{p}_n_obs_window"), F.lit(0)).cast("int").alias(f"{p}_n_obs_window"),
            F.coalesce(F.col(f"{p}_holding"), F.lit(0)).cast("int").alias(f"{p}_holding"),
        ]
    wide = base.select(*cols)
    wide = (wide.join(estimates, "customer_id", "left")
            .join(cv, "customer_id", "left")
            .join(first_rec, "customer_id", "left"))

    snap = {p: F.col(f"{p}_balance_snapshot") for p in products}
    date = {p: F.col(f"{p}_snapshot_date") for p in products}
    label_any = reduce(or_, [snap[p] > 0 for p in S.label_products])
    recent_any = reduce(or_, [F.coalesce((snap[p] > 0) & (F.datediff(c, date[p]) <= S.recent_label_days),
                                         F.lit(False)) for p in S.label_products])
    non_label_dates = [date[p] for p in S.non_label_products]
    last_seen = F.greatest(*non_label_dates) if len(non_label_dates) > 1 else non_label_dates[0]
    has_est = F.coalesce(F.col("has_income_estimate"), F.lit(False))
    history = (reduce(add, [F.col(f"{p}_holding") for p in products]) > 0).cast("int")
    no_signal = ((history == 0) & ~has_est
                 & F.coalesce(F.col("no_financial_all"), F.lit(False))).cast("int")
    gap = F.col("income") - F.col("income_estimate")

    out = wide.select(
        *[F.col(x) for x in wide.columns if x not in (
            "has_income_estimate", "housing", "no_financial_any", "no_financial_all",
            "first_month", "liquid_cv_insufficient")],
        F.col("no_financial_any").cast("int").alias("no_financial_any"),
        F.col("no_financial_all").cast("int").alias("no_financial_all"),
        has_est.cast("int").alias("has_income_estimate"),
        label_any.cast("int").alias("adoption_label"),
        F.datediff(c, last_seen).alias("days_since_last_data"),
        last_seen.isNull().cast("int").alias("no_recent_data"),
        recent_any.cast("int").alias("adoption_label_recent"),
        _sum0([f"{p}_balance_snapshot" for p in S.invest_non_label_products])
        .alias("invested_non_label_balance"),
        _count_pos([f"{p}_balance_snapshot" for p in S.invest_non_label_products])
        .alias("n_invest_non_label"),
        history.alias("has_product_history"),
        no_signal.alias("no_signal"),
        (1 - no_signal).alias("trainable"),
        # financial ratios
        safe_divide("expenses", "income").alias("expense_income_ratio"),
        safe_divide("savings_capacity", "income").alias("savings_income_pct"),
        safe_divide("liabilities", "assets").alias("liability_asset_ratio"),
        safe_divide(F.col("equity"), F.col("income") * 12).alias("equity_per_income"),
        gap.alias("income_gap"),
        safe_divide(gap, F.col("income")).alias("income_gap_pct"),
        # product aggregates
        _sum0([f"{p}_balance_snapshot" for p in S.liquid_products]).alias("liquid_balance_total"),
        _count_pos([f"{p}_balance_snapshot" for p in products]).alias("n_products_total"),
        _count_pos([f"{p}_balance_snapshot" for p in S.non_label_products])
        .alias("n_products_non_label"),
        safe_divide(_sum0([f"{p}_balance_snapshot" for p in S.liquid_products]), F.col("equity"))
        .alias("liquidity_equity_ratio"),
        # T4: relative trend per product
        *[asof.relative_trend(f"{p}_trend_6m", f"{p}_balance_mean_6m")
          .alias(f"{p}_relative_trend_6m") for p in products],
        # F5 / PF5 / PF6: missing as category and block flags
        F.col("housing").isNotNull().cast("int").alias("has_housing_data"),
        F.coalesce(F.col("housing"), F.lit(S.missing_label)).alias("housing"),
        all_null(list(S.financial_cols)).cast("int").alias("missing_financial"),
        F.col("income_estimate").isNull().cast("int").alias("missing_estimator"),
        F.col("housing").isNull().cast("int").alias("missing_housing"),
        F.coalesce(F.col("liquid_cv_insufficient"), F.lit(1)).cast("int")
        .alias("liquid_cv_insufficient"),
        panel.tenure_months(cut).alias("tenure_months"),
    )
    return add_incomplete_profile(out, lift)


def add_incomplete_profile(df: DataFrame, lift: float | None) -> DataFrame:
    """One ``incomplete_profile`` flag only when the measured conditional
    lift reaches the threshold; otherwise (or unmeasured) no column."""
    if lift is None or not (lift >= S.lift_incomplete_profile):
        return df
    blocks = [c for c in ("missing_estimator", "missing_housing", "missing_financial")
              if c in df.columns]
    return df.withColumn("incomplete_profile",
                         (reduce(add, [F.col(b) for b in blocks]) > 0).cast("int"))
