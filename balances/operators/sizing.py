"""Opportunity sizing (A7-A9, A19-A21, F13, F14, PF10, MT6).

All measures are partial aggregations over the scored base; sums follow the
pandas convention (all-NULL sums to 0, never NULL)."""
from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balances.config import SETTINGS
from balances.functions.columns import clip_lower0, clip_upper0
from balances.operators.profile import sum0

S = SETTINGS


def add_flows(df: DataFrame, amount_col: str = "amount_base_12m") -> DataFrame:
    """PF10: gross inflow = clip(lower=0), gross outflow = clip(upper=0);
    NULL amounts stay NULL."""
    return (df.withColumn("gross_inflow", clip_lower0(amount_col))
            .withColumn("gross_outflow", clip_upper0(amount_col)))


def gross_net_flows(df: DataFrame, amount_col: str = "amount_base_12m") -> DataFrame:
    """Over customers with investment history: counts and sums of the
    inflow / outflow split, net = inflow + outflow."""
    h = add_flows(df.where(F.col("has_investment_history") == 1), amount_col)
    g = h.agg(F.count_if(F.col(amount_col) > 0).cast("long").alias("n_inflow"),
              sum0("gross_inflow").alias("gross_inflow_12m"),
              F.count_if(F.col(amount_col) < 0).cast("long").alias("n_outflow"),
              sum0("gross_outflow").alias("gross_outflow_12m"))
    return g.withColumn("net_12m", F.col("gross_inflow_12m") + F.col("gross_outflow_12m"))


def level_dispersion(df: DataFrame, amount_col: str = "amount_base_12m") -> DataFrame:
    """Per level over customers with history: n, sum, mean, sample std,
    distinct amounts."""
    h = df.where(F.col("has_investment_history") == 1)
    return h.groupBy("level").agg(
        F.count(amount_col).cast("long").alias("n"), sum0(amount_col).alias("total"),
        F.avg(amount_col).alias("mean"), F.stddev_samp(amount_col).alias("std"),
        F.countDistinct(amount_col).cast("long").alias("n_distinct"))


def commercial_blocks(df: DataFrame, amount_col: str = "amount_base_12m") -> DataFrame:
    """block per customer from its level's dispersion (std < threshold:
    no signal; mean > 0: growth; else withdrawal risk); no history: no
    estimable amount. The per-level table has one row per level: broadcast."""
    disp = level_dispersion(df, amount_col).select("level", F.col("std").alias("_std"),
                                                   F.col("mean").alias("_mean"))
    j = df.join(F.broadcast(disp), "level", "left")
    hist = F.col("has_investment_history") == 1
    block = (F.when(~hist, F.lit("no_estimable_amount"))
             .when(F.col("_std") < S.flat_std_threshold, F.lit("no_signal"))
             .when(F.col("_mean") > 0, F.lit("growth"))
             .otherwise(F.lit("withdrawal_risk")))
    return j.withColumn("commercial_block", block).drop("_std", "_mean")


def sizing_cube(df: DataFrame) -> DataFrame:
    """A8/MT6: group by (level, block, population, segment) with 9 measures."""
    d = add_flows(df)
    return d.groupBy("level", "commercial_block", "population", "segment").agg(
        F.count(F.lit(1)).cast("long").alias("n_customers"),
        sum0("amount_conservative_12m").alias("amount_conservative"),
        sum0("amount_base_12m").alias("amount_base"),
        sum0("amount_optimistic_12m").alias("amount_optimistic"),
        sum0("gross_inflow").alias("gross_inflow"),
        sum0("gross_outflow").alias("gross_outflow"),
        sum0("amount_app_12m_base").alias("amount_app_base"),
        sum0("amount_conservative_12m_base").alias("amount_conservative_products_base"),
        F.avg("score").alias("score_mean"))


def executive_summary(df: DataFrame) -> DataFrame:
    """The top-line scalars in one aggregation, and the levels whose amounts
    hardly vary (no signal), by name."""
    flat = level_dispersion(df).where(F.col("std") < S.flat_std_threshold).agg(
        F.array_join(F.sort_array(F.collect_list("level")), ",").alias("levels_without_signal"))
    named = flat.first()["levels_without_signal"]  # at most one name a level
    return _top_line(df).withColumn("levels_without_signal", F.lit(named or ""))


def _top_line(df: DataFrame) -> DataFrame:
    h = F.col("has_investment_history") == 1
    amt = F.col("amount_base_12m")
    return df.agg(
        F.count(F.lit(1)).cast("long").alias("n_customers"),
        F.count_if(F.col("level").isin("A", "B")).cast("long").alias("n_prioritised_a_b"),
        F.count_if(F.col("level") == "A").cast("long").alias("n_level_a"),
        F.count_if((F.col("level") == "A") & (F.col("population") == "with_history"))
        .cast("long").alias("n_level_a_with_history"),
        F.count_if((F.col("level") == "A") & (F.col("population") == "without_history"))
        .cast("long").alias("n_level_a_without_history"),
        sum0(F.when(h & (amt > 0), amt)).alias("gross_inflow_12m"),
        F.count_if(h & (amt > 0)).cast("long").alias("n_inflow"),
        sum0(F.when(h & (amt < 0), amt)).alias("gross_outflow_12m"),
        F.count_if(h & (amt < 0)).cast("long").alias("n_outflow"),
        sum0(F.when(h, F.col("amount_conservative_12m"))).alias("opportunity_conservative_12m"),
        sum0(F.when(h, amt)).alias("opportunity_base_12m"),
        sum0(F.when(h, F.col("amount_optimistic_12m"))).alias("opportunity_optimistic_12m"),
        F.count_if(h & amt.isNotNull()).cast("long").alias("n_with_amount"),
        F.avg(F.when(h, F.col("amount_optimistic_12m") - F.col("amount_conservative_12m")))
        .alias("mean_customer_width"),
    ).withColumn("net_12m", F.col("gross_inflow_12m") + F.col("gross_outflow_12m"))


def band_widths(summary: DataFrame) -> DataFrame:
    """Aggregate band width, mean per-customer width, their ratio, sqrt(n)
    and the relative widths under perfect correlation / independence."""
    agg_w = F.col("opportunity_optimistic_12m") - F.col("opportunity_conservative_12m")
    rel = F.when(F.col("opportunity_base_12m") != 0, agg_w / F.abs(F.col("opportunity_base_12m")))
    return summary.select(
        agg_w.alias("aggregate_width"), "mean_customer_width",
        F.when(F.col("mean_customer_width") != 0, agg_w / F.col("mean_customer_width"))
        .alias("width_scale_factor"),
        F.sqrt(F.col("n_with_amount").cast("double")).alias("sqrt_n"),
        rel.alias("relative_width_perfect_correlation"),
        (rel / F.sqrt(F.col("n_with_amount").cast("double"))).alias("relative_width_independence"))


def capture_scenarios(summary: DataFrame) -> DataFrame:
    """opportunity = gross inflow x capture rate, one row per scenario
    (a fixed 3-row rate list, expanded with ``stack``)."""
    n = len(S.capture_rates)
    args = ", ".join(f"'{name}', CAST({rate} AS DOUBLE)" for name, rate in S.capture_rates)
    rates = summary.selectExpr("gross_inflow_12m", f"stack({n}, {args}) AS (scenario, capture_rate)")
    return rates.select("scenario", "capture_rate",
                        (F.col("gross_inflow_12m") * F.col("capture_rate")).alias("opportunity_12m"))


def component_split(df: DataFrame) -> DataFrame:
    """Totals of the app component vs the conservative-products base."""
    h = df.where(F.col("has_investment_history") == 1)
    return h.agg(sum0("amount_app_12m_base").alias("app_base"),
                 sum0("amount_conservative_12m_base").alias("conservative_products_base"))


