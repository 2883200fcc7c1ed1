"""Fairness audit (ST17-ST21): selection rate per group, disparate-impact
ratio, 80 % rule, score difference per group; stacked over attributes in one
unpivoted job."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from balances.config import SETTINGS
from balances.operators import stats

S = SETTINGS


def selection_rates(df: DataFrame, attrs, level_col: str = "level", target: str = "A") -> DataFrame:
    """ST17: per (attribute, group): n, n selected (level == target), rate;
    NULL group becomes 'Sin dato'. All attributes in one unpivot + groupBy."""
    long = df.select(F.col(level_col).alias("_lvl"),
                     *[F.col(a).cast("string").alias(a) for a in attrs]).unpivot(
        ["_lvl"], list(attrs), "attribute", "group")
    long = long.withColumn("group", F.coalesce("group", F.lit(S.missing_label)))
    return (long.groupBy("attribute", "group")
            .agg(F.count(F.lit(1)).cast("long").alias("n"),
                 F.count_if(F.col("_lvl") == target).cast("long").alias("n_selected"))
            .withColumn("selection_rate", F.col("n_selected") / F.col("n")))


def disparate_impact(rates: DataFrame, min_group_size: int = 0) -> DataFrame:
    """ST18/ST19/ST21: per attribute min rate / max rate (NULL when empty or
    max is 0), the 80 % rule (NULL ratio -> false), worst and best group.
    ``min_group_size`` > 0 gives the variant restricted to large groups."""
    r = rates.where(F.col("n") >= min_group_size) if min_group_size else rates
    w = Window.partitionBy("attribute")  # groups per attribute: bounded
    r = (r.withColumn("_min", F.min("selection_rate").over(w))
         .withColumn("_max", F.max("selection_rate").over(w)))
    g = r.groupBy("attribute").agg(
        F.first("_min").alias("min_rate"), F.first("_max").alias("max_rate"),
        F.min(F.when(F.col("selection_rate") == F.col("_min"), F.col("group"))).alias("worst_group"),
        F.min(F.when(F.col("selection_rate") == F.col("_max"), F.col("group"))).alias("best_group"))
    ratio = F.when(F.col("max_rate") > 0, F.col("min_rate") / F.col("max_rate"))
    return g.select("attribute", "min_rate", "max_rate", ratio.alias("impact_ratio"),
                    F.coalesce(ratio >= S.disparate_impact_min, F.lit(False)).cast("int")
                    .alias("passes_80_rule"),
                    "worst_group", "best_group")


def fairness_fact(df: DataFrame, attrs, proxy: DataFrame, level_col: str = "level", score_col: str = "score",
                  id_col: str = "customer_id") -> DataFrame:
    """ST20: selection rates with mean and median score and the p-value of each
    group against the rest (ST5), the attribute's impact ratio, and the AUC and
    reading of the protected attribute's proxy (``proxy``: one row, auc and band)."""
    rates = selection_rates(df, attrs, level_col)
    di = disparate_impact(rates).select("attribute", "impact_ratio", "passes_80_rule")
    scores = stats.one_vs_rest(df, id_col, attrs, score_col).select(
        "attribute", "group", F.col("mean").alias("score_mean"), F.col("median").alias("score_median"), "p_value")
    out = rates.join(scores, ["attribute", "group"], "left").join(F.broadcast(di), "attribute", "left")  # one row per attribute
    p = proxy.first()  # one scalar pair
    return out.withColumn("proxy_auc", F.lit(p["auc"]).cast("double")).withColumn("proxy_band", F.lit(p["band"]).cast("string"))
