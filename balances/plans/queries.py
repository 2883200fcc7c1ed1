"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over
the whole driver tables. Column names match ``balances.plans.oracle``."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from balances.config import SETTINGS
from balances.operators.roles import MISSING_FLAGS
from balances.operators import (amount, asof, audit, features, marts, models, panel, profile,
                                quality, rank, scoring, sizing, star, stats)
from balances.sources import tables
from balances.plans.common import balances, cut, layer, rounded
from balances.session import broadcast_checked, cut_lineage, materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@query("global_cut")
def q_global_cut(spark, d):
    return asof.global_cut_frame(balances(spark, d))


@query("cut_report")
def q_cut_report(spark, d):
    return asof.cut_report(balances(spark, d), cut(spark, d))


def snapshot_frame(spark, d):
    return asof.balance_snapshot(balances(spark, d), cut(spark, d))


@query("balance_snapshot")
def q_balance_snapshot(spark, d):
    s = snapshot_frame(spark, d).withColumn("n_obs_window", F.col("n_obs_window").cast("long"))
    return rounded(s.select("customer_id", "product", "balance_snapshot", "snapshot_date",
                            "balance_mean_6m", "n_obs_window", "trend_6m", "holding"))


@query("relative_trend")
def q_relative_trend(spark, d):
    s = snapshot_frame(spark, d)
    return rounded(s.select("customer_id", "product",
                            asof.relative_trend("trend_6m", "balance_mean_6m")
                            .alias("relative_trend_6m")))


def cut_records(spark, d):
    return balances(spark, d).where(F.col("obs_date") <= F.lit(cut(spark, d)))


@query("month_last")
def q_month_last(spark, d):
    return rounded(panel.month_last(cut_records(spark, d)))


def panel_frame(spark, d):
    return panel.monthly_panel(balances(spark, d), cut(spark, d))


def runs_layer(spark, d):
    """The silver panel before its months are listed: a row per observed month."""
    return layer(spark, d, "panel-runs", lambda: materialise(panel.panel_runs(balances(spark, d), cut(spark, d)), "panel-runs"))


def panel_layer(spark, d):
    """Silver monthly panel, materialised once."""
    return layer(spark, d, "panel", lambda: materialise(panel.months_of(runs_layer(spark, d)), "panel"))


def cv_panel(spark, d):
    """The panel's months that A10 looks at, listed alone."""
    return panel.months_of(runs_layer(spark, d), since=panel.window_start(cut(spark, d)))


@query("monthly_panel")
def q_monthly_panel(spark, d):
    return rounded(panel_frame(spark, d))


@query("first_month")
def q_first_month(spark, d):
    return panel.first_record(balances(spark, d))


@query("tenure_months")
def q_tenure_months(spark, d):
    fr = panel.first_record(balances(spark, d))
    return fr.select("customer_id", "first_month",
                     panel.tenure_months(cut(spark, d)).alias("tenure_months"))


@query("liquid_cv")
def q_liquid_cv(spark, d):
    return rounded(panel.liquid_cv(cv_panel(spark, d), cut(spark, d)))


def customers_frame(spark, d):
    return features.clean_customers(tables.raw_customers(spark, d))


def features_frame(spark, d, panel_df=None):
    c = cut(spark, d)
    recs = balances(spark, d)
    p = panel_df if panel_df is not None else panel.monthly_panel(recs, c)
    return features.customer_features(
        customers_frame(spark, d), recs, tables.income_estimates(spark, d),
        panel.liquid_cv(p, c), panel.first_record(recs), c)


def features_ckpt(spark, d):
    """Gold feature mart, written once as Parquet clustered by customer;
    downstream queries read the columns and row groups they need."""
    return layer(spark, d, "features", lambda: profiled_features(features_frame(spark, d, panel_df=cv_panel(spark, d))))


def profiled_features(frame):
    """R3 in two steps: the gold layer is written, the lift between its missing
    blocks is measured on it (ST13), and only a lift that reaches the threshold
    adds ``incomplete_profile``, in a second version of the layer."""
    first = materialise(frame, "features", lookup_by="customer_id")
    lift = stats.conditional_lift(first, "missing_estimator", "missing_housing").first()["lift"]  # one scalar
    second = features.add_incomplete_profile(first, lift)
    return first if second is first else materialise(second, "features-profiled", lookup_by="customer_id")


@query("customer_features")
def q_customer_features(spark, d):
    """Flagship: the gold feature mart (builds and materialises the layer)."""
    return rounded(features_ckpt(spark, d))


S = SETTINGS
POP_WITH, POP_WITHOUT = "with_history", "without_history"
CAT_COLS = ["age_group", "gender", "segment", "housing"]
AUDIT_ATTRS = ["age_group", "gender", "housing", "segment"]


def population(c="has_product_history"):
    """PF13: population split by product history."""
    return F.when(F.col(c) == 1, F.lit(POP_WITH)).otherwise(F.lit(POP_WITHOUT))


@query("missing_flags")
def q_missing_flags(spark, d):
    f = features_ckpt(spark, d)
    return f.select("customer_id", "housing", "has_housing_data", "missing_financial",
                    "missing_estimator", "missing_housing")


@query("segment_rates")
def q_segment_rates(spark, d):
    f = features_ckpt(spark, d)
    return rounded(profile.rate_by_category(f, CAT_COLS, "adoption_label")
                   .withColumn("n", F.col("n").cast("long")))


@query("label_means")
def q_label_means(spark, d):
    f = features_ckpt(spark, d)
    cols = [f"{p}_balance_snapshot" for p in S.product_slugs] + ["savings_capacity"]
    return rounded(profile.means_by(f, "adoption_label", cols))


@query("label_medians")
def q_label_medians(spark, d):
    """Every numeric predictor."""
    return rounded(profile.medians_by_label(values_layer(spark, d)).withColumnRenamed("y", LABEL))


@query("null_profile")
def q_null_profile(spark, d):
    return profile.null_profile(tables.raw_customers(spark, d))


@query("describe_profile")
def q_describe_profile(spark, d):
    """Every numeric predictor."""
    return rounded(profile.describe_values(values_layer(spark, d)).withColumn("count", F.col("count").cast("long")))


def levels_frame(spark, d):
    f = features_ckpt(spark, d).select(
        "customer_id", population().alias("population"),
        F.col("liquid_balance_total").alias("value"))
    return rank.priority_levels(f, "value", ["population"])


@query("priority_levels")
def q_priority_levels(spark, d):
    return rounded(levels_frame(spark, d).select("customer_id", "population", "value", "level",
                                                 "rn", "n"))


@query("percentile_in_group")
def q_percentile_in_group(spark, d):
    return rounded(levels_frame(spark, d).select("customer_id", "population", "pct_rank"))


LINEITEM_KEYS = ["l_orderkey", "l_linenumber"]
LINEITEM_ORDER = "l_shipdate"


@query("dedupe_first")
def q_dedupe_first(spark, d):
    li = tables.read_table(spark, d, "lineitem")
    return features.dedupe_first(li, LINEITEM_KEYS, LINEITEM_ORDER)


@query("duplicates")
def q_duplicates(spark, d):
    li = tables.read_table(spark, d, "lineitem", LINEITEM_KEYS)
    cu = tables.raw_customers(spark, d)
    return (quality.duplicate_keys(li, LINEITEM_KEYS, "lineitem")
            .unionByName(quality.duplicate_keys(cu, ["customer_id"], "customers")))


@query("grain_check")
def q_grain_check(spark, d):
    b = balances(spark, d)
    return (quality.grain_check(b, ["customer_id", "product", "obs_date"], "balances")
            .unionByName(quality.grain_check(b, ["customer_id", "product", "row_key"], "balances"))
            .unionByName(quality.grain_check(b, ["customer_id", "product", "valuation_date"],
                                             "balances")))


@query("orphans")
def q_orphans(spark, d):
    return quality.orphans(balances(spark, d), tables.raw_customers(spark, d), "customer_id")


@query("non_ascii")
def q_non_ascii(spark, d):
    docs = tables.read_table(spark, d, "documents", ["text", "lang", "source"])
    return quality.non_ascii_values(docs, ["text", "lang", "source"], "documents")


def star_frames(spark, d):
    return star.star_schema(features_ckpt(spark, d), panel_layer(spark, d))


@query("dim_product")
def q_dim_product(spark, d):
    return star.dim_product(panel_layer(spark, d))


@query("dim_time")
def q_dim_time(spark, d):
    return star.dim_time(panel_layer(spark, d))


@query("star_fact")
def q_star_fact(spark, d):
    return rounded(star_frames(spark, d)["fact_monthly"])


STAR_PKS = {"dim_customer": ["customer_id"], "dim_product": ["product_id"],
            "dim_time": ["date_id"], "fact_monthly": ["customer_id", "product_id", "date_id"]}
STAR_NOT_NULL = {"fact_monthly": ["month"]}
STAR_FKS = [("fact_monthly", "customer_id", "dim_customer", "customer_id"),
            ("fact_monthly", "product_id", "dim_product", "product_id"),
            ("fact_monthly", "date_id", "dim_time", "date_id")]


@query("constraint_report")
def q_constraint_report(spark, d):
    return quality.constraint_report(star_frames(spark, d), STAR_PKS, STAR_NOT_NULL, STAR_FKS)


# ---------------------------------------------------------------- statistics
def num_vars(f):
    """Every numeric predictor of model A, from the schema."""
    types = dict(f.dtypes)
    return [c for c in models.feature_set_a(f) if types[c] != "string"]


LABEL = "adoption_label"


def values_layer(spark, d):
    """One row per numeric predictor and distinct value, ranked: what edges,
    medians, U, AUC and WoE are read from."""
    def build():
        f = features_ckpt(spark, d)
        return materialise(stats.values_of(f, "customer_id", num_vars(f), LABEL), "values")
    return layer(spark, d, "values", build)


def edges_layer(spark, d):
    """Bin edges, one row per variable."""
    return layer(spark, d, "edges", lambda: materialise(stats.numeric_bin_edges(values_layer(spark, d)), "edges"))


def woe_num_frame(spark, d):
    return stats.woe_table(stats.assign_numeric_bins(values_layer(spark, d), edges_layer(spark, d)), stats.BIN_COLS)


@query("woe_iv_numeric")
def q_woe_iv_numeric(spark, d):
    return rounded(woe_num_frame(spark, d))


@query("woe_iv_categorical")
def q_woe_iv_categorical(spark, d):
    f = features_ckpt(spark, d)
    return rounded(stats.woe_categorical(f, "customer_id", CAT_COLS, LABEL))


def iv_frame(spark, d):
    f = features_ckpt(spark, d)
    w = woe_num_frame(spark, d).select("variable", "iv_bin").unionByName(
        stats.woe_categorical(f, "customer_id", CAT_COLS, LABEL).select("variable", "iv_bin"))
    return stats.iv_summary(w)


@query("iv_class")
def q_iv_class(spark, d):
    return rounded(iv_frame(spark, d))


@query("mann_whitney_u")
def q_mann_whitney_u(spark, d):
    table = values_layer(spark, d)
    return rounded(stats.mann_whitney(table).join(stats.group_medians(table), "variable", "left"))


@query("one_vs_rest_rank")
def q_one_vs_rest(spark, d):
    """ST5 for every audited attribute, from one value table of the score."""
    f = features_ckpt(spark, d)
    return rounded(stats.one_vs_rest(f, "customer_id", AUDIT_ATTRS, "liquid_balance_total"))


@query("chi2_cramer")
def q_chi2_cramer(spark, d):
    f = features_ckpt(spark, d)
    return rounded(stats.chi2_cramer(f, CAT_COLS + ["has_housing_data", "missing_estimator"], LABEL))


@query("bh_fdr")
def q_bh_fdr(spark, d):
    li = tables.read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_discount"])
    x = li.select("l_orderkey", "l_linenumber", (F.col("l_discount") * 10).alias("p"))
    return rounded(stats.benjamini_hochberg(x, "p", "l_orderkey").select(
        "l_orderkey", "l_linenumber", "p", "q_value", "reject"))


VIF_COLS = ["income", "expense_income_ratio", "liquid_balance_total"]


@query("vif")
def q_vif(spark, d):
    f = features_ckpt(spark, d)
    return rounded(stats.correlation_3(f, *VIF_COLS))


@query("conditional_lift")
def q_conditional_lift(spark, d):
    f = features_ckpt(spark, d)
    return rounded(stats.conditional_lift(f, "missing_estimator", "missing_housing"))


@query("auc_exact")
def q_auc_exact(spark, d):
    f = features_ckpt(spark, d)
    return rounded(stats.auc_exact(f, "customer_id", "liquid_balance_total", LABEL, ["segment"]))


@query("spearman")
def q_spearman(spark, d):
    f = features_ckpt(spark, d)
    return rounded(stats.spearman(f, "liquid_balance_total", "invested_non_label_balance"))


# ---------------------------------------------------------------- amounts & scoring
def score_input(spark, d):
    """Stand-in score for the oracle-checked chain: percentile of the liquid
    balance within the population (the GBT path is ``propensity_scores``)."""
    f = features_ckpt(spark, d)
    lv = rank.priority_levels(f.select("customer_id", population().alias("population"),
                                       F.col("liquid_balance_total").alias("value")),
                              "value", ["population"])
    return f, lv.select("customer_id", F.col("pct_rank").alias("score"))


def component_frames(spark, d):
    return layer(spark, d, "components", lambda: _component_frames(spark, d))


def _component_frames(spark, d):
    """Runs of the component panel, and its months of the history population."""
    seen = runs_layer(spark, d)
    last = seen.agg(F.max("until").alias("m")).first()["m"]  # one scalar
    runs = materialise(amount.component_runs(panel.observed_months(seen), last=last), "components")
    return runs, materialise(amount.months_of(amount.with_history(runs)), "components-history")


def amount_frames(spark, d):
    return layer(spark, d, "amounts", lambda: _amount_frames(spark, d))


def _amount_frames(spark, d):
    comp, comp_h = component_frames(spark, d)
    valid_start = amount.split_month(comp_h).first()["valid_start"]
    bt = materialise(amount.backtest(comp_h, valid_start), "backtest")
    scen = amount.scenarios_by_component(bt)
    full = amount.window_targets(comp_h)
    amounts = amount.amount_scenarios(full, scen)
    return {"comp": comp, "comp_h": comp_h, "valid_start": valid_start, "bt": bt,
            "scen": scen, "full": full, "amounts": amounts}


def fact_frame(spark, d):
    return layer(spark, d, "fact", lambda: _fact_frame(spark, d))


def _fact_frame(spark, d):
    f, scores = score_input(spark, d)
    fact1 = scoring.score_fact(f, scores, with_levels=False)
    a = amount_frames(spark, d)
    fact2 = scoring.with_amounts(fact1, a["amounts"], amount.history_ids(a["comp"]))
    attrs = f.select("customer_id", "segment", "age_group", "gender", "housing", "adoption_label")
    return materialise(fact2.join(attrs, "customer_id", "left"), "fact")


@query("component_pivot")
def q_component_pivot(spark, d):
    return rounded(amount.component_panel(panel_layer(spark, d)))


@query("semi_history")
def q_semi_history(spark, d):
    comp = amount.component_panel(panel_layer(spark, d))
    h = amount.history_ids(comp).select("customer_id", F.lit(1).alias("_h"))
    f = customers_frame(spark, d).select("customer_id")
    return f.join(h, "customer_id", "left").select(
        "customer_id", F.col("_h").isNotNull().cast("int").alias("has_investment_history"))


@query("annualised_growth")
def q_annualised_growth(spark, d):
    _, comp_h = component_frames(spark, d)
    return rounded(amount.window_targets(comp_h))


@query("temporal_split")
def q_temporal_split(spark, d):
    _, comp_h = component_frames(spark, d)
    return amount.split_month(comp_h).withColumn("n_months", F.col("n_months").cast("long"))


@query("backtest")
def q_backtest(spark, d):
    return rounded(amount_frames(spark, d)["bt"])


@query("mae_mape")
def q_mae_mape(spark, d):
    bt = amount_frames(spark, d)["bt"]
    return rounded(stats.mae_mape(bt, "real", "pred", group_cols=["component"]))


@query("error_scenarios")
def q_error_scenarios(spark, d):
    a = amount_frames(spark, d)
    return rounded(a["scen"].join(amount.error_evidence(a["bt"]), "component", "left"))


@query("amount_scenarios")
def q_amount_scenarios(spark, d):
    return rounded(amount_frames(spark, d)["amounts"])


SCORE_COLS = ["customer_id", "score", "model_used", "has_product_history", "trainable",
              "population", "annual_savings_capacity", "reference_value", "reference_type",
              "level", "has_investment_history", "expected_value_12m", "amount_base_12m",
              "amount_conservative_12m", "amount_optimistic_12m"]


@query("score_fact")
def q_score_fact(spark, d):
    return rounded(fact_frame(spark, d).select(*SCORE_COLS))


def blocks_frame(spark, d):
    return sizing.commercial_blocks(fact_frame(spark, d))


@query("gross_net_flows")
def q_gross_net_flows(spark, d):
    return rounded(sizing.gross_net_flows(fact_frame(spark, d)))


@query("level_dispersion")
def q_level_dispersion(spark, d):
    return rounded(sizing.level_dispersion(fact_frame(spark, d)))


@query("commercial_block")
def q_commercial_block(spark, d):
    b = blocks_frame(spark, d)
    return rounded(b.groupBy("commercial_block").agg(
        F.count(F.lit(1)).cast("long").alias("n_customers"),
        profile.sum0("amount_base_12m").alias("amount_base"),
        profile.sum0("amount_app_12m_base").alias("amount_app_base"),
        profile.sum0("amount_conservative_12m_base").alias("amount_conservative_products_base")))


@query("sizing")
def q_sizing(spark, d):
    return rounded(sizing.sizing_cube(blocks_frame(spark, d)))


@query("executive_summary")
def q_executive_summary(spark, d):
    return rounded(sizing.executive_summary(fact_frame(spark, d)))


@query("band_widths")
def q_band_widths(spark, d):
    return rounded(sizing.band_widths(sizing.executive_summary(fact_frame(spark, d))))


@query("capture_scenarios")
def q_capture_scenarios(spark, d):
    return rounded(sizing.capture_scenarios(sizing.executive_summary(fact_frame(spark, d))))


@query("component_split")
def q_component_split(spark, d):
    return rounded(sizing.component_split(fact_frame(spark, d)))


def proxy_frame(spark, d):
    """The stand-in for the proxy model (R4): how well one balance tells the
    protected attribute. One row: auc, band."""
    return q_auc_bands(spark, d).where("rule = 'gender_proxy'").select("auc", "band")


@query("selection_rate")
def q_selection_rate(spark, d):
    return rounded(audit.selection_rates(fact_frame(spark, d), AUDIT_ATTRS))


@query("disparate_impact")
def q_disparate_impact(spark, d):
    return rounded(audit.disparate_impact(audit.selection_rates(fact_frame(spark, d), AUDIT_ATTRS)))


@query("fairness_fact")
def q_fairness_fact(spark, d):
    return rounded(audit.fairness_fact(fact_frame(spark, d), AUDIT_ATTRS, proxy_frame(spark, d)))


# ---------------------------------------------------------------- marts & reports
@query("targeting_curve")
def q_targeting_curve(spark, d):
    f = fact_frame(spark, d).where(F.col("population") == POP_WITH)
    return rounded(marts.targeting_curve(f, "score", "adoption_label"))


@query("curve_long")
def q_curve_long(spark, d):
    f = fact_frame(spark, d).where(F.col("population") == POP_WITH)
    return rounded(marts.curve_long(marts.targeting_curve(f, "score", "adoption_label")))


CONTACT_N = 100


@query("contact_list")
def q_contact_list(spark, d):
    return rounded(marts.contact_list(fact_frame(spark, d), CONTACT_N, levels=("A",)))


@query("facet_counts")
def q_facet_counts(spark, d):
    return rounded(marts.facet_counts(fact_frame(spark, d)))


@query("facet_total")
def q_facet_total(spark, d):
    counts = marts.facet_counts(fact_frame(spark, d))
    return rounded(marts.facet_total(counts, populations=[POP_WITH], levels=["A", "B"]))


@query("facet_values")
def q_facet_values(spark, d):
    return marts.facet_values(fact_frame(spark, d))


@query("population_strategies")
def q_population_strategies(spark, d):
    return marts.population_strategies(fact_frame(spark, d))


@query("tie_mass")
def q_tie_mass(spark, d):
    return rounded(marts.tie_mass(fact_frame(spark, d)))


@query("level_shift")
def q_level_shift(spark, d):
    f, scores = score_input(spark, d)
    first = scoring.score_fact(f, scores)
    return rounded(marts.level_shift(first, fact_frame(spark, d)))


@query("stratified_rates")
def q_stratified_rates(spark, d):
    f = features_ckpt(spark, d)
    return rounded(marts.stratified_rates(f, "has_income_estimate", LABEL, "has_product_history"))


PLAUSIBILITY_THRESHOLD = 10000.0


@query("plausibility")
def q_plausibility(spark, d):
    return rounded(marts.plausibility(features_ckpt(spark, d), "savings_capacity",
                                      PLAUSIBILITY_THRESHOLD))


@query("table_profile")
def q_table_profile(spark, d):
    f = features_ckpt(spark, d)
    return rounded(marts.table_profile(f, decisions_frame(spark, d)))


def vif_columns(f):
    """ST9: numeric predictors that at least half of the customers have, without
    the flags that say another column is missing."""
    cols = [c for c in num_vars(f) if c not in MISSING_FLAGS]
    nn = profile.null_profile(f.select(*cols))  # one row per variable
    have = {r["column"] for r in nn.where(F.col("n_null") * 2 < F.col("n_rows")).collect()}
    return [c for c in cols if c in have]


def vif_layer(spark, d):
    """ST8/ST9: variable, vif; one row per variable, measured once."""
    def build():
        f = features_ckpt(spark, d)
        cols = vif_columns(f)
        rows = stats.vif_general(f, cols) if len(cols) > 1 else None
        return spark.createDataFrame(rows) if rows is not None else spark.createDataFrame([], "variable string, vif double")
    return layer(spark, d, "vif", build)


def decisions_frame(spark, d):
    return marts.inclusion_decisions(iv_frame(spark, d), vif_layer(spark, d))


@query("decision_rules")
def q_decision_rules(spark, d):
    """IV, VIF alert, decision and reason of every variable."""
    return rounded(decisions_frame(spark, d).select("variable", "iv", "iv_class", "vif_alert", "decision", "reason"))


@query("auc_bands")
def q_auc_bands(spark, d):
    """Band, conclusion and action from one balance's AUC (the
    trained models are ``missing_pattern_model`` and ``gender_proxy_model``)."""
    f = features_ckpt(spark, d)
    known = f.where(F.col("gender").isNotNull()).withColumn("is_female", (F.col("gender") == "F").cast("int"))
    a = stats.auc_exact(f, "customer_id", "liquid_balance_total", "missing_estimator") \
        .select(F.lit("missing_estimator_pattern").alias("rule"), "auc").select("rule", "auc", *marts.pattern_decision())
    b = stats.auc_exact(known, "customer_id", "liquid_balance_total", "is_female") \
        .select(F.lit("gender_proxy").alias("rule"), "auc").select("rule", "auc", *marts.proxy_decision())
    return rounded(a.unionByName(b))


@query("imputation_plan")
def q_imputation_plan(spark, d):
    """What the measured pattern does with the missing estimate."""
    f = features_ckpt(spark, d)
    pattern = q_auc_bands(spark, d).where("rule = 'missing_estimator_pattern'")
    return rounded(marts.imputation_plan(pattern, profile.medians_by(f, "segment", ["income_estimate"])))


def validation_frame(spark, d):
    """ST10: one row per variable with everything that was measured of it."""
    f = features_ckpt(spark, d)
    cols = num_vars(f)
    types = spark.createDataFrame([(c, "continuous") for c in cols] + [(c, "categorical") for c in CAT_COLS], "variable string, type string")
    nulls = profile.null_profile(f.select(*cols, *CAT_COLS)).select(F.col("column").alias("variable"), "n_null")
    table = values_layer(spark, d)
    mw = stats.mann_whitney(table).select("variable", stats.p_from_z("z").alias("p_mann_whitney")).join(
        stats.group_medians(table), "variable", "left")
    ch = stats.chi2_cramer(f, CAT_COLS, LABEL).select("variable", "chi2", stats.p_from_chi2("chi2", "dof").alias("p_chi2"), "cramers_v")
    out = types.join(nulls, "variable").join(mw, "variable", "left").join(ch, "variable", "left")
    out = cut_lineage(out.withColumn("p_value", F.coalesce("p_mann_whitney", "p_chi2")))  # one row per variable
    bh = stats.benjamini_hochberg(out.where(F.col("p_value").isNotNull()).select("variable", "p_value"), "p_value", "variable").select(
        "variable", "q_value", F.col("reject").alias("significant"))
    return out.join(bh, "variable", "left").join(
        decisions_frame(spark, d).withColumn("vif", F.round("vif", 4)), "variable", "left")


VALIDATION_COLS = ["variable", "type", "n_null", "iv", "iv_class", "p_mann_whitney", "median_event", "median_non_event", "chi2",
                   "p_chi2", "cramers_v", "p_value", "q_value", "significant", "vif", "vif_alert", "decision", "reason"]


@query("validation_table")
def q_validation_table(spark, d):
    """ST10: IV and class, Mann-Whitney p and medians (numeric) or chi-square, p
    and Cramér's V (categorical), BH q-value over all p together, VIF alert,
    decision and reason; protected attributes are measured, too."""
    return rounded(validation_frame(spark, d).select(*VALIDATION_COLS))


@query("importance_iv_join")
def q_importance_iv_join(spark, d):
    mw = stats.mann_whitney(values_layer(spark, d))
    imp = mw.select("variable", F.abs(F.col("u") / (F.col("n_event") * F.col("n_non_event")) - 0.5)
                    .alias("importance"))
    checked = validation_frame(spark, d).select("variable", "iv", "iv_class", "vif", "vif_alert", "q_value", "significant", "decision")
    return rounded(marts.importance_iv(imp, checked))


EVIDENCE_K = 3


@query("evidence_topk")
def q_evidence_topk(spark, d):
    f = features_ckpt(spark, d)
    return rounded(marts.evidence_topk(f, edges_layer(spark, d), woe_num_frame(spark, d), EVIDENCE_K))


PSI_LAG_MONTHS = 12


@query("psi_drift")
def q_psi_drift(spark, d):
    p = panel_layer(spark, d)
    c = F.trunc(F.lit(cut(spark, d)).cast("date"), "month")
    base = F.col("month") == F.add_months(c, -PSI_LAG_MONTHS)
    rows = p.where(base | (F.col("month") == c)).select(
        "product", F.col("balance_month").alias("value"), F.when(base, 0).otherwise(1).alias("y"))
    return rounded(marts.psi(rows, "product"))


@query("training_population")
def q_training_population(spark, d):
    return features_ckpt(spark, d).where(F.col("trainable") == 1).select("customer_id")


LOOKUP_ID = 7


@query("customer_lookup")
def q_customer_lookup(spark, d):
    f = features_ckpt(spark, d)
    return rounded(f.where(F.col("customer_id") == F.lit(str(LOOKUP_ID)).cast("long")))


# ---------------------------------------------------------------- more reports
@query("level_crosstab")
def q_level_crosstab(spark, d):
    """Population x level and segment x level counts (long form)."""
    f = fact_frame(spark, d)
    a = profile.crosstab_counts(f, "population", "level").select(
        F.lit("population").alias("row_variable"), F.col("population").alias("row_value"), "level", "n")
    b = profile.crosstab_counts(f, "segment", "level").select(
        F.lit("segment").alias("row_variable"), F.col("segment").alias("row_value"), "level", "n")
    return a.unionByName(b).withColumn("n", F.col("n").cast("long"))


@query("decision_counts")
def q_decision_counts(spark, d):
    """Variables per inclusion decision."""
    return decisions_frame(spark, d).groupBy("decision").agg(F.count(F.lit(1)).cast("long").alias("n"))


@query("missing_overlap")
def q_missing_overlap(spark, d):
    """Overlaps of the missing-block id sets as flags on one row per id."""
    o = profile.flag_overlap(features_ckpt(spark, d),
                             ["missing_estimator", "missing_housing", "missing_financial"])
    return o.select(*[F.col(c).cast("long").alias(c) for c in o.columns])


@query("id_check")
def q_id_check(spark, d):
    """F16: customer ids rendered as text are plain integers."""
    return quality.id_text_check(tables.raw_customers(spark, d), "customer_id")


@query("importance_top")
def q_importance_top(spark, d):
    """L3: the 12 most important variables (a top-k report)."""
    mw = stats.mann_whitney(values_layer(spark, d))
    imp = mw.select("variable", F.abs(F.col("u") / (F.col("n_event") * F.col("n_non_event")) - 0.5)
                    .alias("importance"))
    return rounded(imp.orderBy(F.col("importance").desc_nulls_last(), "variable").limit(12))


@query("facet_reconciliation")
def q_facet_reconciliation(spark, d):
    """DQ9: the pre-aggregated facet counts against a recomputation, full
    join on the null-safe facet keys; one row of totals and mismatches."""
    fact = fact_frame(spark, d)
    pre = marts.facet_counts(fact)
    again = fact.groupBy("population", "level", "segment").agg(
        F.count(F.lit(1)).alias("n2"),
        profile.sum0(F.when(F.col("amount_base_12m").isNotNull(),
                            F.greatest(F.col("amount_base_12m"), F.lit(0.0)))).alias("g2"))
    keys = ["population", "level", "segment"]
    cond = None
    for k in keys:
        c = pre[k].eqNullSafe(again[k])
        cond = c if cond is None else cond & c
    j = pre.join(again, cond, "full")
    bad = (F.col("n").isNull() | F.col("n2").isNull() | (F.col("n") != F.col("n2"))
           | (F.abs(F.col("gross_inflow") - F.col("g2")) > 1e-6))
    return j.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_pre"),
                 F.coalesce(F.sum("n2"), F.lit(0)).cast("long").alias("n_recomputed"),
                 F.count_if(bad).cast("long").alias("n_mismatched_cells"))


@query("woe_retained")
def q_woe_retained(spark, d):
    """MT9: WoE per bin for the variables the inclusion rule retains."""
    f = features_ckpt(spark, d)
    keep = decisions_frame(spark, d).where(
        F.col("decision").isin(*marts.INCLUDED)).select("variable")
    num = woe_num_frame(spark, d).withColumn("bin", F.lit(None).cast("string"))
    cat = (stats.woe_categorical(f, "customer_id", CAT_COLS, LABEL)
           .withColumn("bin_kind", F.lit("category"))
           .withColumn("bin_lo", F.lit(None).cast("double")).withColumn("bin_hi", F.lit(None).cast("double")))
    w = num.unionByName(cat).join(F.broadcast(keep), "variable", "left_semi")  # keep: one row per variable
    return rounded(w.select("variable", "bin_kind", "bin_lo", "bin_hi", "bin", "n", "events", "woe"))


IMPUTE_COL = "income"


@query("segment_median_impute")
def q_segment_median_impute(spark, d):
    """Impute by the segment median (exact, distributed) — the median
    table has one row per segment and is broadcast."""
    f = features_ckpt(spark, d)
    med = profile.medians_by(f, "segment", [IMPUTE_COL]).select("segment", F.col("median").alias("_m"))
    j = f.select("customer_id", "segment", IMPUTE_COL).join(broadcast_checked(med), "segment", "left")
    return rounded(j.select("customer_id", "segment",
                            F.coalesce(F.col(IMPUTE_COL), F.col("_m")).alias(f"{IMPUTE_COL}_imputed"),
                            F.col(IMPUTE_COL).isNull().cast("int").alias("imputed")))


CAPTURE_BIAS_VARS = ["income", "savings_capacity", "liquid_balance_total"]


@query("capture_bias")
def q_capture_bias(spark, d):
    """ST22: medians and Mann-Whitney of three variables, with vs without
    housing data."""
    f = features_ckpt(spark, d)
    table = materialise(stats.values_of(f, "customer_id", CAPTURE_BIAS_VARS, "has_housing_data"), "capture-values")
    return rounded(stats.mann_whitney(table).join(stats.group_medians(table), "variable", "left"))


@query("customer_serving")
def q_customer_serving(spark, d):
    """MT3: the serving table (whole-base percentile)."""
    return rounded(marts.serving_table(fact_frame(spark, d)))


@query("summary_kv")
def q_summary_kv(spark, d):
    """MT5: executive summary as key/value rows."""
    return rounded(marts.key_value(sizing.executive_summary(fact_frame(spark, d))))


@query("vif_all")
def q_vif_all(spark, d):
    """ST8/ST9 for every eligible numeric variable."""
    return rounded(vif_layer(spark, d), 4)


QUALITY_CHECKS = [
    quality.Check("balances", quality.PRIMARY_KEY, ("customer_id", "product", "row_key")),
    quality.Check("balances", quality.PRIMARY_KEY, ("customer_id", "product", "obs_date")),
    quality.Check("balances", quality.PRIMARY_KEY, ("customer_id", "product", "valuation_date")),
    quality.Check("balances", quality.NOT_NULL, ("obs_date",)),
    quality.Check("balances", quality.NOT_NULL, ("balance",)),
    quality.Check("balances", quality.ASCII, ("product",)),
    quality.Check("balances", quality.FOREIGN_KEY, ("customer_id",), "customers", ("customer_id",)),
    quality.Check("customers", quality.PRIMARY_KEY, ("customer_id",)),
    quality.Check("customers", quality.PK_NOT_NULL, ("customer_id",)),
    *[quality.Check("customers", quality.NOT_NULL, (c,)) for c in ("gender", "segment", "housing", "income", "assets")],
    quality.Check("customers", quality.ASCII, ("name",)),
    quality.Check("income_estimates", quality.PRIMARY_KEY, ("customer_id",)),
    quality.Check("income_estimates", quality.FOREIGN_KEY, ("customer_id",), "customers", ("customer_id",)),
    quality.Check("customer_features", quality.PRIMARY_KEY, ("customer_id",)),
    quality.Check("customer_features", quality.FOREIGN_KEY, ("customer_id",), "customers", ("customer_id",)),
    quality.Check("exchange_rates", quality.PRIMARY_KEY, ("currency",)),
]


@query("quality_report")
def q_quality_report(spark, d):
    """DQ6: all sources and gold tables in one report of OK, FAIL and NOT
    VERIFIED (a grain whose column, or a table, that this source has not)."""
    found = {"balances": balances(spark, d), "customers": tables.raw_customers(spark, d),
             "income_estimates": tables.income_estimates(spark, d), "customer_features": features_ckpt(spark, d)}
    found |= {k: v for k, v in star_frames(spark, d).items() if k != "dim_customer"}
    star_checks = [c for c in quality.constraint_checks(STAR_PKS, STAR_NOT_NULL, STAR_FKS) if "dim_customer" not in (c.table, c.parent)]
    return quality.check_tables(found, QUALITY_CHECKS + star_checks)


MONITOR_MONTHS = 12
#: ST24: thresholds of the monitoring plan (fixed values).
PSI_ALERT, AUC_DROP_ALERT, APE_ALERT, FRESH_DAYS = 0.25, 0.05, 0.10, 31


def two_cuts(spark, d):
    c = cut(spark, d)
    row = spark.range(1).select(F.add_months(F.lit(c).cast("date"), -MONITOR_MONTHS).alias("c")).first()
    return row["c"], c


def cut_features_layer(spark, d):
    """Product features as of both cuts, from one scan of the records."""
    return layer(spark, d, "cut-features", lambda: materialise(
        asof.features_at_cuts(balances(spark, d), two_cuts(spark, d), S.product_slugs), "cut-features"))


def model_inputs_at(f, i):
    """The time-dependent model variables as of cut ``i``, of the customers that
    had a record by then, and the label of that day."""
    holding = [F.col(f"c{i}_{p}_holding") for p in S.product_slugs]
    here = f.where(F.coalesce(*holding).isNotNull())
    out = [F.lit(i).alias("period")]
    for p in S.non_label_products:
        own = F.col(f"c{i}_{p}_holding").isNotNull()
        out += [F.coalesce(f"c{i}_{p}_balance_snapshot", F.lit(0.0)).alias(f"{p}_balance_snapshot")]
        out += [F.when(own, F.col(f"c{i}_{p}_{c}")).otherwise(F.lit(0.0)).alias(f"{p}_{c}") for c in ("balance_mean_6m", "trend_6m")]
        out += [F.coalesce(f"c{i}_{p}_n_obs_window", F.lit(0)).cast("double").alias(f"{p}_n_obs_window")]
    liquid = sum((F.coalesce(f"c{i}_{p}_balance_snapshot", F.lit(0.0)) for p in S.liquid_products[1:]),
                 F.coalesce(f"c{i}_{S.liquid_products[0]}_balance_snapshot", F.lit(0.0)))
    label = F.lit(False)
    for p in S.label_products:
        label = label | F.coalesce(F.col(f"c{i}_{p}_balance_snapshot") > 0, F.lit(False))
    return here.select(*out, liquid.alias("liquid_balance_total"), label.cast("int").alias("label"))


@query("monitoring")
def q_monitoring(spark, d):
    """ST24: PSI of every time-dependent model variable between the cut a year
    ago and the cut, the AUC's drop and ceiling, the 80 % rule, the proxy, the
    backtest's median APE and the sources' freshness, each with its threshold."""
    f = cut_features_layer(spark, d)
    both = model_inputs_at(f, 0).unionByName(model_inputs_at(f, 1))
    both = materialise(both, "cut-inputs")
    names = [c for c in both.columns if c not in ("period", "label")]
    drift = marts.psi(both.withColumnRenamed("period", "y").unpivot(["y"], names, "variable", "value"), "variable")
    rows = drift.select(*marts.indicator("psi", F.col("variable"), F.col("psi"), PSI_ALERT))
    auc = stats.auc_exact(both, "", "liquid_balance_total", "label", ["period"]).groupBy().agg(
        F.max(F.when(F.col("period") == 0, F.col("auc"))).alias("base"), F.max(F.when(F.col("period") == 1, F.col("auc"))).alias("now"))
    auc = cut_lineage(auc)  # one row
    rows = rows.unionByName(auc.select(*marts.indicator("auc_drop", F.lit("liquid_balance_total"), F.col("base") - F.col("now"), AUC_DROP_ALERT)))
    rows = rows.unionByName(auc.select(*marts.indicator("auc_ceiling", F.lit("liquid_balance_total"), F.col("now"), S.auc_leak_ceiling)))
    impact = audit.disparate_impact(audit.selection_rates(fact_frame(spark, d), AUDIT_ATTRS))
    rows = rows.unionByName(impact.select(*marts.indicator("impact_ratio", F.col("attribute"), F.col("impact_ratio"), S.disparate_impact_min, above=False)))
    rows = rows.unionByName(proxy_frame(spark, d).select(*marts.indicator("proxy_auc", F.lit("gender"), F.col("auc"), S.auc_proxy_substantial)))
    ape = stats.mae_mape(amount_frames(spark, d)["bt"], "real", "pred", group_cols=["component"])
    rows = rows.unionByName(ape.select(*marts.indicator("backtest_ape_median", F.col("component"), F.col("ape_median_ratio"), APE_ALERT)))
    last = balances(spark, d).groupBy("source").agg(F.max("obs_date").alias("last"))
    newest = last.agg(F.max("last").alias("m")).first()["m"]  # one scalar
    fresh = last.select("source", F.datediff(F.lit(newest).cast("date"), F.col("last")).alias("days"))
    rows = rows.unionByName(fresh.select(*marts.indicator("source_age_days", F.col("source"), F.col("days"), FRESH_DAYS)))
    return rounded(rows)


# ---------------------------------------------------------------- models (rows-only)
def propensity_layer(spark, d):
    """Models A/B fitted once per application (a trained model has
    no SQL oracle: these queries are checked on rows only)."""
    def build():
        f = features_ckpt(spark, d)
        res = models.propensity(f)
        res["scores"] = materialise(res["scores"], "scores")
        res["test"] = materialise(res["test"], "test")
        return res
    return layer(spark, d, "propensity", build)


@query("propensity_scores")
def q_propensity_scores(spark, d):
    res = propensity_layer(spark, d)
    models.assert_all_scored(features_ckpt(spark, d), res["scores"])
    return rounded(res["scores"])


@query("permutation_importance")
def q_permutation_importance(spark, d):
    return rounded(importance_layer(spark, d))


@query("model_metrics")
def q_model_metrics(spark, d):
    """M6-M8: exact AUCs of A, B and A on customers with products, and the
    training population, as one row."""
    res = propensity_layer(spark, d)
    base = features_ckpt(spark, d).where(F.col("trainable") == 1)
    named = [F.lit(v).cast("double").alias(k) for k, v in sorted(res["metrics"].items())]
    return rounded(base.agg(F.count(F.lit(1)).cast("long").alias("n_trainable"),
                            F.avg(LABEL).alias("adoption_rate")).select("*", *named))


def importance_layer(spark, d):
    def build():
        res = propensity_layer(spark, d)
        pairs = materialise(models.permutations(res["test"], 5), "permutations")  # one test set, so one for both models
        parts = [models.permutation_importance(res["models"][m], res["test"], res["cols"][m], LABEL, res["cols"][m], pairs=pairs)
                 .withColumn("model", F.lit(m)) for m in ("A", "B")]
        return materialise(parts[0].unionByName(parts[1]), "importance")
    return layer(spark, d, "importance", build)


@query("importance_fact")
def q_importance_fact(spark, d):
    """MT2: permutation importance of both models beside IV, VIF, q-value and
    inclusion decision; variables without one or the other kept; total order."""
    imp = importance_layer(spark, d).select("variable", "model", F.col("importance_mean").alias("importance"), "importance_std")
    checked = validation_frame(spark, d).select("variable", "iv", "iv_class", "vif", "q_value", "significant", "decision")
    return rounded(marts.importance_iv(imp, checked))


def pattern_layer(spark, d):
    """A model of "the estimate is missing" from all other predictors."""
    taut = ["income_estimate", "has_income_estimate", "income_gap", "income_gap_pct"]
    return layer(spark, d, "pattern-model", lambda: models.auxiliary_model(features_ckpt(spark, d), "missing_estimator", taut))


def proxy_layer(spark, d):
    """A model of the modal gender from the predictors."""
    def build():
        f = features_ckpt(spark, d)
        mode = f.agg(F.mode("gender", deterministic=True).alias("mode")).first()["mode"]  # A14: one scalar
        target = f.where(F.col("gender").isNotNull()).withColumn(
            "is_modal_gender", (F.col("gender") == F.lit(mode)).cast("int"))
        return models.auxiliary_model(target, "is_modal_gender")
    return layer(spark, d, "proxy-model", build)


@query("missing_pattern_model")
def q_missing_pattern_model(spark, d):
    """M11 + R1: AUC, conclusion and action of the trained pattern model."""
    df = spark.createDataFrame([("missing_estimator_pattern", pattern_layer(spark, d)["auc"])], "rule string, auc double")
    return rounded(df.select("rule", "auc", *marts.pattern_decision()))


@query("gender_proxy_model")
def q_gender_proxy_model(spark, d):
    """M12 + R4: AUC, reading and action of the trained proxy model."""
    df = spark.createDataFrame([("gender_proxy", proxy_layer(spark, d)["auc"])], "rule string, auc double")
    return rounded(df.select("rule", "auc", *marts.proxy_decision()))


@query("auxiliary_importance")
def q_auxiliary_importance(spark, d):
    """The ten variables that each auxiliary model leans on most."""
    parts = [models.top_variables(aux).withColumn("rule", F.lit(rule)) for rule, aux in (
        ("missing_estimator_pattern", pattern_layer(spark, d)), ("gender_proxy", proxy_layer(spark, d)))]
    return rounded(parts[0].unionByName(parts[1]))


def forecast_layer(spark, d):
    """GBT regressors per component (features: end balance, months,
    trend, capacity set B), backtested on the validation months, scenarios
    from the error percentiles, totals per customer. Fitted once per run."""
    return layer(spark, d, "forecast", lambda: _forecast(spark, d))


def _forecast(spark, d):
    a = amount_frames(spark, d)
    f = features_ckpt(spark, d)
    cols_b = models.feature_set_b(f)
    comp_h, vs = a["comp_h"], a["valid_start"]
    train_t = amount.window_targets(comp_h.where(F.col("month") < F.lit(vs)))
    bt_real = a["bt"].select("customer_id", "component", "real")
    fb = f.select("customer_id", *cols_b)
    cols = ["invested_now", "months", "trend"] + cols_b
    fitted, preds, errs = {}, {}, []
    for c in amount.COMPONENTS:
        def design(t):
            return t.select("customer_id", F.col(f"{c}_end").alias("invested_now"), "months",
                            amount.trend_feature(f"{c}_start", f"{c}_end", "months").alias("trend"),
                            F.col(f"{c}_growth").alias("target")).join(fb, "customer_id", "left")
        tr = design(train_t)
        known = F.col("target").isNotNull()
        encoder, rows = models.encode_once(tr.where(known), tr, cols, ["customer_id", "target"], "vectors-amount")
        m = models.fit_vectors(encoder, rows.where(known), models.regressor("target"))
        p_tr = models.predict_vectors(m, rows).select("customer_id", "pred")
        errs.append(bt_real.where(F.col("component") == c).join(p_tr, "customer_id")
                    .select("customer_id", F.lit(c).alias("component"), "real", "pred"))
        preds[c] = models.predict(m, design(a["full"]), cols).select("customer_id", F.col("pred").alias(f"{c}_growth"))
        fitted[f"amount_{c}"] = m
    bt = materialise(amount.with_total(errs[0].unionByName(errs[1])), "forecast-backtest")
    scen = amount.scenarios_by_component(bt)
    full_pred = preds["app"].join(preds["conservative"], "customer_id", "full")
    return {"models": fitted, "bt": bt, "amounts": materialise(amount.amount_scenarios(full_pred, scen), "forecast")}


@query("amount_forecast")
def q_amount_forecast(spark, d):
    return rounded(forecast_layer(spark, d)["amounts"])


@query("forecast_backtest")
def q_forecast_backtest(spark, d):
    """ST14/ST16 + J13 of the trained regressors: errors of each component and,
    over the customers who have both, of their total."""
    bt = forecast_layer(spark, d)["bt"]
    return rounded(stats.mae_mape(bt, "real", "pred", group_cols=["component"]).join(amount.error_evidence(bt), "component", "left"))


def trained_fact_layer(spark, d):
    return layer(spark, d, "trained-fact", lambda: trained_fact(spark, d))


def trained_fact(spark, d):
    """The score fact that is published: trained propensity scores and trained
    amounts. ``score_fact`` (the query) runs the same chain on the stand-ins
    that SQL can repeat."""
    f = features_ckpt(spark, d)
    scores = propensity_layer(spark, d)["scores"]
    models.assert_all_scored(f, scores)
    fact1 = scoring.score_fact(f, scores.select("customer_id", "score"), with_levels=False)
    a = amount_frames(spark, d)
    fact2 = scoring.with_amounts(fact1, forecast_layer(spark, d)["amounts"], amount.history_ids(a["comp"]))
    attrs = f.select("customer_id", "segment", "age_group", "gender", "housing", "adoption_label")
    return materialise(fact2.join(attrs, "customer_id", "left"), "trained-fact")


@query("label_sensitivity")
def q_label_sensitivity(spark, d):
    """Model A retrained on the recent label; AUC, Spearman rho between
    the two score vectors, level-distance histogram (F15)."""
    f = features_ckpt(spark, d)
    main = propensity_layer(spark, d)
    recent = layer(spark, d, "recent-model", lambda: models.retrain_model_a(f, "adoption_label_recent"))  # model A only, as in the reference
    s1 = main["scores"].where(F.col("model_used") == "A").select("customer_id", F.col("score").alias("s_main"))
    s2 = recent["scores"].select("customer_id", F.col("score").alias("s_recent"))
    both = s1.join(s2, "customer_id")
    rho = stats.spearman(both, "s_main", "s_recent").withColumnRenamed("n", "n_spearman")
    pop = f.select("customer_id", population().alias("population"))
    lv1 = rank.priority_levels(both.join(pop, "customer_id"), "s_main", ["population"])
    lv2 = rank.priority_levels(both.join(pop, "customer_id"), "s_recent", ["population"])
    hist = marts.level_shift(lv1, lv2)
    r = rho.first()  # one row: rho and its n
    changed = F.sum(F.when(F.col("distance") > 0, F.col("n")).otherwise(0)).over(Window.partitionBy())  # four rows
    total = F.sum("n").over(Window.partitionBy())
    z = F.lit(r["spearman"]) * F.sqrt(F.lit(r["n_spearman"] - 1).cast("double"))
    return rounded(hist.withColumn("share_changed", changed / total).withColumn("n_compared", total)
                   .withColumn("spearman", F.lit(r["spearman"])).withColumn("spearman_p", stats.p_from_z(z))
                   .withColumn("n_spearman", F.lit(r["n_spearman"]))
                   .withColumn("auc_main", F.lit(main["metrics"]["auc_a"]).cast("double"))
                   .withColumn("auc_recent", F.lit(recent["auc"]).cast("double")))


@query("summary_published")
def q_summary_published(spark, d):
    """MT5: the key/value summary of the trained fact with the models' metrics."""
    res = propensity_layer(spark, d)
    base = q_model_metrics(spark, d)
    counts = [F.lit(len(res["cols"][m])).alias(f"n_features_{m.lower()}") for m in ("A", "B")]
    return rounded(marts.key_value(sizing.executive_summary(trained_fact_layer(spark, d))).unionByName(
        marts.key_value(base.select("*", *counts))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
