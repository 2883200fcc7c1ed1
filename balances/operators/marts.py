"""Serving marts and report operators (L2-L6, PF11, A13, A14, A16-A18, A23,
A24, F15, J6, J11, M17, MT2-MT9, R1-R5, ST23, ST24, U4, DQ12, DQ13)."""
from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from balances.config import SETTINGS
from balances.functions.columns import clip_lower0, level_ordinal
from balances.operators.profile import sum0
from balances.operators import order_stats, roles, stats
from balances.operators.rank import distributed_row_number, exact_quantiles
from balances.session import materialise

S = SETTINGS
TOP_PCTS = (0.01, 0.05, 0.10, 0.20)


# ---------------------------------------------------------------- L4-L6
def targeting_curve(df: DataFrame, score_col: str, label_col: str, id_col: str = "customer_id",
                    pcts=TOP_PCTS) -> DataFrame:
    """Contacting the top pct by score: k = max(1, ceil(n pct)),
    precision = hits / k, recall = hits / positives, lift = precision / base
    rate. One distributed rank, then ONE aggregation for every pct."""
    x = df.where(F.col(score_col).isNotNull()).select(
        id_col, F.lit(1).alias("_g"), F.col(score_col).alias("_s"), F.col(label_col).alias("_y"))
    ranked = distributed_row_number(x, ["_g"], ["_s", id_col], descending=True)
    aggs = [F.first("n").alias("n"), F.sum("_y").alias("positives")]
    for i, p in enumerate(pcts):
        k = F.greatest(F.lit(1), F.ceil(F.col("n") * p))
        aggs.append(F.count_if((F.col("rn") <= k) & (F.col("_y") == 1)).alias(f"hits_{i}"))
    g = ranked.agg(*aggs)
    # one aggregate row -> one output row per pct (inline of an array of
    # structs: the aggregate is planned once, not once per pct)
    structs = [F.struct(F.lit(float(p)).alias("top_pct"),
                        F.greatest(F.lit(1), F.ceil(F.col("n") * p)).cast("long").alias("n_contacted"),
                        F.col(f"hits_{i}").cast("long").alias("hits"),
                        F.col("positives").cast("long").alias("positives"),
                        F.col("n").cast("long").alias("n"))
               for i, p in enumerate(pcts)]
    c = g.select(F.inline(F.array(*structs)))
    precision = F.col("hits") / F.col("n_contacted")
    return c.select("top_pct", "n_contacted", "hits", precision.alias("precision"),
                    F.when(F.col("positives") > 0, F.col("hits") / F.col("positives")).alias("recall"),
                    F.when(F.col("positives") > 0, precision / (F.col("positives") / F.col("n")))
                    .alias("lift"))


def curve_long(curve: DataFrame) -> DataFrame:
    """Melt precision / recall to long form."""
    return curve.unpivot(["top_pct"], ["precision", "recall"], "metric", "value")


# ---------------------------------------------------------------- PF11 / L2 / MT7
def facet_filter(df: DataFrame, populations=None, levels=None, segments=None,
                 only_with_amount: bool = False) -> DataFrame:
    """PF11: chained IN filters; an empty/None facet means no filter."""
    out = df
    for col, vals in (("population", populations), ("level", levels), ("segment", segments)):
        if vals:
            out = out.where(F.col(col).isin(list(vals)))
    if only_with_amount:
        out = out.where(F.col("has_investment_history") == 1)
    return out


def contact_list(df: DataFrame, n: int, populations=None, levels=("A",), segments=None,
                 only_with_amount: bool = False, percentile_mode: str = "filtered") -> DataFrame:
    """MT7/L2/W3: filtered customers ordered by percentile of the reference
    value inside their population, top ``n`` (the limit is the feature: a
    capped export). ``percentile_mode``: 'filtered' ranks within the selected
    rows (dashboard), 'whole_base' ranks first and filters after (web mart).
    Ids are exported as text (IO8)."""
    if percentile_mode == "whole_base":
        ranked = distributed_row_number(df.where(F.col("reference_value").isNotNull()),
                                        ["population"], ["reference_value", "customer_id"])
        sel = facet_filter(ranked, populations, levels, segments, only_with_amount)
    else:
        sel = facet_filter(df, populations, levels, segments, only_with_amount)
        sel = distributed_row_number(sel.where(F.col("reference_value").isNotNull()),
                                     ["population"], ["reference_value", "customer_id"])
    sel = sel.withColumn("percentile_in_group", F.col("rn") / F.col("n"))
    top = sel.orderBy(F.col("percentile_in_group").desc(), F.col("customer_id").asc()).limit(n)
    return top.select(F.col("customer_id").cast("string").alias("customer_id"), "population", "level",
                      "percentile_in_group", "segment", "age_group", "score", "model_used",
                      "amount_base_12m", "expected_value_12m")


# ---------------------------------------------------------------- A16-A18, U4, A17
def facet_counts(df: DataFrame) -> DataFrame:
    """A16/MT4: pre-aggregated facet counts (NULL segment kept)."""
    return df.groupBy("population", "level", "segment").agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        F.sum("has_investment_history").cast("long").alias("n_with_investment"),
        sum0(clip_lower0("amount_base_12m")).alias("gross_inflow"))


def facet_total(counts: DataFrame, populations=None, levels=None, segments=None) -> DataFrame:
    """Totals under a facet filter, read from the pre-aggregate."""
    f = facet_filter(counts, populations, levels, segments)
    return f.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"),
                 sum0("gross_inflow").alias("gross_inflow"))


def facet_values(df: DataFrame, facets=("population", "level", "segment")) -> DataFrame:
    """U4: distinct non-null values per facet (sorted by the consumer)."""
    parts = [df.select(F.lit(f).alias("facet"), F.col(f).cast("string").alias("value"))
             .where(F.col("value").isNotNull()).distinct() for f in facets]
    return reduce(DataFrame.unionByName, parts)


def population_strategies(df: DataFrame) -> DataFrame:
    """Per population: customers, with investment; acquisition (no
    products), activation (products but no investment), growth (investment)."""
    g = df.groupBy("population").agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        F.sum("has_investment_history").cast("long").alias("n_with_investment"))
    return g.withColumn("strategy_acquisition",
                        F.when(F.col("population") == "without_history", F.col("n")).otherwise(0)
                        .cast("long")) \
        .withColumn("strategy_activation",
                    F.when(F.col("population") == "with_history",
                           F.col("n") - F.col("n_with_investment")).otherwise(0).cast("long")) \
        .withColumn("strategy_growth", F.col("n_with_investment"))


# ---------------------------------------------------------------- A13/A14/ST23
def tie_mass(df: DataFrame, value_col: str = "reference_value") -> DataFrame:
    """ST23: per population, the modal value and its mass, values spread over
    several levels, and the A/B border (values present in both A and B) with
    the customers sitting on it. One groupBy(population, value) then one
    groupBy(population)."""
    per_value = df.where(F.col(value_col).isNotNull()).groupBy("population", value_col).agg(
        F.count(F.lit(1)).alias("c"), F.countDistinct("level").alias("n_levels"),
        F.max((F.col("level") == "A").cast("int")).alias("in_a"),
        F.max((F.col("level") == "B").cast("int")).alias("in_b"))
    border = (F.col("in_a") == 1) & (F.col("in_b") == 1)
    g = per_value.groupBy("population").agg(
        F.sum("c").cast("long").alias("n_customers"),
        F.max_by(F.col(value_col), F.struct(F.col("c"), -F.col(value_col))).alias("modal_value"),
        F.max("c").cast("long").alias("n_at_modal"),
        F.count_if(F.col("n_levels") > 1).cast("long").alias("n_values_multilevel"),
        F.count_if(border).cast("long").alias("n_values_border_ab"),
        F.coalesce(F.sum(F.when(border, F.col("c"))), F.lit(0)).cast("long").alias("n_customers_border_ab"))
    return (g.withColumn("pct_at_modal", F.col("n_at_modal") / F.col("n_customers"))
            .withColumn("pct_customers_border_ab", F.col("n_customers_border_ab") / F.col("n_customers")))


# ---------------------------------------------------------------- F15
def level_shift(a: DataFrame, b: DataFrame, key: str = "customer_id") -> DataFrame:
    """|ordinal(level_a) - ordinal(level_b)| histogram with all four
    bins 0..3 kept, plus the share >= 2."""
    j = a.select(key, F.col("level").alias("la")).join(
        b.select(key, F.col("level").alias("lb")), key, "inner")
    d = j.select(F.abs(level_ordinal("la") - level_ordinal("lb")).alias("distance")).where(
        F.col("distance").isNotNull())
    counts = d.groupBy("distance").agg(F.count(F.lit(1)).alias("n"))
    bins = d.sparkSession.range(0, 4).select(F.col("id").cast("int").alias("distance"))  # 4 bins
    h = bins.join(counts, "distance", "left").fillna(0, subset=["n"])
    w = Window.partitionBy()  # 4 rows
    tot = F.sum("n").over(w)
    return h.select("distance", F.col("n").cast("long").alias("n"),
                    (F.sum(F.when(F.col("distance") >= 2, F.col("n")).otherwise(0)).over(w) / tot)
                    .alias("share_distance_2_plus"))


# ---------------------------------------------------------------- A23/A24
def stratified_rates(df: DataFrame, flag_col: str, label_col: str, stratum_col: str) -> DataFrame:
    """Label rate by a flag, over everyone and inside the stratum
    (flag == 1); difference between the two flag groups, and their chi-square
    (Yates-corrected, one degree of freedom) with its p-value, attached to both.
    Both strata come from one count of (flag, stratum)."""
    cells = df.groupBy(flag_col, stratum_col).agg(F.count(F.lit(1)).alias("n"), F.sum(label_col).alias("positives"))
    strata = F.array(F.lit("all"), F.when(F.col(stratum_col) == 1, F.lit(stratum_col)))
    each = cells.withColumn("stratum", F.explode(F.array_compact(strata)))
    g = each.groupBy("stratum", flag_col).agg(F.sum("n").cast("long").alias("n"), F.sum("positives").cast("long").alias("positives"))
    g = g.withColumn("rate", F.col("positives") / F.col("n"))
    w = Window.partitionBy("stratum")  # two rows
    diff = (F.max(F.when(F.col(flag_col) == 1, F.col("rate"))).over(w)
            - F.max(F.when(F.col(flag_col) == 0, F.col("rate"))).over(w))
    n, pos = F.sum("n").over(w), F.sum("positives").over(w)
    groups = F.count(F.lit(1)).over(w)

    def cell(seen, total):
        expected = F.col("n") * total / n
        return F.pow(F.greatest(F.abs(seen - expected) - F.least(F.lit(0.5), F.abs(seen - expected)), F.lit(0.0)), 2) / expected
    both = (groups == 2) & (pos > 0) & (pos < n)
    g = g.withColumn("rate_difference", diff).withColumn(
        "_cell", F.when(both, cell(F.col("positives"), pos) + cell(F.col("n") - F.col("positives"), n - pos)))
    g = g.withColumn("chi2", F.sum("_cell").over(w)).withColumn("dof", F.when(F.col("chi2").isNotNull(), F.lit(1)))
    return g.withColumn("p_value", stats.p_from_chi2("chi2", "dof")).drop("_cell")


# ---------------------------------------------------------------- DQ13
def plausibility(df: DataFrame, col: str, threshold: float, id_col: str = "customer_id") -> DataFrame:
    """DQ13: range and percentiles reported, never corrected; count above a
    threshold."""
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    x = df.select(id_col, F.lit(col).alias("variable"), F.col(col).cast("double").alias("value"))
    q = exact_quantiles(x, ["variable"], "value", probs, id_col=id_col)
    wide = q.groupBy("variable").pivot("p", probs).agg(F.first("value"))
    names = {str(p): f"p{int(round(p * 100)):03d}" for p in probs}
    wide = wide.select("variable", *[F.col(f"`{k}`").alias(v) for k, v in names.items()])
    base = x.groupBy("variable").agg(F.count("value").cast("long").alias("n"),
                                     F.count_if(F.col("value") > threshold).cast("long").alias("n_above"))
    return base.join(wide, "variable")


# ---------------------------------------------------------------- J11 / M17 / W8
def _bin_lookup(edges, woe: list) -> tuple[str, str, list]:
    """For one variable, as SQL text: the number of a value's bin (search in the
    sorted edges), and the bins as JSON with their schema's fields."""
    v = f"CAST(`{edges['variable']}` AS DOUBLE)"
    place = {(w["bin_kind"], w["bin_lo"], w["bin_hi"]): i for i, w in enumerate(woe, 1)}
    e = edges["edges"] or []

    def number(x):
        return f"{x!r}D"
    cases = []
    if ("missing", None, None) in place:
        cases.append(f"WHEN {v} IS NULL THEN {place['missing', None, None]}")
    else:
        cases.append(f"WHEN {v} IS NULL THEN 0")
    for (kind, lo, hi), i in place.items():
        if kind in ("mode", "value"):
            cases.append(f"WHEN {v} = {number(lo)} THEN {i}")
    if not (edges["kind"] == "value" or (edges["kind"] == "mode" and len(e) < 2)):
        inner = e[1:-1]
        for k, upper in enumerate(inner):
            cases.append(f"WHEN {v} <= {number(upper)} THEN {place.get(('quantile', e[k], e[k + 1]), 0)}")
        cases.append(f"ELSE {place.get(('quantile', e[len(inner)], e[len(inner) + 1]), 0)}")
    bins = [{"bin_kind": w["bin_kind"], "bin_lo": w["bin_lo"], "bin_hi": w["bin_hi"], "woe": w["woe"], "n_in_bin": w["n"]} for w in woe]
    return v, "CASE " + " ".join(cases) + " END", bins


def evidence_topk(features: DataFrame, edges: DataFrame, woe: DataFrame, k: int = 3,
                  id_col: str = "customer_id") -> DataFrame:
    """M17 re-aimed as a batch: every customer's value finds its bin (J11) by a
    search in the variable's sorted edges, strength = |woe|, direction (|woe| <
    0.10 neutral, > 0 against, < 0 in favour), top-k by strength, then variable.

    All within the row: the bins (at most a dozen a variable) reach the driver
    and become part of the projection, so nothing is unpivoted or shuffled."""
    bins: dict = {}
    for r in woe.collect():  # variables x about a dozen bins
        bins.setdefault(r["variable"], []).append(r)
    schema = "array<struct<bin_kind:string,bin_lo:double,bin_hi:double,woe:double,n_in_bin:bigint>>"
    found = []
    for e in edges.collect():  # one row per variable
        v, number, rows = _bin_lookup(e, bins.get(e["variable"], []))
        bin_ = f"try_element_at(from_json('{json.dumps(rows)}', '{schema}'), nullif({number}, 0))"
        found.append((e["variable"], v, bin_))
    seen = features.select(id_col, *[F.expr(v).alias(f"_v{i}") for i, (_, v, _) in enumerate(found)],
                           *[F.expr(b).alias(f"_b{i}") for i, (_, _, b) in enumerate(found)])
    each = [F.when(F.col(f"_b{i}").isNotNull(), F.struct(
        (-F.abs(F.col(f"_b{i}.woe"))).alias("order"), F.lit(name).alias("variable"), F.col(f"_v{i}").alias("value"),
        F.col(f"_b{i}").alias("b"))) for i, (name, _, _) in enumerate(found)]
    best = F.slice(F.sort_array(F.filter(F.array(*each), lambda x: x.isNotNull())), 1, k)
    rows = seen.select(id_col, F.posexplode(best).alias("pos", "e"))
    w = F.col("e.b.woe")
    direction = (F.when(w.isNull() | (F.abs(w) < S.evidence_neutral_woe), F.lit("neutral"))
                 .when(w > 0, F.lit("against")).otherwise(F.lit("in_favour")))
    return rows.select(id_col, (F.col("pos") + 1).alias("rank"), "e.variable", "e.value", "e.b.bin_kind", "e.b.bin_lo", "e.b.bin_hi",
                       w.alias("woe"), F.abs(w).alias("strength"), direction.alias("direction"), "e.b.n_in_bin")


# ---------------------------------------------------------------- ST24
def psi(rows: DataFrame, group_col: str, n_bins: int = S.n_bins) -> DataFrame:
    """ST24: population stability index per group between a base period (y = 0)
    and a current one (y = 1) of long rows (group, value, y): bins = deciles of
    the base period (duplicates dropped), shares smoothed with +0.5 like the WoE:
    sum (p - q) ln(p / q). One value table gives edges and both periods' counts."""
    table = materialise(order_stats.value_table(rows.where(F.col("value").isNotNull()), [group_col]), "psi-values")
    probs = [i / n_bins for i in range(n_bins + 1)]
    q = order_stats.quantiles(order_stats.of_label(table, 0), [group_col], probs)
    edges = q.groupBy(group_col).agg(F.array_sort(F.array_distinct(F.collect_list("value"))).alias("e"))
    j = table.join(F.broadcast(edges), group_col)  # one row per group
    inner = F.slice(F.col("e"), 2, F.greatest(F.size("e") - 2, F.lit(0)))
    idx = F.size(F.filter(inner, lambda x: x < F.col("value")))
    b = j.groupBy(group_col, idx.alias("bin")).agg(
        F.sum(F.col("t") - F.col("events")).alias("n_base"), F.sum("events").alias("n_current"))
    w = Window.partitionBy(group_col)  # bins per group: bounded
    k = F.count(F.lit(1)).over(w)
    p = (F.col("n_current") + 0.5) / (F.sum("n_current").over(w) + 0.5 * k)
    qq = (F.col("n_base") + 0.5) / (F.sum("n_base").over(w) + 0.5 * k)
    b = b.withColumn("term", (p - qq) * F.log(p / qq))
    return b.groupBy(group_col).agg(F.sum("term").alias("psi"),
                                    F.count(F.lit(1)).cast("long").alias("n_bins"))


def indicator(name: str, variable, value, threshold: float, above: bool = True) -> list[F.Column]:
    """ST24: columns of a monitoring row; the alert compares with the threshold,
    and an unknown value is 'NOT VERIFIED', never silently fine."""
    v = value.cast("double")
    over = v > threshold if above else v < threshold
    return [F.lit(name).alias("indicator"), variable.cast("string").alias("variable"), v.alias("value"),
            F.lit(float(threshold)).alias("threshold"),
            F.when(v.isNull() | F.isnan(v), F.lit("NOT VERIFIED")).when(over, F.lit("ALERT")).otherwise(F.lit("OK")).alias("status")]


# ---------------------------------------------------------------- MT2 / J6
def importance_iv(importance: DataFrame, validation: DataFrame) -> DataFrame:
    """MT2/J6: full outer join of importance (with its model, where there is
    one) and the validation of variables; both unmatched sides kept, in the total
    order (L1) of model, falling importance, variable, NULLs last."""
    out = importance.join(validation, "variable", "full")
    order = [F.col("importance").desc_nulls_last(), F.col("variable").asc_nulls_last()]
    if "model" in out.columns:
        order.insert(0, F.col("model").asc_nulls_last())
    return out.orderBy(*order)


# ---------------------------------------------------------------- R1-R5
def auc_band(auc_col: str, weak: float, informative: float) -> F.Column:
    """AUC < weak -> 'random'/'minimal', <= informative -> 'weak'/
    'moderate', else 'informative'/'substantial'; outside [0, 1] -> error."""
    a = F.col(auc_col)
    return (F.when((a < 0) | (a > 1), F.raise_error(F.lit("AUC outside [0, 1]")).cast("string"))
            .when(a < weak, F.lit("low")).when(a <= informative, F.lit("moderate"))
            .otherwise(F.lit("high")))


def housing_rule(iv_category: F.Column, iv_flag: F.Column) -> F.Column:
    """R2: keep the category when its IV >= 0.02; else keep the has-data flag
    when its IV >= 0.02; else drop."""
    return (F.when(iv_category >= S.iv_min, F.lit("keep_category"))
            .when(iv_flag >= S.iv_min, F.lit("keep_flag")).otherwise(F.lit("drop")))


HOUSING_FLAGS = ("has_housing_data", "missing_housing")


def inclusion_rule(variable: F.Column, iv: F.Column, protected=("gender",), housing_decision: F.Column | None = None,
                   vif_alert: F.Column | None = None) -> F.Column:
    """Protected attributes are measured and never included, whatever their
    IV; housing per R2, and its has-data flags (one says what the other says, and
    the category says both) stay only where R2 keeps the flag; IV below the
    minimum -> exclude; a NULL IV is 'review' (never silently included); a VIF
    alert is carried along (a NULL one, of a categorical, is none)."""
    expr = F.when(variable.isin(list(protected)), F.lit("exclude_protected"))
    if housing_decision is not None:
        expr = expr.when(variable == "housing", F.when(housing_decision == "keep_category", F.lit("include"))
                         .when(housing_decision == "keep_flag", F.lit("exclude_use_flag")).otherwise(F.lit("exclude_block")))
        expr = expr.when(variable.isin(list(HOUSING_FLAGS)),
                         F.when(housing_decision == "keep_flag", F.lit("include")).otherwise(F.lit("exclude_redundant")))
    expr = expr.when(iv.isNull(), F.lit("review")).when(iv < S.iv_min, F.lit("exclude_low_iv"))
    if vif_alert is not None:
        expr = expr.when(F.coalesce(vif_alert == 1, F.lit(False)), F.lit("include_vif_alert"))
    return expr.otherwise(F.lit("include"))


def inclusion_decisions(iv: DataFrame, vif: DataFrame) -> DataFrame:
    """R5 for every variable: iv (variable, iv, iv_class) with vif, vif_alert,
    decision and the reason of an exclusion that the IV does not give."""
    w = Window.partitionBy()  # one row per variable
    iv_cat = F.max(F.when(F.col("variable") == "housing", F.col("iv"))).over(w)
    iv_flag = F.max(F.when(F.col("variable") == "has_housing_data", F.col("iv"))).over(w)
    out = iv.join(vif, "variable", "left").withColumn("vif_alert", (F.col("vif") > S.vif_alert).cast("int"))
    out = out.withColumn("_housing", housing_rule(iv_cat, iv_flag))
    out = out.withColumn("decision", inclusion_rule(
        F.col("variable"), F.col("iv"), housing_decision=F.col("_housing"), vif_alert=F.col("vif_alert")))
    reason = (F.when(F.col("decision") == "exclude_protected", F.lit("suitability, not predictive power"))
              .when(F.col("variable").isin("housing", *HOUSING_FLAGS), F.concat(F.lit("housing rule: "), F.col("_housing")))
              .when(F.col("decision") == "exclude_low_iv", F.lit("iv below minimum"))
              .when(F.col("decision") == "include_vif_alert", F.lit("collinear, reported")))
    return out.withColumn("reason", reason).drop("_housing")


#: Decisions by which a variable stays.
INCLUDED = ("include", "include_vif_alert")


def pattern_decision(auc: str = "auc", handles_nulls: bool = True) -> list[F.Column]:
    """What an auxiliary model's AUC for "this value is missing" calls for:
    conclusion, action, impute, flag_as_predictor, document_variables. The edges
    belong to the middle band; an AUC outside [0, 1] is refused."""
    band = auc_band(auc, S.auc_pattern_weak, S.auc_pattern_informative)
    keep = "keep_flag_without_imputing" if handles_nulls else "keep_flag_impute_segment_median"
    return [band.alias("band"),
            F.when(band == "low", F.lit("about random")).when(band == "moderate", F.lit("weak pattern"))
            .otherwise(F.lit("informative absence")).alias("conclusion"),
            F.when(band == "high", F.lit("flag_as_predictor_no_global_imputation")).otherwise(F.lit(keep)).alias("action"),
            F.when(band == "high", F.lit(0)).otherwise(F.lit(int(not handles_nulls))).alias("impute"),
            (band == "high").cast("int").alias("flag_as_predictor"),
            (band != "low").cast("int").alias("document_variables")]


def proxy_decision(auc: str = "auc") -> list[F.Column]:
    """The same columns for a model of the protected attribute."""
    band = auc_band(auc, S.auc_proxy_moderate, S.auc_proxy_substantial)
    none = F.lit(None).cast("int")
    return [band.alias("band"),
            F.when(band == "low", F.lit("minimal proxy")).when(band == "moderate", F.lit("moderate proxy"))
            .otherwise(F.lit("substantial proxy")).alias("conclusion"),
            F.when(band == "low", F.lit("document_and_continue")).when(band == "moderate", F.lit("document_associated_variables"))
            .otherwise(F.lit("investigate_mitigation")).alias("action"),
            none.alias("impute"), none.alias("flag_as_predictor"), (band != "low").cast("int").alias("document_variables")]


def imputation_plan(pattern: DataFrame, medians: DataFrame) -> DataFrame:
    """What the pattern's action does with the missing value. ``pattern`` is
    one row with ``action``; ``medians`` (segment, median) become the values that
    are imputed, or, where the flag is a predictor, offered per segment. An
    action that leaves the value as it is gives one row without values."""
    action = pattern.first()["action"]  # one scalar
    if action == "keep_flag_without_imputing":
        return pattern.select("action", F.lit("none").alias("kind"), F.lit(None).cast("string").alias("segment"),
                              F.lit(None).cast("double").alias("value"))
    kind = "segment_median" if action == "keep_flag_impute_segment_median" else "offered_segment_median"
    return medians.select(F.lit(action).alias("action"), F.lit(kind).alias("kind"), "segment", F.col("median").alias("value"))


def column_roles(columns) -> list[tuple[str, str]]:
    """column role from the schema (driver-side on the column list)."""
    return [(c, roles.role(c)) for c in columns]


def table_profile(df: DataFrame, decisions: DataFrame | None = None) -> DataFrame:
    """DQ12: per column: type, NULL count and share, role, IV and inclusion
    decision (left join) — the NULL counts come from ONE aggregation over all
    columns."""
    spark = df.sparkSession
    types = dict(df.dtypes)
    named = spark.createDataFrame([(c, r, types[c]) for c, r in column_roles(df.columns)], "variable string, role string, type string")
    agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    nulls = agg.unpivot(["_rows"], df.columns, "variable", "n_null").select(
        "variable", F.col("n_null").cast("long"), F.when(F.col("_rows") > 0, F.col("n_null") / F.col("_rows")).alias("null_share"))
    out = named.join(nulls, "variable")
    if decisions is not None:
        out = out.join(decisions.select("variable", "iv", "iv_class", "decision"), "variable", "left")
    return out



# ---------------------------------------------------------------- MT3 / MT5 / DQ10
def serving_table(fact: DataFrame) -> DataFrame:
    """MT3: score fact joined to the customer attributes, id as text, and the
    percentile inside the population computed over the WHOLE base (the web
    mart's mode; the dashboard's filtered mode is ``contact_list``)."""
    r = distributed_row_number(fact.where(F.col("reference_value").isNotNull()),
                               ["population"], ["reference_value", "customer_id"])
    return r.select(F.col("customer_id").cast("string").alias("customer_id"), "population", "level",
                    (F.col("rn") / F.col("n")).alias("percentile_in_group"), "segment", "age_group",
                    "score", "model_used", "amount_base_12m", "expected_value_12m",
                    "has_investment_history")


def key_value(summary: DataFrame) -> DataFrame:
    """MT5: a one-row summary stacked to (key, value) rows; what is no number
    is left out."""
    cols = [c for c, kind in summary.dtypes if kind != "string"]
    return summary.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "key", "value")


def figure_regression(actual: DataFrame, expected: dict, tolerance: dict | None = None) -> DataFrame:
    """DQ10: compare (key, value) figures with published ones; relative
    tolerance per key (default exact); status OK / FAIL / MISSING."""
    spark = actual.sparkSession
    tol = tolerance or {}
    exp = spark.createDataFrame([(k, float(v), float(tol.get(k, 0.0))) for k, v in expected.items()],
                                "key string, expected double, tolerance double")
    j = exp.join(actual, "key", "left")
    rel = F.abs(F.col("value") - F.col("expected")) / F.greatest(F.abs(F.col("expected")), F.lit(1e-12))
    status = (F.when(F.col("value").isNull(), F.lit("MISSING"))
              .when(rel <= F.col("tolerance"), F.lit("OK")).otherwise(F.lit("FAIL")))
    return j.select("key", "expected", "value", "tolerance", status.alias("status"))
