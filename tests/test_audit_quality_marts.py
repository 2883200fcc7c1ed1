import datetime as dt

import pytest
from pyspark.sql import functions as F

from balances.operators import audit, marts, quality, star


def test_selection_rates_and_ratio(spark):
    data = [("M", "A")] * 5 + [("M", "B")] * 5 + [("F", "A")] * 2 + [("F", "C")] * 8 + [(None, "D")] * 3
    df = spark.createDataFrame(data, "gender string, level string")
    rates = {r.group: r.selection_rate for r in audit.selection_rates(df, ["gender"]).collect()}
    assert rates == {"M": 0.5, "F": 0.2, "Sin dato": 0.0}
    di = audit.disparate_impact(audit.selection_rates(df, ["gender"])).first()
    assert di.impact_ratio == 0.0 and di.passes_80_rule == 0 and di.worst_group == "Sin dato"
    big = audit.disparate_impact(audit.selection_rates(df, ["gender"]), min_group_size=5).first()
    assert big.impact_ratio == pytest.approx(0.4)


def test_disparate_ratio_rules(spark):
    rates = spark.createDataFrame([("g", "a", 10, 1, 0.10), ("g", "b", 10, 1, 0.075),
                                   ("h", "a", 10, 0, 0.0), ("h", "b", 10, 0, 0.0)],
                                  "attribute string, group string, n long, n_selected long, selection_rate double")
    out = {r.attribute: r for r in audit.disparate_impact(rates).collect()}
    assert out["g"].impact_ratio == pytest.approx(0.75) and out["g"].passes_80_rule == 0
    assert out["h"].impact_ratio is None and out["h"].passes_80_rule == 0


def test_duplicates_and_not_verified(spark):
    df = spark.createDataFrame([(1, "p", 1), (1, "p", 1), (2, "p", 1)], "id long, product string, d int")
    d = quality.duplicate_keys(df, ["id", "product", "d"], "t").first()
    assert d.n_duplicates == 1 and d.status == "FAIL"
    g = quality.grain_check(df, ["id", "product", "missing_col"], "t").first()
    assert g.status is None and g.n_duplicates is None


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (3,)], "customer_id long")
    parent = spark.createDataFrame([(1,), (2,)], "customer_id long")
    assert quality.orphans(child, parent, "customer_id").first().n_orphans == 1


def test_star_schema(spark):
    panel = spark.createDataFrame([(1, "savings", dt.date(2026, m, 1), float(m), 1) for m in (1, 2, 3)],
                                  "customer_id long, product string, month date, balance_month double, observed int")
    feats = spark.createDataFrame([(1, "g", "F", "s", "OWNED")],
                                  "customer_id long, age_group string, gender string, segment string, housing string")
    s = star.star_schema(feats, panel)
    fact = s["fact_monthly"]
    assert fact.count() == 3 and fact.select("customer_id", "product_id", "date_id").distinct().count() == 3
    assert fact.where(F.col("product_id").isNull() | F.col("date_id").isNull()).count() == 0
    assert {r.date.day for r in s["dim_time"].collect()} == {1}
    rep = quality.constraint_report(s, {"dim_customer": ["customer_id"], "dim_product": ["product_id"],
                                        "dim_time": ["date_id"]}, {"fact_monthly": ["month"]},
                                    [("fact_monthly", "product_id", "dim_product", "product_id")])
    quality.assert_clean(rep)


def test_importance_iv_full_join(spark):
    imp = spark.createDataFrame([("dummy_x", 0.3), ("a", 0.2)], "variable string, importance double")
    iv = spark.createDataFrame([("a", 0.1), ("only_iv", 0.05)], "variable string, iv double")
    out = {r.variable: (r.importance, r.iv) for r in marts.importance_iv(imp, iv).collect()}
    assert out == {"dummy_x": (0.3, None), "a": (0.2, 0.1), "only_iv": (None, 0.05)}


def test_evidence_order_and_direction(spark):
    f = spark.createDataFrame([(1, 5.0, 1, None, 7.5), (2, 4.0, 0, 3.0, None), (3, 99.0, 1, 3.0, -4.5)],
                              "customer_id long, age double, tenure int, income double, mode_col double")
    edges = spark.createDataFrame(
        [("age", "quantile", None, [1.0, 4.0, 6.0, 9.0]), ("tenure", "value", None, None), ("income", "value", None, None),
         ("mode_col", "mode", -4.5, [1.0, 5.0, 8.0])], "variable string, kind string, mode double, edges array<double>")
    woe = spark.createDataFrame(
        [("age", "quantile", 1.0, 4.0, -0.3, 11), ("age", "quantile", 4.0, 6.0, 0.5, 10), ("age", "quantile", 6.0, 9.0, 0.2, 12),
         ("tenure", "value", 1.0, 1.0, -2.10, 20), ("income", "missing", None, None, 0.05, 30), ("income", "value", 3.0, 3.0, 0.4, 31),
         ("mode_col", "mode", -4.5, -4.5, 0.45, 40), ("mode_col", "quantile", 5.0, 8.0, -0.01, 41)],
        "variable string, bin_kind string, bin_lo double, bin_hi double, woe double, n long")
    ev = {}
    plan = marts.evidence_topk(f, edges, woe, k=3)
    for r in plan.orderBy("customer_id", "rank").collect():
        ev.setdefault(r.customer_id, []).append((r.variable, r.direction, r.value, r.bin_lo, r.n_in_bin))
    assert ev[1] == [("tenure", "in_favour", 1.0, 1.0, 20), ("age", "against", 5.0, 4.0, 10), ("income", "neutral", None, None, 30)]
    # 4.0 is the upper edge of the first bin; a value without a bin (tenure 0, missing mode_col) gives no evidence
    assert ev[2] == [("income", "against", 3.0, 3.0, 31), ("age", "in_favour", 4.0, 1.0, 11)]
    assert [v for v, *_ in ev[3]] == ["tenure", "mode_col", "income"]
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Window" not in text and "Expand" not in text


def test_targeting_curve(spark):
    df = spark.createDataFrame([(i, float(i), 1 if i >= 90 else 0) for i in range(100)],
                               "customer_id long, score double, y int")
    c = {r.top_pct: r for r in marts.targeting_curve(df, "score", "y").collect()}
    assert c[0.1].n_contacted == 10 and c[0.1].precision == pytest.approx(1.0)
    assert c[0.2].recall == pytest.approx(1.0) and c[0.01].n_contacted == 1


def test_level_shift_keeps_all_bins(spark):
    a = spark.createDataFrame([(1, "A"), (2, "D")], "customer_id long, level string")
    b = spark.createDataFrame([(1, "A"), (2, "A")], "customer_id long, level string")
    h = {r.distance: r.n for r in marts.level_shift(a, b).collect()}
    assert h == {0: 1, 1: 0, 2: 0, 3: 1}


def test_rules(spark):
    df = spark.createDataFrame([("gender", 0.5), ("x", 0.01), ("y", 0.2), ("z", None)], "variable string, iv double")
    out = {r.variable: r.d for r in df.select("variable", marts.inclusion_rule(F.col("variable"), F.col("iv"))
                                               .alias("d")).collect()}
    assert out == {"gender": "exclude_protected", "x": "exclude_low_iv", "y": "include", "z": "review"}
    h = spark.createDataFrame([(0.03, 0.0), (0.01, 0.05), (0.01, 0.01)], "c double, f double")
    assert [r[0] for r in h.select(marts.housing_rule(F.col("c"), F.col("f"))).collect()] == \
        ["keep_category", "keep_flag", "drop"]
    a = spark.createDataFrame([(0.5,), (0.65,), (0.9,)], "auc double")
    assert [r[0] for r in a.select(marts.auc_band("auc", 0.6, 0.7)).collect()] == ["low", "moderate", "high"]
    with pytest.raises(Exception):
        spark.createDataFrame([(1.5,)], "auc double").select(marts.auc_band("auc", 0.6, 0.7)).collect()


def test_figure_regression(spark):
    actual = spark.createDataFrame([("a", 100.0), ("b", 10.5)], "key string, value double")
    out = {r.key: r.status for r in marts.figure_regression(
        actual, {"a": 100.0, "b": 10.0, "c": 1.0}, {"b": 0.01}).collect()}
    assert out == {"a": "OK", "b": "FAIL", "c": "MISSING"}


def test_key_value(spark):
    s = spark.createDataFrame([(3, 1.5)], "n long, x double")
    assert {r.key: r.value for r in marts.key_value(s).collect()} == {"n": 3.0, "x": 1.5}


def test_primary_key_of_runs_leaves_few_rows(spark):
    """A key whose last column counts up is one digest per 64 values; nulls,
    negative numbers and repeats are told apart as before."""
    from balances.operators import quality
    rows = [(c, d) for c in (1, None) for d in [None, *range(-130, 130)]]
    clean = spark.createDataFrame(rows, "c long, d int")
    twice = spark.createDataFrame([*rows, (1, -130), (1, -130), (None, None), (1, 0)], "c long, d int")
    checks = [quality.Check("t", quality.PRIMARY_KEY, ("c", "d")), quality.Check("t", quality.PRIMARY_KEY, ("d",))]
    for df, again in ((clean, 0), (twice, 4)):
        got = {r["columns"]: (r.n_rows, r.violations) for r in quality.check_tables({"t": df}, checks).collect()}
        assert got == {"c,d": (df.count(), again), "d": (df.count(), df.count() - 261)}
    key, bit = quality._key_bits(clean, ("c", "d"))
    assert clean.select(*key).distinct().count() <= 2 * 7 and clean.select(*key, bit).distinct().count() == len(rows)
