import math

import numpy as np
import pandas as pd
import pytest

from balances.functions.columns import iv_class
from balances.operators import amount, stats


def test_iv_class(spark):
    vals = [0.001, 0.019, 0.02, 0.09, 0.1, 0.29, 0.3, 1.2]
    df = spark.createDataFrame([(v,) for v in vals], "iv double")
    out = [r[0] for r in df.select(iv_class("iv")).collect()]
    assert out == ["discard", "discard", "weak", "weak", "medium", "medium", "strong", "strong"]


def test_binning_mode_fallback(spark):
    vals = [-4.5] * 333 + [float(7 * i % 31) for i in range(24)]  # the least value holds most rows
    df = spark.createDataFrame([(i, v, i % 2) for i, v in enumerate(vals)], "id long, x double, y int")
    table = stats.values_of(df, "id", ["x"], "y")
    binned = stats.assign_numeric_bins(table, stats.numeric_bin_edges(table))
    kinds = {r.bin_kind for r in binned.select("bin_kind").distinct().collect()}
    assert "missing" not in kinds and "mode" in kinds
    assert binned.select("bin_kind", "bin_lo", "bin_hi").distinct().count() >= 2


def test_binning_matches_pandas_qcut(spark):
    rng = np.random.default_rng(42)
    x = rng.integers(0, 1000, size=400).astype(float)
    df = spark.createDataFrame([(i, float(v), 0) for i, v in enumerate(x)], "id long, x double, y int")
    long = stats.to_long(df, "id", ["x"], "y")
    binned = stats.assign_numeric_bins(long, stats.numeric_bin_edges(stats.values_of(df, "id", ["x"], "y")))
    ours = {r.id: (r.bin_lo, r.bin_hi) for r in binned.collect()}
    cats = pd.qcut(pd.Series(x), 10, duplicates="drop")
    for i, c in enumerate(cats):
        lo, hi = ours[i]
        assert hi == pytest.approx(c.right) and (lo == pytest.approx(c.left) or i == int(np.argmin(x)) or
                                                   lo == pytest.approx(float(np.min(x))))


def test_woe_missing_bin(spark):
    data = [(i, "PROPIA", 1 if i % 3 == 0 else 0) for i in range(100)] + \
           [(100 + i, "ARRENDADA", 1 if i % 5 == 0 else 0) for i in range(100)] + \
           [(200 + i, None, 1 if i % 2 == 0 else 0) for i in range(200)]
    df = spark.createDataFrame(data, "id long, housing string, y int")
    w = stats.woe_categorical(df, "id", ["housing"], "y").collect()
    assert "Sin dato" in {r.bin for r in w} and sum(r.n for r in w) == 400


def test_mann_whitney_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    x1 = rng.integers(0, 30, 40).astype(float)
    x0 = rng.integers(0, 30, 55).astype(float)
    data = [(i, float(v), 1) for i, v in enumerate(x1)] + [(100 + i, float(v), 0) for i, v in enumerate(x0)]
    df = spark.createDataFrame(data, "id long, x double, y int")
    r = stats.mann_whitney(stats.values_of(df, "id", ["x"], "y")).first()
    brute = sum((a > b) + 0.5 * (a == b) for a in x1 for b in x0)
    assert r.u == pytest.approx(brute)
    auc = stats.auc_exact(df, "id", "x", "y").first().auc
    assert auc == pytest.approx(brute / (40 * 55))


def test_chi2_yates_2x2(spark):
    # 2x2 table [[10, 20], [30, 40]]: Yates-corrected chi2
    data = [("a", 1)] * 10 + [("a", 0)] * 20 + [("b", 1)] * 30 + [("b", 0)] * 40
    df = spark.createDataFrame(data, "g string, y int")
    r = stats.chi2_cramer(df, ["g"], "y").first()
    obs = np.array([[10, 20], [30, 40]], dtype=float)
    exp = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    yates = (np.maximum(np.abs(obs - exp) - 0.5, 0) ** 2 / exp).sum()
    assert r.dof == 1 and r.chi2 == pytest.approx(yates)
    assert r.cramers_v == pytest.approx(math.sqrt(yates / 100))


def test_benjamini_hochberg(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate([0.001, 0.008, 0.039, 0.041, 0.042])],
                               "id long, p double")
    out = {r.id: (r.q_value, r.reject) for r in stats.benjamini_hochberg(df, "p", "id").collect()}
    assert all(v[1] == 1 for v in out.values()) and out[0][0] == pytest.approx(0.005)
    ps = [0.001] + [0.04] * 20 + [0.9] * 20
    df2 = spark.createDataFrame([(i, p) for i, p in enumerate(ps)], "id long, p double")
    rej = {r.id: r.reject for r in stats.benjamini_hochberg(df2, "p", "id").collect()}
    assert rej[0] == 1 and sum(rej.values()) == 1
    bad = spark.createDataFrame([(0, 0.1), (1, None)], "id long, p double")
    with pytest.raises(Exception):
        stats.benjamini_hochberg(bad, "p", "id").collect()


def test_vif_detects_collinearity(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(100, 10, 300)
    lia = rng.normal(50, 5, 300)
    df = spark.createDataFrame([(float(x), float(y), float(x - y)) for x, y in zip(a, lia)],
                               "assets double, liabilities double, equity double")
    v = stats.vif_general(df, ["assets", "liabilities", "equity"])
    assert (v["vif"] > 10).all()


def test_vif_closed_form_matches_general(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 3))
    x[:, 2] += 0.5 * x[:, 0]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    closed = {r.variable: r.vif for r in stats.correlation_3(df, "a", "b", "c").collect()}
    general = dict(zip(*stats.vif_general(df, ["a", "b", "c"]).values.T))
    for k in "abc":
        assert closed[k] == pytest.approx(general[k], rel=1e-9)


def test_mae_mape(spark):
    def run(real, pred, eps=1.0):
        df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(real, pred)], "real double, pred double")
        return stats.mae_mape(df, "real", "pred", eps).first()
    r = run([100, 200], [110, 180])
    assert r.mae == pytest.approx(15) and r.ape_mean == pytest.approx(0.10) and r.n == 2
    r = run([0, 100], [50, 110])
    assert r.n == 2 and r.n_ape == 1 and r.ape_mean == pytest.approx(0.10)
    r = run([100] * 4 + [1], [110] * 4 + [500], eps=0.5)
    assert r.ape_median_ratio == pytest.approx(0.10) and r.ape_mean > 50


def test_error_scenarios(spark):
    e = spark.createDataFrame([(i, float(v)) for i, v in enumerate([-50, -20, 0, 20, 50])], "id long, error double")
    r = stats.error_scenarios(e, "error", "id", 25, 75).first()
    assert (1000 + r.err_lo, 1000 + r.err_median, 1000 + r.err_hi) == (980, 1000, 1020)
    e2 = spark.createDataFrame([(i, float(v)) for i, v in enumerate([-100, -90, -80, -10, -5])], "id long, error double")
    r2 = stats.error_scenarios(e2, "error", "id", 10, 90).first()
    assert 1000 + r2.err_median == 920 and r2.err_lo <= r2.err_median <= r2.err_hi


def test_annualised_growth(spark):
    from balances.functions.columns import annualised_growth
    df = spark.createDataFrame([(1000.0, 1600.0, 6), (1000.0, 700.0, 6), (1.0, 2.0, 0)], "a double, b double, m int")
    out = [r[0] for r in df.select(annualised_growth("a", "b", "m")).collect()]
    assert out == [1200.0, -600.0, None]


def test_conditional_lift(spark):
    data = [(1, 1)] * 8 + [(1, 0)] * 2 + [(0, 1)] * 4 + [(0, 0)] * 6
    df = spark.createDataFrame(data, "a int, b int")
    assert stats.conditional_lift(df, "a", "b").first().lift == pytest.approx(0.8 / 0.4)


def test_p_values(spark):
    df = spark.createDataFrame([(1.959963984540054, 3.841458820694124, 1)], "z double, c double, k int")
    r = df.select(stats.p_from_z("z").alias("pz"), stats.p_from_chi2("c", "k").alias("pc")).first()
    assert r.pz == pytest.approx(0.05, abs=1e-9) and r.pc == pytest.approx(0.05, abs=1e-9)


def test_component_panel_missing_component_zero(spark):
    import datetime as dt
    p = spark.createDataFrame([(1, "term_deposit", dt.date(2026, 1, 1), 5.0, 1)],
                              "customer_id long, product string, month date, balance_month double, observed int")
    r = amount.component_panel(p).first()
    assert r.app == 0.0 and r.conservative == 5.0 and r.invested == 5.0


def test_component_panel_shuffles_observed_months_once(spark):
    """The months between two records are listed after the one shuffle, and the
    panel and its history equal a sum over every month."""
    import datetime as dt
    import random
    from balances.operators import panel
    rng = random.Random(5)
    products = ["savings", "term_deposit", "trust_fund", "robo_advisor"]
    recs = [(rng.choice([None, *range(1, 12)]), rng.choice(products), dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(700)),
             rng.choice([None, 0.0, -3.5, -1.0, 10.25, 7.0]), i) for i in range(150)] + [(50, "trust_fund", dt.date(2025, 3, 3), -1.0, 999)]
    df = spark.createDataFrame(recs, "customer_id long, product string, obs_date date, balance double, row_key long")
    made = panel.monthly_panel(df, dt.date(2025, 11, 20))
    months = spark.createDataFrame(made.collect(), made.schema)
    got = amount.component_panel(months)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") == 1
    want = {}
    for r in months.collect():
        for c, ps in amount.COMPONENTS.items():
            if r["product"] in ps:
                want.setdefault((r.customer_id, r.month), {k: 0.0 for k in amount.COMPONENTS})[c] += r.balance_month or 0.0
    found = {(r.customer_id, r.month): {c: r[c] for c in amount.COMPONENTS} for r in got.collect()}
    assert found == want and got.count() == len(want)
    assert got.where("invested <> app + conservative").count() == 0
    rich = {c for (c, _), v in want.items() if sum(v.values()) > 0 and c is not None}
    assert 50 not in rich and {r[0] for r in amount.with_history(got).select("customer_id").distinct().collect()} == rich
    assert {r[0] for r in amount.history_ids(amount.component_runs(months)).where("customer_id is not null").collect()} == rich
    plain = amount.component_panel(months.drop("observed"))
    assert {tuple(r) for r in plain.collect()} == {tuple(r) for r in got.collect()}


def test_cross_products_of_many_columns(spark):
    """Every pair's sum, from one row a task and pair, not one long projection."""
    import random
    rng = random.Random(2)
    data = [tuple(rng.gauss(0, 1) for _ in range(12)) for _ in range(500)]
    cols = [f"c{i}" for i in range(12)]
    df = spark.createDataFrame(data, cols).repartition(7)
    got = {(r.i, r.j): r.s for r in stats.cross_products(df, cols).collect()}
    assert len(got) == 78
    assert got == pytest.approx({(i, j): sum(x[i] * x[j] for x in data) for i in range(12) for j in range(i, 12)})
