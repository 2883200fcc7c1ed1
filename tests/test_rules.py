"""Rules, reports and layers: decisions, actions, quality report, monitoring inputs, total backtest, layouts."""
import datetime as dt
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from balances import session
from balances.operators import amount, asof, features, marts, models, quality, stats
from balances.plans import common, queries
from balances.session import materialise


def test_inclusion_decisions(spark):
    def run(iv_housing, iv_flag, vif=((("income"), 12.0), ("equity", 2.0))):
        iv = spark.createDataFrame([("income", 0.2), ("equity", 0.3), ("gender", 0.9), ("housing", iv_housing), ("low", 0.001), ("none", None),
                                    ("has_housing_data", iv_flag), ("missing_housing", iv_flag)], "variable string, iv double")
        iv = iv.withColumn("iv_class", F.lit("x"))
        v = spark.createDataFrame(list(vif), "variable string, vif double")
        return {r.variable: (r.decision, r.reason) for r in marts.inclusion_decisions(iv, v).collect()}
    out = run(0.12, 0.10)
    assert {k: d for k, (d, _) in out.items()} == {
        "income": "include_vif_alert", "equity": "include", "gender": "exclude_protected", "housing": "include", "low": "exclude_low_iv",
        "none": "review", "has_housing_data": "exclude_redundant", "missing_housing": "exclude_redundant"}
    assert out["gender"][1] == "suitability, not predictive power" and out["housing"][1] == "housing rule: keep_category"
    flag, none = run(0.01, 0.10), run(0.01, 0.01)
    assert flag["housing"][0] == "exclude_use_flag" and flag["has_housing_data"][0] == "include"
    assert none["housing"][0] == "exclude_block" and none["missing_housing"][0] == "exclude_redundant"


@pytest.mark.parametrize("auc, conclusion, action, flag, document", [
    (0.55, "about random", "keep_flag_without_imputing", 0, 0), (0.60, "weak pattern", "keep_flag_without_imputing", 0, 1),
    (0.70, "weak pattern", "keep_flag_without_imputing", 0, 1), (0.71, "informative absence", "flag_as_predictor_no_global_imputation", 1, 1)])
def test_pattern_and_imputation(spark, auc, conclusion, action, flag, document):
    df = spark.createDataFrame([(auc,)], "auc double").select("auc", *marts.pattern_decision())
    r = df.first()
    assert (r.conclusion, r.action, r.impute, r.flag_as_predictor, r.document_variables) == (conclusion, action, 0, flag, document)
    medians = spark.createDataFrame([("S1", 10.0), (None, 3.0)], "segment string, median double")
    plan = sorted((str(p.segment), p.kind, p.value) for p in marts.imputation_plan(df, medians).collect())
    assert plan == ([("None", "offered_segment_median", 3.0), ("S1", "offered_segment_median", 10.0)] if flag else [("None", "none", None)])
    strict = spark.createDataFrame([(auc,)], "auc double").select("auc", *marts.pattern_decision(handles_nulls=False))
    if not flag:
        assert strict.first().impute == 1 and {p.kind for p in marts.imputation_plan(strict, medians).collect()} == {"segment_median"}


def test_proxy_bands(spark):
    df = spark.createDataFrame([(0.59,), (0.60,), (0.70,), (0.701,)], "auc double").select("auc", *marts.proxy_decision())
    assert [r.action for r in df.orderBy("auc").collect()] == [
        "document_and_continue", "document_associated_variables", "document_associated_variables", "investigate_mitigation"]
    with pytest.raises(Exception):
        spark.createDataFrame([(1.2,)], "auc double").select(*marts.proxy_decision()).collect()


def test_total_is_the_sum_of_both_components(spark):
    bt = spark.createDataFrame([(1, "app", 10.0, 12.0), (1, "conservative", 5.0, 1.0), (2, "app", 7.0, 7.0), (3, "app", None, 1.0),
                                (3, "conservative", 2.0, 2.0)], "customer_id long, component string, real double, pred double")
    out = amount.with_total(bt)
    total = [r for r in out.collect() if r.component == amount.TOTAL]
    assert [(r.customer_id, r.real, r.pred, r.error) for r in total] == [(1, 15.0, 13.0, 2.0)]
    m = {r.component: r for r in stats.mae_mape(out, "real", "pred", group_cols=["component"]).collect()}
    assert m["total"].mae == 2.0 and m["total"].n == 1 and m["app"].n == 2
    assert {r.component for r in amount.scenarios_by_component(out).collect()} == {"app", "conservative", "total"}


def test_stratified_chi_square(spark):
    rows = [(1, 1, 1)] * 30 + [(1, 0, 1)] * 20 + [(0, 1, 1)] * 10 + [(0, 0, 0)] * 40
    df = spark.createDataFrame(rows, "flag int, y int, s int")
    got = {(r.stratum, r.flag): r for r in marts.stratified_rates(df, "flag", "y", "s").collect()}
    obs = np.array([[30, 20], [10, 40]], float)
    exp = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    want = ((np.abs(obs - exp) - 0.5) ** 2 / exp).sum()
    for flag in (0, 1):
        assert got["all", flag].chi2 == pytest.approx(want) and got["all", flag].rate_difference == pytest.approx(0.4)
        assert got["all", flag].dof == 1 and got["all", flag].p_value < 1e-3
    assert got["s", 0].n == 10 and got["s", 0].rate == 1.0


# --- quality -----------------------------------------------------------------------

def test_check_tables(spark):
    child = spark.createDataFrame([(1, "a", 5), (1, "a", 6), (2, None, 7), (None, "ñ", None), (9, "b", 1), (9, "b", 2)], "id long, name string, p long")
    parent = spark.createDataFrame([(1,), (5,), (6,), (2,)], "pid long")
    checks = [quality.Check("child", quality.PRIMARY_KEY, ("id", "name")), quality.Check("child", quality.PK_NOT_NULL, ("id", "name")),
              quality.Check("child", quality.NOT_NULL, ("p",)), quality.Check("child", quality.ASCII, ("name",)),
              quality.Check("child", quality.FOREIGN_KEY, ("p",), "parent", ("pid",)), quality.Check("child", quality.FOREIGN_KEY, ("id",), "parent", ("pid",)),
              quality.Check("parent", quality.PRIMARY_KEY, ("pid",)), quality.Check("child", quality.PRIMARY_KEY, ("missing",)),
              quality.Check("absent", quality.PRIMARY_KEY, ("id",)), quality.Check("child", quality.FOREIGN_KEY, ("id",), "absent", ("id",))]
    rep = quality.check_tables({"child": child, "parent": parent}, checks)
    got = {(r.table_name, r.constraint, r["columns"]): (r.n_rows, r.violations, r.status) for r in rep.collect()}
    assert got == {
        ("child", "primary_key", "id,name"): (6, 2, "FAIL"), ("child", "pk_not_null", "id,name"): (6, 2, "FAIL"),
        ("child", "not_null", "p"): (6, 1, "FAIL"), ("child", "ascii", "name"): (6, 1, "FAIL"),
        ("child", "foreign_key:parent", "p"): (5, 1, "FAIL"), ("child", "foreign_key:parent", "id"): (5, 1, "FAIL"),
        ("parent", "primary_key", "pid"): (4, 0, "OK"), ("child", "primary_key", "missing"): (None, None, "NOT VERIFIED"),
        ("absent", "primary_key", "id"): (None, None, "NOT VERIFIED"), ("child", "foreign_key:absent", "id"): (None, None, "NOT VERIFIED")}
    empty = quality.check_tables({"child": child.limit(0)}, checks[:1]).first()
    assert (empty.n_rows, empty.violations, empty.status) == (0, 0, "OK")


def test_each_table_is_read_once(spark, tmp_path):
    for name in ("child", "parent"):
        spark.range(20).selectExpr("id", "id % 7 AS p").write.parquet(f"{tmp_path}/{name}")
    frames = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in ("child", "parent")}
    checks = [quality.Check("child", quality.PRIMARY_KEY, ("id",)), quality.Check("child", quality.NOT_NULL, ("p",)),
              quality.Check("child", quality.FOREIGN_KEY, ("p",), "parent", ("id",)), quality.Check("parent", quality.PRIMARY_KEY, ("id",))]
    rep = quality.check_tables(frames, checks)
    assert {r.status for r in rep.collect()} == {"OK"}
    plan = rep._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2


# --- dedupe, cuts, layers --------------------------------------------------------------

def test_dedupe_first_total_order(spark):
    rows = [(1, 5, "b", 2.0), (1, 5, "a", 9.0), (1, 7, "0", 0.0), (2, None, "z", 1.0), (2, 3, "z", 4.0), (3, None, "y", 1.0), (3, None, "x", 2.0),
            (4, 1, "s", None), (4, 1, "s", None), (None, 2, "n", 1.0), (None, 1, "m", 1.0)] + [(5, 1, "hot", 1.0)] * 500
    df = spark.createDataFrame(rows, "k long, o int, name string, v double").repartition(4)
    got = sorted(((r.k is None, r.k or 0, r.o, r.name, r.v) for r in features.dedupe_first(df, "k", "o").collect()), key=str)
    assert got == sorted([(False, 1, 5, "a", 9.0), (False, 2, 3, "z", 4.0), (False, 3, None, "x", 2.0), (False, 4, 1, "s", None),
                          (True, 0, 1, "m", 1.0), (False, 5, 1, "hot", 1.0)], key=str)
    with pytest.raises(TypeError):
        features.dedupe_first(df, "k", "v")


def test_several_cuts_equal_one_at_a_time(spark):
    rng = np.random.default_rng(4)
    rows = [(int(rng.integers(0, 30)), ["savings", "checking"][int(rng.integers(0, 2))], dt.date(2025, 1, 1) + dt.timedelta(int(rng.integers(0, 500))),
             float(rng.integers(-50, 50)), i) for i in range(600)]
    recs = spark.createDataFrame(rows, "customer_id long, product string, obs_date date, balance double, row_key long")
    cuts = [dt.date(2025, 6, 30), dt.date(2026, 3, 31)]
    both = {r.customer_id: r.asDict() for r in asof.features_at_cuts(recs, cuts, ["savings", "checking"]).collect()}
    for i, c in enumerate(cuts):
        one = asof.product_pivot(recs, c, ["savings", "checking"])
        for r in one.collect():
            for k, v in r.asDict().items():
                assert k == "customer_id" or both[r.customer_id][f"c{i}_{k}"] == v


def test_profile_column_follows_the_measured_lift(spark):
    def base(pairs):
        return spark.createDataFrame([(i, a, b, 0) for i, (a, b) in enumerate(pairs)],
                                     "customer_id long, missing_estimator int, missing_housing int, missing_financial int")
    related = queries.profiled_features(base([(1, 1)] * 8 + [(1, 0)] * 2 + [(0, 1)] * 4 + [(0, 0)] * 6))  # lift 2.0
    assert related.where("incomplete_profile = 1").count() == 14 and related.count() == 20
    apart = queries.profiled_features(base([(1, 1)] * 5 + [(1, 0)] * 5 + [(0, 1)] * 5 + [(0, 0)] * 5))  # lift 1.0
    assert "incomplete_profile" not in apart.columns
    assert "incomplete_profile" not in queries.profiled_features(base([(0, 1)] * 4)).columns  # not measurable


def scanned_rows(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while not plan.children().isEmpty():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_point_lookup_opens_few_row_groups(spark):
    rows = spark.range(80_000).selectExpr("id * 10 AS customer_id", "CAST(id AS DOUBLE) AS x").orderBy(F.rand(3))
    plain, layer = materialise(rows, "plain"), materialise(rows, "clustered", lookup_by="customer_id")
    ask = lambda t, i: t.where(F.col("customer_id") == i)
    assert ask(layer, 4560).first().x == 456.0
    assert scanned_rows(ask(plain, 4560)) == 80_000
    assert 0 < scanned_rows(ask(layer, 4560)) <= 40_000  # one range of four, give or take the sampling
    assert scanned_rows(ask(layer, 4561)) == 0  # in range, but the bloom filter knows it is not there


def test_layers_follow_their_input(spark, tmp_path):
    d = str(tmp_path / "in")
    spark.range(3).write.parquet(f"{d}/t.parquet")
    build = lambda: materialise(spark.read.parquet(f"{d}/t.parquet").selectExpr("id + 1 AS id"), "layer-test")
    first = common.layer(spark, d, "x", build)
    assert first.count() == 3 and common.layer(spark, d, "x", build) is first
    path = session.WRITTEN[-1]
    shutil.copytree(f"{d}/t.parquet", f"{d}/u.parquet")
    second = common.layer(spark, d, "x", build)
    assert second is not first and second.count() == 3
    from balances.sources.sinks import path_exists
    assert not path_exists(spark, path) and path_exists(spark, session.WRITTEN[-1])


# --- importance ---------------------------------------------------------------------

def test_permutations_cover_the_whole_set(spark):
    rows = spark.range(300).withColumnRenamed("id", "customer_id")
    got = {}
    for parts in (1, 64):
        for r in models.permutations(rows.repartition(parts), 3).collect():
            got.setdefault((parts, r.repeat), []).append((r.customer_id, r.donor_id))
    for k in range(3):
        one = sorted(got[1, k])
        assert one == sorted(got[64, k])
        assert [i for i, _ in one] == list(range(300)) and sorted(x for _, x in one) == list(range(300))
        assert sum(i == x for i, x in one) < 12
    assert sorted(got[1, 0]) != sorted(got[1, 1])


def test_importance_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(400):
        a, b, c = float(rng.normal()), float(rng.normal()), ["u", "v", None][i % 3]
        rows.append((i, a if i % 11 else None, b, c, int(a + 0.3 * rng.normal() > 0)))
    df = spark.createDataFrame(rows, "customer_id long, income double, assets double, segment string, y int")
    cols = ["income", "assets", "segment"]
    m = models.fit_classifier(df, cols, "y", max_iter=5, max_depth=3)
    out = [sorted((r.variable, round(r.importance_mean, 12), round(r.importance_std, 12)) for r in models.permutation_importance(
        m, df.repartition(parts), cols, "y", cols, repeats=3).collect()) for parts in (1, 64)]
    assert out[0] == out[1] and {v for v, _, _ in out[0]} == set(cols)
    best = max(out[0], key=lambda r: r[1])
    assert best[0] == "income" and best[1] > 0.2
