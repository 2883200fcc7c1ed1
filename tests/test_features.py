import datetime as dt

import pytest
from pyspark.sql import functions as F

from balances.functions.columns import safe_divide
from balances.operators import features, panel

D = dt.date
CUST_SCHEMA = ("customer_id long, name string, age_group string, gender string, segment string, "
               "housing string, income double, expenses double, assets double, liabilities double, "
               "equity double")


def build(spark, customers, records, estimates=(), cut=D(2026, 3, 1), lift=None):
    c = features.clean_customers(spark.createDataFrame(customers, CUST_SCHEMA))
    r = spark.createDataFrame(records, "customer_id long, product string, obs_date date, balance double, row_key long")
    e = spark.createDataFrame(list(estimates), "customer_id long, income_estimate double") \
        .withColumn("has_income_estimate", F.lit(True))
    p = panel.monthly_panel(r, cut)
    return features.customer_features(c, r, e, panel.liquid_cv(p, cut), panel.first_record(r), cut, lift)


def cust(i, income=None, expenses=None, housing=None):
    return (i, f"c{i}", "g", "F", "s", housing, income, expenses, None, None, None)


def test_gold_integration(spark):
    recs = [(501, "savings", D(2026, m, 1), float(v), m) for m, v in ((1, 100), (2, 200), (3, 300))]
    r = build(spark, [cust(501, 1000.0, 400.0)], recs).first()
    assert r.expense_income_ratio == pytest.approx(0.4)
    assert r.liquid_balance_total == 300 and r.n_products_total == 1
    assert r.housing == "Sin dato" and r.missing_housing == 1
    assert r.liquid_cv == pytest.approx(0.408248, abs=1e-6)
    assert r.tenure_months == 2


def test_label_history_trainable(spark):
    recs = [(201, "robo_advisor", D(2026, 2, 1), 500.0, 1), (202, "term_deposit", D(2026, 2, 1), 1000.0, 2)]
    custs = [cust(201), cust(202), cust(203), cust(204)]
    out = {r.customer_id: r for r in build(spark, custs, recs, [(204, 10.0)]).collect()}
    assert [out[i].adoption_label for i in (201, 202)] == [1, 0]
    assert [out[i].has_product_history for i in (201, 202, 203, 204)] == [1, 1, 0, 0]
    assert out[203].trainable == 0 and out[204].trainable == 1


def test_absent_product_zero_filled(spark):
    recs = [(301, "savings", D(2026, 2, 1), 5.0, 1)]
    r = build(spark, [cust(301)], recs).first()
    assert r.trust_fund_balance_snapshot == 0 and r.trust_fund_balance_mean_6m == 0
    assert r.trust_fund_holding == 0 and r.trust_fund_n_obs_window == 0


def test_present_product_empty_window_stays_null(spark):
    recs = [(302, "savings", D(2020, 1, 1), 5.0, 1)]
    r = build(spark, [cust(302)], recs).first()
    assert r.savings_balance_mean_6m is None and r.savings_holding == 1


def test_non_label_investment_aggregates(spark):
    recs = [(301, "robo_advisor", D(2026, 2, 1), 9e6, 1), (302, "trust_fund", D(2026, 2, 1), 700.0, 2),
            (302, "term_deposit", D(2026, 2, 1), 300.0, 3)]
    out = {r.customer_id: r for r in build(spark, [cust(301), cust(302)], recs).collect()}
    assert (out[301].n_invest_non_label, out[302].n_invest_non_label) == (0, 2)
    assert (out[301].invested_non_label_balance, out[302].invested_non_label_balance) == (0, 1000)


def test_recency_and_recent_label(spark):
    recs = [(601, "robo_advisor", D(2026, 5, 15), 10.0, 1), (602, "robo_advisor", D(2025, 1, 1), 10.0, 2)]
    out = {r.customer_id: r for r in build(spark, [cust(601), cust(602), cust(603)], recs,
                                           cut=D(2026, 6, 1)).collect()}
    assert [out[i].adoption_label for i in (601, 602, 603)] == [1, 1, 0]
    assert [out[i].adoption_label_recent for i in (601, 602, 603)] == [1, 0, 0]
    assert all(out[i].days_since_last_data is None and out[i].no_recent_data == 1 for i in out)


def test_incomplete_profile_rule(spark):
    recs = [(1, "savings", D(2026, 2, 1), 5.0, 1)]
    custs = [cust(1, 10.0, 1.0, "OWNED"), cust(2), cust(3, 5.0, 1.0)]
    with_flag = build(spark, custs, recs, [(1, 3.0)], lift=2.4)
    assert "incomplete_profile" in with_flag.columns
    flags = {r.customer_id: r.incomplete_profile for r in with_flag.collect()}
    assert flags == {1: 0, 2: 1, 3: 1}
    assert "incomplete_profile" not in build(spark, custs, recs, lift=1.05).columns


def test_safe_divide(spark):
    df = spark.createDataFrame([(10.0, 2.0), (10.0, 0.0), (0.0, 0.0), (10.0, -5.0)], "n double, d double")
    out = df.select(safe_divide("n", "d").alias("a"), safe_divide("n", "d", True).alias("b")).collect()
    assert [r.a for r in out] == [5.0, None, None, -2.0]
    assert out[3].b is None


def test_dedupe_keeps_first_by_order(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "c", 3)], "k long, name string, v int")
    out = {r.k: r.v for r in features.dedupe_first(df, "k", "v").collect()}
    assert out == {1: 1, 2: 3}


def test_missing_financial_any_all(spark):
    c = features.clean_customers(spark.createDataFrame(
        [(1, "a", None, None, None, None, 1.0, None, None, None, None),
         (2, "b", None, None, None, None, None, None, None, None, None)], CUST_SCHEMA))
    out = {r.customer_id: (r.no_financial_any, r.no_financial_all) for r in c.collect()}
    assert out == {1: (True, False), 2: (True, True)}
