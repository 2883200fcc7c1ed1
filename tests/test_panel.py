import datetime as dt
import random

import pytest

from balances.operators import panel

D = dt.date


def recs(spark, data):
    return spark.createDataFrame(data, "customer_id long, product string, obs_date date, balance double, row_key long")


def restated(rows, cut, last):
    """(customer, product, month) -> (balance, observed) by the rules."""
    month = lambda d: (d.year, d.month)
    out = {}
    for key in {r[:2] for r in rows}:
        mine = sorted((r for r in rows if r[:2] == key and (cut is None or r[2] <= cut)), key=lambda r: (r[2], r[4]))
        if not mine or month(mine[0][2]) > month(last):
            continue
        y, m = month(mine[0][2])
        value = None
        while (y, m) <= month(last):
            here = [r for r in mine if month(r[2]) == (y, m)]
            known = [r[3] for r in here if r[3] is not None]
            value = known[-1] if known else value
            out[(*key, D(y, m, 1))] = (value, int(bool(here)))
            y, m = (y, m + 1) if m < 12 else (y + 1, 1)
    return out


@pytest.mark.parametrize("cut", [D(2022, 3, 31), D(2022, 7, 14), None])
def test_panel_follows_the_rules(spark, cut):
    rng = random.Random(11)
    last = cut or D(2022, 5, 2)
    rows = [(rng.randrange(30), rng.choice("ab"), D(2021, 6, 1) + dt.timedelta(rng.randrange(420)),
             None if rng.random() < 0.1 else float(rng.randrange(1000)), k) for k in range(260)]
    got = {(r.customer_id, r.product, r.month): (r.balance_month, r.observed)
           for r in panel.monthly_panel(recs(spark, rows), cut=cut, max_month=last).collect()}
    assert got == restated(rows, cut, last)


def test_first_month(spark):
    rows = [(c, "p", D(2020, 12, 9) + dt.timedelta(31 * k), 1.0, k) for c in (4, 8) for k in range(c, 0, -3)]
    got = {r.customer_id: r.first_month for r in panel.first_month(recs(spark, rows)).collect()}
    assert got == {c: min(r[2] for r in rows if r[0] == c).replace(day=1) for c in (4, 8)}


def test_first_record_excludes_label_products(spark):
    df = recs(spark, [(1, "robo_advisor", D(2026, 1, 1), 1.0, 1), (1, "savings", D(2026, 3, 1), 1.0, 2),
                      (2, "robo_advisor", D(2026, 1, 1), 1.0, 3)])
    out = {r.customer_id: r.first_month for r in panel.first_record(df).collect()}
    assert out == {1: D(2026, 3, 1)}


@pytest.mark.parametrize("first, cut, months", [(D(2019, 11, 1), D(2021, 2, 28), 15), (D(2021, 2, 1), D(2021, 2, 1), 0)])
def test_tenure_months(spark, first, cut, months):
    df = spark.createDataFrame([(first,)], "first_month date")
    assert df.select(panel.tenure_months(cut)).first()[0] == months


def _panel(spark, values, observed, start=D(2026, 1, 1)):
    rows = []
    for i, (v, o) in enumerate(zip(values, observed)):
        m = start.month - 1 + i
        rows.append((1, "savings", D(start.year + m // 12, m % 12 + 1, 1), float(v), o))
    return spark.createDataFrame(rows, "customer_id long, product string, month date, balance_month double, observed int")


def variation(values):
    mean = sum(values) / len(values)
    return (sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5 / mean


def test_liquid_cv(spark):
    values, seen = [40, 70, 70, 10, 25, 90], [1, 1, 0, 1, 0, 0]
    r = panel.liquid_cv(_panel(spark, values, seen, start=D(2020, 9, 1)), D(2021, 2, 20)).first()
    assert r.liquid_cv == pytest.approx(variation(values), abs=1e-6) and r.liquid_cv_insufficient == 0


def test_liquid_cv_needs_observed_months(spark):
    r = panel.liquid_cv(_panel(spark, [5, 6, 7, 8], [1, 0, 0, 1]), D(2026, 4, 9)).first()
    assert r.liquid_cv is None and r.liquid_cv_insufficient == 1


def test_liquid_cv_negative_mean(spark):
    r = panel.liquid_cv(_panel(spark, [-7, -9, 4, -8], [1] * 4), D(2026, 4, 9)).first()
    assert r.liquid_cv is None and r.liquid_cv_insufficient == 0


@pytest.mark.parametrize("cut", [D(2023, 3, 1), D(2023, 3, 31)])
def test_liquid_cv_reads_the_six_months_to_the_cut(spark, cut):
    values = [900, 3, 14, 15, 92, 65, 35, 800]
    p = _panel(spark, values, [1] * 8, start=D(2022, 9, 1))  # the window is October to March
    r = panel.liquid_cv(p, cut, min_observed=6).first()
    assert r.liquid_cv == pytest.approx(variation(values[1:7]), abs=1e-6)
    assert panel.liquid_cv(p, cut, min_observed=7).first().liquid_cv is None


def test_temporal_split(spark):
    months = spark.createDataFrame([(D(2025, m, 1),) for m in range(1, 13)], "month date")
    r = panel.temporal_split_month(months, 3).first()
    assert r.valid_start == D(2025, 10, 1) and r.n_months == 12
    two = spark.createDataFrame([(D(2025, 1, 1),), (D(2025, 2, 1),)], "month date")
    with pytest.raises(Exception):
        panel.temporal_split_month(two, 3).collect()


def test_months_since_are_the_panels_own(spark):
    """Months listed from one month on are the panel's rows of those months, and
    no earlier month is a row on the way."""
    rng = random.Random(5)
    cut = D(2022, 6, 20)
    rows = [(rng.randrange(20), rng.choice("ab"), D(2020, 1, 1) + dt.timedelta(rng.randrange(900)),
             None if rng.random() < 0.2 else float(rng.randrange(1000)), k) for k in range(150)]
    df = recs(spark, rows)
    runs = panel.panel_runs(df, cut)
    whole = panel.monthly_panel(df, cut)
    since = D(2022, 1, 1)
    want = sorted((tuple(r) for r in whole.collect() if r.month >= since), key=str)
    assert want and sorted(map(tuple, panel.months_of(runs, since=since).collect()), key=str) == want
    assert sorted(map(tuple, panel.observed_months(runs).collect()), key=str) == sorted(
        (tuple(r) for r in whole.collect() if r.observed == 1), key=str)
    a = {tuple(r) for r in panel.liquid_cv(whole, cut, ["a"]).collect()}
    assert a and a == {tuple(r) for r in panel.liquid_cv(panel.months_of(runs, panel.window_start(cut)), cut, ["a"]).collect()}


def test_gold_features_do_not_list_the_panel(spark, monkeypatch):
    from balances.plans import common, queries
    d = "/root/testdata/sf0.001"
    monkeypatch.setattr(common, "_LAYERS", {})
    monkeypatch.setattr(queries, "panel_layer", lambda *a: pytest.fail("every month of the panel is written"))
    queries.features_ckpt(spark, d)
    queries.component_frames(spark, d)
