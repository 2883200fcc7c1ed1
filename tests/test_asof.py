"""The as-of snapshot against a plain restatement of its rules on random
records, and the rules' edges one by one."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from balances.functions.columns import normalize_product
from balances.operators import asof

D = dt.date
SCHEMA = "customer_id long, product string, obs_date date, balance double, row_key long, source string"


def recs(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def months_back(day, n):
    y, m = divmod(day.year * 12 + day.month - 1 - n, 12)
    last = (D(y + (m + 1) // 12, (m + 1) % 12 + 1, 1) - dt.timedelta(1)).day
    return D(y, m + 1, min(day.day, last))


def restated(rows, cut):
    """Snapshot, date, window mean, window count and trend by the rules."""
    mean = lambda v: sum(v) / len(v) if v else None
    out = {}
    for key in {r[:2] for r in rows}:
        mine = [r for r in rows if r[:2] == key and r[2] <= cut]
        if not mine:
            continue
        known = [r for r in mine if r[3] is not None]
        last = max(known, key=lambda r: (r[2], r[4]), default=None)
        window = [r for r in known if r[2] >= months_back(cut, 6)]
        half = months_back(cut, 3)
        new, old = mean([r[3] for r in window if r[2] >= half]), mean([r[3] for r in window if r[2] < half])
        out[key] = (last and last[3], max(r[2] for r in mine), mean([r[3] for r in window]), len(window),
                    None if new is None or old is None else new - old)
    return out


@pytest.mark.parametrize("cut", [D(2023, 8, 31), D(2024, 2, 29), D(2024, 5, 10)])
def test_snapshot_follows_the_rules(spark, cut):
    rng = random.Random(cut.toordinal())
    rows = []
    for k in range(700):  # few days per group, so that days and window edges coincide
        day = rng.choice([cut, months_back(cut, 3), months_back(cut, 6), cut - dt.timedelta(rng.randrange(-40, 400))])
        value = None if rng.random() < 0.15 else float(rng.randrange(-500, 500))
        rows.append((rng.randrange(40), rng.choice("xyz"), day, value, rng.choice([k, -k, k << 45]), "s"))
    got = {(r.customer_id, r.product): r for r in asof.balance_snapshot(recs(spark, rows), cut).collect()}
    want = restated(rows, cut)
    assert got.keys() == want.keys()
    for key, (value, day, mean, n, trend) in want.items():
        r = got[key]
        assert (r.balance_snapshot, r.snapshot_date, r.n_obs_window, r.holding) == (value, day, n, 1)
        assert r.balance_mean_6m == (None if mean is None else pytest.approx(mean))
        assert r.trend_6m == (None if trend is None else pytest.approx(trend))


@pytest.mark.parametrize("keys", [(4, 9), (-(1 << 62), -5), ((1 << 62), (1 << 62) + 1), (-1, 0), (None, 3)])
def test_any_long_breaks_ties(spark, keys):
    day = D(2022, 11, 30)
    rows = [(5, "p", day, float(i), k, "s") for i, k in enumerate(keys)] + [(5, "p", day - dt.timedelta(1), 77.0, 1 << 62, "s")]
    assert asof.balance_snapshot(recs(spark, rows), day).first().balance_snapshot == 1.0


def test_global_cut_and_report(spark):
    rows = [(c, "p", D(2021, 3, 1) + dt.timedelta(7 * c + s), 1.0, c, f"s{s}") for c in range(6) for s in range(3)]
    rows += [(9, "p", D(2021, 9, 9), 2.0, 1, "s2")]
    ends = {s: max(r[2] for r in rows if r[5] == s) for s in ("s0", "s1", "s2")}
    cut = asof.global_cut(recs(spark, rows))
    assert cut == min(ends.values()) == D(2021, 4, 5)
    for r in asof.cut_report(recs(spark, rows), cut).collect():
        mine = [x for x in rows if x[5] == r.source]
        dropped = [c for c in {x[0] for x in mine} if all(x[2] > cut for x in mine if x[0] == c)]
        assert (r.rows_total, r.rows_after_cut, r.groups_dropped, r.max_date, r.lag_days) == (
            len(mine), sum(x[2] > cut for x in mine), len(dropped), ends[r.source], (ends[r.source] - cut).days)


def test_relative_trend(spark):
    pairs = [(30.0, 120.0), (-8.0, 16.0), (3.0, 0.0), (3.0, -4.0), (None, 5.0), (2.0, None)]
    df = spark.createDataFrame(pairs, "t double, m double")
    assert [r[0] for r in df.select(asof.relative_trend("t", "m")).collect()] == [0.25, -0.5, None, None, None, None]


def test_product_normaliser(spark):
    names = ["INVERSI?N VIRTUAL", "INVERSION VIRTUAL 2", "CDT", "CDT 90", "", None]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    assert [r[0] for r in df.select(normalize_product("p")).collect()] == [
        "INVERSION_VIRTUAL", "INVERSION_VIRTUAL", "CDT", "CDT 90", "", None]


def test_unmapped_product_fails(spark):
    from balances.sources.tables import product_slug
    df = spark.createDataFrame([("UNKNOWN",)], "p string")
    with pytest.raises(Exception):
        df.select(product_slug(F.col("p"))).collect()
