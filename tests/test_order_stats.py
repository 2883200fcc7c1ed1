"""Order statistics from ranked values against sorted rows."""
import numpy as np
import pytest

from balances.operators import order_stats, stats


def rows(seed, n=700):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        out.append((i, ["a", "b", None][i % 3], None if rng.random() < 0.1 else float(rng.integers(-20, 20)) / 4, int(rng.integers(0, 2))))
    out += [(n + i, "hot", 1.5, i % 2) for i in range(n // 2)] + [(9999, "none", None, 1), (9998, "zero", -0.0, 0), (9997, "zero", 0.0, 1)]
    return out


@pytest.mark.parametrize("block", [1_000_000, 7])
def test_value_table(spark, monkeypatch, block):
    monkeypatch.setattr(order_stats, "BLOCK_VALUES", block)
    data = rows(1)
    df = spark.createDataFrame(data, "id long, variable string, value double, y int")
    got = order_stats.value_table(df.repartition(5)).collect()
    groups = {v for _, v, _, _ in data}
    assert {r.variable for r in got} == groups
    for g in groups:
        mine = [(v, y) for _, k, v, y in data if k == g and v is not None]
        want = {}
        for value in {v for v, _ in mine}:
            want[value] = (sum(v == value for v, _ in mine), sum(y for v, y in mine if v == value), sum(v < value for v, _ in mine),
                           sum(y for v, y in mine if v < value), len(mine), sum(y for _, y in mine))
        assert {r.value: (r.t, r.events, r.before, r.events_before, r.n, r.n_events)
                for r in got if r.variable == g and r.value is not None} == want
        nulls = [r for r in got if r.variable == g and r.value is None]
        assert sum(r.t for r in nulls) == sum(1 for _, k, v, _ in data if k == g and v is None) and len(nulls) <= 1
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    table = order_stats.value_table(df)
    for label in (None, 0, 1):
        t = table if label is None else order_stats.of_label(table, label)
        for r in order_stats.quantiles(t, ["variable"], probs).collect():
            mine = [v for _, k, v, y in data if k == r.variable and v is not None and label in (None, y)]
            assert r.value == pytest.approx(np.percentile(mine, 100 * r.p), abs=1e-12)


def test_without_value(spark):
    data = [(0, "x", v, 0) for v in [5.0] * 9 + [1.0, 2.0, 3.0, 7.0, 8.0, 8.0]]
    table = order_stats.value_table(spark.createDataFrame(data, "id long, variable string, value double, y int"))
    top = order_stats.modes(table).first()
    assert (top.mode, top.nunique) == (5.0, 6)
    rest = order_stats.without_value(table.join(order_stats.modes(table), "variable"), "mode")
    got = {r.p: r.value for r in order_stats.quantiles(rest, ["variable"], [0.0, 0.5, 0.9]).collect()}
    assert got == {p: pytest.approx(np.percentile([1, 2, 3, 7, 8, 8], 100 * p)) for p in got} and len(got) == 3


@pytest.mark.parametrize("seed", [1, 2])
def test_rank_correlation(spark, seed):
    rng = np.random.default_rng(seed)
    a = np.where(rng.random(3000) < 0.6, 0.0, rng.integers(0, 2500, 3000)).astype(float)  # one hot value, many rare ones
    b = np.where(rng.random(3000) < 0.5, a + rng.integers(0, 9, 3000), rng.integers(0, 2500, 3000)).astype(float)

    def mid(x):
        order, out = np.sort(x), np.empty(len(x))
        for i, v in enumerate(x):
            out[i] = (np.searchsorted(order, v) + 1 + np.searchsorted(order, v, "right")) / 2
        return out
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)] + [(None, 1.0), (2.0, None)], "a double, b double")
    r = stats.spearman(df, "a", "b").first()
    assert r.n == 3000 and r.spearman == pytest.approx(np.corrcoef(mid(a), mid(b))[0, 1], abs=1e-12)
    flat = spark.createDataFrame([(1.0, 2.0)] * 5, "a double, b double")
    assert stats.spearman(flat, "a", "b").first().spearman is None and stats.spearman(flat.limit(0), "a", "b").first().n == 0


def test_statistics_do_not_rank_rows(spark):
    """No range sort of rows: the only sorts are over distinct values."""
    df = spark.createDataFrame([(i, float(i % 5), i % 2) for i in range(100)], "id long, x double, y int")
    table = stats.values_of(df, "id", ["x"], "y")
    assert table.count() == 5
    assert "rangepartitioning" not in table._jdf.queryExecution().toString().lower()


def test_closed_form_p_values(spark):
    import math
    zs = [0.0, 1e-7, 1e-4, 0.01, 0.3, 1.0, 1.96, 3.3, 6.0, 8.2, 12.0, -2.5]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    for z, p in df.select("z", stats.p_from_z("z")).collect():
        assert p == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), rel=1e-9, abs=1e-14)

    def gamma_q(a, x):  # integrates the density
        t = np.linspace(x, x + 200, 2_000_001)
        f = np.exp(-t + (a - 1) * np.log(np.maximum(t, 1e-300)) - math.lgamma(a))
        return float(((f[1:] + f[:-1]) / 2).sum() * (t[1] - t[0]))
    cases = [(x, k) for k in (1, 2, 3, 4, 5, 8, 11) for x in (0.5, 3.84, 12.0, 40.0)]
    df = spark.createDataFrame(cases, "x double, k int")
    for x, k, p in df.select("x", "k", stats.p_from_chi2("x", "k")).collect():
        assert p == pytest.approx(gamma_q(k / 2, x / 2), rel=1e-5, abs=1e-12)
    edge = spark.createDataFrame([(0.0, 1), (None, 2), (3.0, 0)], "x double, k int").select(stats.p_from_chi2("x", "k")).collect()
    assert [r[0] for r in edge] == [1.0, None, None]
