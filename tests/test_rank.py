import numpy as np
import pytest

from balances.operators import rank


def levels(spark, values, pops=None, distributed=True):
    pops = pops or ["p"] * len(values)
    df = spark.createDataFrame([(i, p, v) for i, (p, v) in enumerate(zip(pops, values))],
                               "customer_id long, population string, value double")
    return {r.customer_id: r.level for r in
            rank.priority_levels(df, "value", ["population"], distributed=distributed).collect()}


def by_rule(values, pops):
    """The level each row must get: its 1-based rank (ties by id) times four,
    over the size of its population, rounded up, names the quartile."""
    out = {}
    for pop in set(pops):
        order = sorted((v, i) for i, (v, p) in enumerate(zip(values, pops)) if p == pop and v is not None)
        for rank_, (_, i) in enumerate(order, 1):
            out[i] = "DCBA"[-(-4 * rank_ // len(order)) - 1]
    return {i: out.get(i) for i in range(len(values))}


@pytest.mark.parametrize("n, distinct, pops, seed", [
    (52, 52, 1, 0), (61, 61, 1, 1), (9, 9, 1, 2), (3, 3, 1, 3), (1, 1, 1, 4), (140, 3, 1, 5), (77, 1, 1, 6),
    (90, 40, 4, 7), (33, 5, 2, 8)])
def test_levels_follow_the_rule(spark, n, distinct, pops, seed):
    rng = np.random.default_rng(seed)
    values = [None if seed > 4 and rng.random() < 0.1 else float(rng.integers(0, distinct)) / 3 for _ in range(n)]
    names = [f"pop{rng.integers(0, pops)}" for _ in range(n)]
    assert levels(spark, values, names) == by_rule(values, names)


def test_ties_spread_over_levels(spark):
    lv = levels(spark, [3.5] * 48)
    assert sorted(lv.values()) == sorted("ABCD" * 12)


def test_distributed_equals_window(spark):
    rng = np.random.default_rng(42)
    data = [(int(i), ["a", "b", None][i % 3], float(rng.integers(0, 20))) for i in range(3000)]
    df = spark.createDataFrame(data, "customer_id long, population string, value double").repartition(7)
    d = rank.distributed_row_number(df, ["population"], ["value", "customer_id"], num_partitions=9)
    w = rank.window_row_number(df, ["population"], ["value", "customer_id"])
    a = {r.customer_id: (r.rn, r.n) for r in d.collect()}
    b = {r.customer_id: (r.rn, r.n) for r in w.collect()}
    assert a == b


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = rng.normal(size=501).round(2)
    df = spark.createDataFrame([(int(i), "g", float(v)) for i, v in enumerate(vals)], "id long, g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    q = {r.p: r.v for r in rank.exact_quantiles(df, ["g"], "v", probs, id_col="id").collect()}
    for p in probs:
        assert q[p] == pytest.approx(np.percentile(vals, p * 100), abs=1e-9)


def test_dense_keys(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "product string")
    out = {r.product: r.product_id for r in rank.dense_keys(df, "product", "product_id").collect()}
    assert out == {"a": 1, "b": 2}
