"""Operator 11: mined triples against brute force; bounds of the trees."""
import math
import random

import numpy as np
import pytest

from balances.llm import hard_negatives as hn

SCHEMA = ("vec_id long, embedding array<float>, label int, id long, vector string, a long, k int, score double, "
          "code long, block long, dim int")


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(*r, 1, "v", 2, 3, 0.5, 4, 5, 6) for r in rows], schema)


def brute(rows):
    part = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(float(x) * 256) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        part.append((i, [math.floor(256 * float(x)) for x in v], label))
    out = []
    for i, v, label in part:
        if i % 50:
            continue
        scored = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(v, w)))), j, m) for j, w, m in part if j != i)
        for s, j, _ in [x for x in scored if x[2] == label][:5]:
            fits = [x for x in scored if x[2] != label and -50 * s <= -100 * x[0] <= -95 * s][:3]
            out += [(i, j, n + 1, x[1], -s, -x[0]) for n, x in enumerate(fits)]
    return sorted(out)


def mined(df):
    rows = hn.relabelled(hn.usable(df))
    out = hn.hard_negatives(rows, rows.where("id % 50 = 0"))
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def vectors(seed, n, dim=8, step=0.25):
    """Few distinct components, so that scores tie."""
    rng = random.Random(seed)
    return [(i, [rng.randrange(-3, 5) * step for _ in range(dim)], rng.randrange(4)) for i in range(n)]


@pytest.mark.parametrize("seed, n, dim, tree, cut, size", [(1, 600, 8, 256, 4096, 16 << 20), (2, 900, 3, 4, 50, 64 * 5), (3, 500, 16, 3, 7, 16 << 20)])
def test_brute_force(spark, monkeypatch, seed, n, dim, tree, cut, size):
    """Also with small trees, slices and blocks of a few anchors."""
    for name, value in (("TREE", tree), ("SLICE", cut), ("BLOCK_BYTES", size)):
        monkeypatch.setattr(hn, name, value)
    rows = vectors(seed, n, dim)
    assert mined(frame(spark, rows).repartition(5)) == brute(rows)


def test_hot_vector_and_one_label(spark):
    rows = vectors(4, 300) + [(i, [1.0] * 8, 2) for i in range(300, 700)]
    assert mined(frame(spark, rows).repartition(3)) == brute(rows)
    rows = [(i, [float(i % 9)], 3) for i in range(1, 400) if i % 7]
    assert mined(frame(spark, rows)) == brute(rows) == []


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(5, 200) + [
        (250, None, 1), (300, [0.5] * 8, None), (None, [9.0] * 8, 1), (350, [nan] * 8, 1), (351, [inf] + [0.0] * 7, 1), (400, [None] * 8, 1),
        (401, [], 1), (450, [], 2), (500, [1.0, 2.0], 1), (501, [0.5] * 12, 2), (50, [0.25] * 8, 3), (-50, [0.5] * 8, 1), (-7, [0.5] * 8, 0),
        (502, [0.5] * 8, 1), (502, [0.5] * 8, 1), (600, [0.0] * 8, 1)]
    assert mined(frame(spark, rows).repartition(2)) == brute(rows)
    assert mined(frame(spark, [])) == [] and mined(frame(spark, [(1, [1.0], 1), (2, [1.0], 2)])) == []


def test_scores_beyond_exact_doubles(spark):
    schema = SCHEMA.replace("array<float>", "array<double>")
    rng = random.Random(8)
    rows = [(i, [rng.randrange(-2 ** 30, 2 ** 30) * 8.0 + rng.randrange(3) for _ in range(4)], i % 3) for i in range(120)]
    rows += [(200, [1e300, 1.0, 0.0, 0.0], 1), (201, [1e300, 0.0, 1.0, 0.0], 1), (202, [1e300] * 4, 2)]
    assert mined(frame(spark, rows, schema)) == brute(rows)


def test_bounds_hold_and_prune():
    """Every row outside the named ones lies outside the window; near anchors spare most rows."""
    rng = np.random.default_rng(3)
    centre = np.floor(rng.normal(0, 200, 32))
    v = centre + rng.integers(-4, 5, (64, 32))
    x = np.floor(rng.normal(0, 100, (3000, 32)))
    block = hn.Block(np.arange(64), np.arange(64), np.zeros(64, int), v)
    asked = 0

    def wanted(a, low, high):
        true = x @ v[a]
        assert (low <= true).all() and (true <= high).all()
        return np.flatnonzero((high >= 60_000) & (low <= 70_000))
    for a, rows, s in block.scored(x, np.sqrt((x ** 2).sum(axis=1)), wanted):
        asked += len(rows)
        true = x @ v[a]
        assert (s == true[rows]).all() and set(np.flatnonzero((true >= 60_000) & (true <= 70_000))) <= set(rows.tolist())
    assert asked < 0.2 * 64 * 3000


def test_spanning_tree_is_minimal():
    rng = np.random.default_rng(1)
    v = rng.normal(size=(7, 3))
    order, parent, length = hn.spanning_tree(v)
    assert sorted(order) == list(range(7)) and parent[order[0]] == -1
    assert all(order.index(parent[k]) < order.index(k) for k in order[1:])
    edges, group, total = sorted((float(np.linalg.norm(v[i] - v[j])), i, j) for i in range(7) for j in range(i)), list(range(7)), 0.0
    for d, i, j in edges:  # Kruskal
        if group[i] != group[j]:
            total += d
            group = [group[j] if g == group[i] else g for g in group]
    assert abs(sum(length) - total) < 1e-9
