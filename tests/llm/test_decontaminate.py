"""Operator 9 against a scan of every alignment, and the masks by exhaustion."""
import itertools
import math
import random
import re

from llm_helpers import AWKWARD, frame, prose

from balances.llm import decontaminate as D

ITEMS = "item_id long, text string, words int, seed long"


def brute(rows, items):
    out = {}
    split = lambda t: re.findall(r"[\u3040-\u30ff\u4e00-\u9fff\u0e00-\u0e2e]|[^\W_]+?(?=[\W_\u3040-\u30ff\u4e00-\u9fff\u0e00-\u0e2e]|$)", (t or "").lower())
    for i, t in rows:
        w = split(t)
        for k, it in items:
            b = split(it)
            if not b:
                continue
            n, best = min(D.WINDOW, len(b)), 0
            for shift in range(-len(b), len(w)):
                for s in range(max(0, -shift), len(b) - n + 1):
                    if shift + s + n <= len(w):
                        best = max(best, sum(w[shift + s + j] == b[s + j] for j in range(n)))
            if best >= math.ceil(n * D.SHARE):
                out[i, k] = (max(best, out.get((i, k), (0,))[0]), n)
    return out


def test_masks_tolerate_two_substitutions():
    for subs in itertools.combinations(range(D.WINDOW), 2):
        assert any(not {o + p for p in m} & set(subs) for m in D.MASKS for o in range(D.WINDOW - D.SPAN + 1))
    assert all(m[-1] + 1 == D.SPAN for m in D.MASKS)


def rows_and_items():
    rng = random.Random(5)
    items = [(k, prose(rng, n)) for k, n in enumerate((1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 13, 15, 30, 59))] + [(50, None), (51, ""), (51, "")]
    rows = [r for r in AWKWARD if r[0] is not None and len(r[1] or "") < 1000]
    for i in range(80):
        w = prose(rng, rng.randint(0, 40)).split()
        for k, text in rng.sample(items[:14], 2):
            passage = text.split()
            if rng.random() < 0.3 and len(passage) > 14:
                passage = passage[rng.randrange(4):][:14]
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                passage[rng.randrange(len(passage))] = "zz"
            w += passage + prose(rng, rng.randint(0, 10)).split()
        rows.append((100 + i, rng.choice([" ", ", ", "\n"]).join(w).upper() if i % 5 == 0 else " ".join(w)))
    return rows, items


def test_overlaps(spark, monkeypatch):
    rows, items = rows_and_items()
    bench = spark.createDataFrame([(*i, 1, 2) for i in items], ITEMS)
    want = brute(rows, items)
    got = D.overlaps(frame(spark, rows), bench).collect()
    found = {(r.doc_id, r.item_id): (r.matched, r.window) for r in got}
    assert len(got) == len(found)
    # three substitutions may leave no seed whole in a window of 13 words, fewer always do
    assert found.items() <= want.items()
    assert {k: v for k, v in want.items() if v[0] >= v[1] - 2}.items() <= found.items()
    monkeypatch.setattr(D, "BROADCAST_SEEDS", 0)  # the shuffled way gives the same
    again = D.overlaps(frame(spark, rows), bench).collect()
    assert {(r.doc_id, r.item_id): (r.matched, r.window) for r in again} == found


def test_scripts_without_spaces(spark, monkeypatch):
    items = [(1, "这是一个关于城市历史的问题"), (2, "日本語の短い文"), (3, "水"), (4, "ประเทศไทย"), (5, "yes"), (6, "mixed 漢字 words")]
    rows = [(1, "前文。这是一个关于城市历史的问题，后文"), (2, "这是一个关于城市文化的问题"), (3, "彼は日本語の短い文を読む"), (4, "氵 火"), (5, "飲水思源"),
            (6, "ในประเทศไทยวันนี้"), (7, "Yes!"), (8, "yesterday"), (9, "a Mixed漢字words b"), (None, "日本語の短い文")]
    bench = spark.createDataFrame([(*i, 1, 2) for i in items], ITEMS)
    want = brute([r for r in rows if r[0] != 6], items)
    for seeds in (D.BROADCAST_SEEDS, 0):
        monkeypatch.setattr(D, "BROADCAST_SEEDS", seeds)
        got = {(r.doc_id, r.item_id): (r.matched, r.window) for r in D.overlaps(frame(spark, rows), bench).collect()}
        assert {k: v for k, v in got.items() if k[0] != 6} == want and (6, 4) in got
        assert {(1, 1), (2, 1), (3, 2), (5, 3), (7, 5), (9, 6), (None, 2)} <= got.keys() and not {k for k in got if k[0] in (4, 8)}


def test_edges(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o", 1, 2)], ITEMS)
    assert D.overlaps(frame(spark, []), bench).collect() == []
    assert D.overlaps(frame(spark, AWKWARD), bench.limit(0)).collect() == []
    rows = [(None, "x a b c d e f g h i j k l m n o y"), (3, "A, b; c d e f ZZ h i j k l m"), (3, "nothing"), (3, None)]
    got = {r.doc_id: (r.item_id, r.matched) for r in D.overlaps(frame(spark, rows), bench).collect()}
    assert got == {None: (1, 13), 3: (1, 12)}


def allowed(n):
    """Every set of substituted positions that leaves an item of n words a match."""
    return [c for k in range(n - math.ceil(n * D.SHARE) + 1) for c in itertools.combinations(range(n), k)]


def test_masks_find_every_accepted_pattern_of_short_items():
    for n in range(D.FEW, D.WINDOW + 1):
        masks = [D.ALL_MASKS[k] for k in D.kinds_of(n)]
        for subs in allowed(n):
            assert any(not {o + p for p in m} & set(subs) for m in masks for o in range(n - m[-1])), (n, subs)


def test_short_items_with_substitutions(spark):
    rng = random.Random(9)
    items = [(n, prose(rng, n, 10 ** 6)) for n in range(D.FEW, D.WINDOW)]
    rows, want = [], {}
    for n, text in items:
        for subs in allowed(n):
            passage = ["zz" if k in subs else w for k, w in enumerate(text.split())]
            want[len(rows), n] = (n - len(subs), n)
            rows.append((len(rows), " ".join([*prose(rng, 3).split(), *passage, *prose(rng, 2).split()])))
    bench = spark.createDataFrame([(*i, 1, 2) for i in items], ITEMS)
    got = {(r.doc_id, r.item_id): (r.matched, r.window) for r in D.overlaps(frame(spark, rows), bench).collect()}
    assert got == want
    for n, text in items[:3]:  # a benchmark of one length
        one = spark.createDataFrame([(n, text, 1, 2)], ITEMS)
        got = {(r.doc_id, r.item_id): (r.matched, r.window) for r in D.overlaps(frame(spark, rows), one).collect()}
        assert got == {k: v for k, v in want.items() if k[1] == n}
