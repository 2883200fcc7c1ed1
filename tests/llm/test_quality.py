"""Operator 13: the field against enumeration, held-out accuracy, edges."""
import itertools
import random

import numpy as np

from llm_helpers import AWKWARD, frame, prose

from balances.llm import quality_crf as crf

SF = "/root/testdata/sf0.01"


def random_field(seed):
    rng = np.random.default_rng(seed)
    return crf.Field(rng.normal(0, 0.6, crf.INPUTS), rng.normal(0, 1.5, (2, 2)), 1.3, -0.4)


def by_enumeration(u, trans):
    total, good, pairs = 0.0, np.zeros(len(u)), np.zeros((2, 2))
    for y in itertools.product((0, 1), repeat=len(u)):
        w = np.exp(sum(a * b for a, b in zip(u, y)) + sum(trans[a][b] for a, b in zip(y, y[1:])))
        total += w
        good += w * np.array(y)
        for a, b in zip(y, y[1:]):
            pairs[a][b] += w
    return good / total, pairs / total


TEXTS = ["One line.", "a | b | c |\nA sentence of several words, as usual.\n$$$ ### x\n\nEnd", "", "x\ny", "w " * 50 + "\n1 2 3 4"]


def test_marginals_are_exact():
    for seed in range(4):
        field = random_field(seed)
        for text in TEXTS:
            u, size = field.potentials(text)
            want, _ = by_enumeration(u, field.transitions)
            assert np.allclose(field.marginals(u), want) and len(u) == len(text.split("\n"))
            assert np.isclose(field.quality(text), (want * size).sum() / size.sum())


def test_batch_agrees_with_enumeration():
    field, batch = random_field(7), crf.Batch(TEXTS)
    u = batch.x @ field.weights
    got, pairs = batch.expected(u, field.transitions)
    want_pairs = np.zeros((2, 2))
    for k, i in enumerate(batch.order):
        own, _ = field.potentials(TEXTS[i])
        good, both = by_enumeration(own, field.transitions)
        assert np.allclose(u[batch.doc == k], own, atol=1e-5) and np.allclose(got[batch.doc == k], good, atol=1e-5)
        want_pairs += both
    assert np.allclose(pairs, want_pairs, atol=1e-5)
    y = np.arange(len(u)) % 2
    assert batch.observed_pairs(y).sum() == len(u) - len(TEXTS)


def test_gradient_by_differences():
    """Observed minus expected is the slope of the log likelihood."""
    field, batch = random_field(3), crf.Batch(TEXTS[:3])
    u0, trans = batch.x @ field.weights, field.transitions
    y = (np.arange(len(u0)) % 3 > 0).astype(int)

    def loglik(u, t):
        out = 0.0
        for k in range(len(batch.order)):
            own, lab = u[batch.doc == k], y[batch.doc == k]
            score = lambda z: sum(a * b for a, b in zip(own, z)) + sum(t[a][b] for a, b in zip(z, z[1:]))
            out += score(lab) - np.log(sum(np.exp(score(z)) for z in itertools.product((0, 1), repeat=len(own))))
        return out
    p, pairs = batch.expected(u0, trans)
    for i in range(len(u0)):
        step = np.eye(len(u0))[i] * 1e-5
        assert np.isclose((loglik(u0 + step, trans) - loglik(u0 - step, trans)) / 2e-5, (y - p)[i], atol=1e-5)
    for a in (0, 1):
        for b in (0, 1):
            step = np.zeros((2, 2))
            step[a, b] = 1e-5
            slope = (loglik(u0, trans + step) - loglik(u0, trans - step)) / 2e-5
            assert np.isclose(slope, (batch.observed_pairs(y) - pairs)[a, b], atol=1e-5)


def test_pieces_do_not_change_a_text(monkeypatch):
    field, text = random_field(5), "\n".join(prose(random.Random(i), i % 9) for i in range(40))
    whole, size = field.potentials(text)
    monkeypatch.setattr(crf, "PIECE", 7)
    parts, sizes = field.potentials(text)
    assert np.allclose(whole, parts) and (size == sizes).all()


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = crf.op13_quality(spark, SF)
    assert out.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    assert out.count() == docs.count()
    held = out.where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet").where("quality IS NOT NULL"), "doc_id").toPandas()
    assert held.score.between(0, 1).all() and ((held.score >= 0.7) == held.predicted).all()
    good, bad = held[held.quality == 1], held[held.quality == 0]
    assert (good.predicted == 1).mean() > 0.95 and (bad.predicted == 0).mean() > 0.7


def test_lines_are_labelled(spark):
    clean = "The first sentence of a page that reads well.\nAnother sentence follows it here."
    junk = "a | b | c | d | e |\n### $$$ %%% word### other$$$ &&&"
    field = crf.fit([clean, junk] * 30, [1, 0] * 30)
    assert field.score(clean) > 0.9 and field.score(junk) < 0.1 and field.transitions[1][1] > field.transitions[1][0]
    rows = crf.label_lines(frame(spark, [(1, clean), (2, junk), (3, None)]), field).orderBy("doc_id", "pos").collect()
    assert [(r.doc_id, r.pos) for r in rows] == [(1, 0), (1, 1), (2, 0), (2, 1), (3, 0)]
    assert all((r.good > 0.5) == (r.doc_id == 1) for r in rows if r.doc_id < 3) and rows[0].length == 45


def test_awkward_documents_and_labels(spark):
    docs = frame(spark, AWKWARD)
    labels = spark.createDataFrame([(i, i % 2, "x") for i, _ in AWKWARD if i] + [(1, None, "y"), (None, 1, "z")], "doc_id long, quality int, text string")
    for marks in (labels, labels.where("quality = 1"), labels.where("false")):
        field = crf.fit(*crf.labelled_sample(docs.select("doc_id", "text"), marks))
        got = crf.score_texts(docs, field).collect()
        assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got} == {0.5}
    assert crf.score_texts(frame(spark, []), field).collect() == []
