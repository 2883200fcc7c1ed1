import hashlib

import pytest
from pyspark.sql import functions as F

from balances.operators import marts, models, roles


FORBIDDEN = ["customer_id", "name", "gender", "adoption_label", "adoption_label_recent", "n_products_total",
             "has_investment_history", "has_product_history", "no_signal", "trainable", "population", "no_recent_data",
             "score", "level", "model_used", "reference_value", "reference_type", "expected_value_12m",
             "annual_savings_capacity", "amount_base_12m", "amount_app_12m_optimistic",
             "robo_advisor_balance_snapshot", "robo_advisor_relative_trend_6m", "savings_snapshot_date", "first_month"]


@pytest.mark.parametrize("column", FORBIDDEN)
def test_leak_guard(column):
    assert roles.leak_check(["income", "segment"]) == ["income", "segment"]
    with pytest.raises(ValueError):
        roles.leak_check(["income", column])
    assert column not in roles.model_a(["income", column]) and column not in roles.model_b(["income", column])


def test_feature_sets_and_dictionary_agree(spark):
    df = spark.createDataFrame(
        [(1, "n", "F", 1.0, 2.0, "s", None, 0, 1, 1.0, 1, 0)],
        "customer_id long, name string, gender string, income double, robo_advisor_balance_snapshot double, "
        "segment string, savings_snapshot_date date, adoption_label int, trainable int, tenure_months double, "
        "missing_estimator int, has_product_history int")
    a, b = models.feature_set_a(df), models.feature_set_b(df)
    assert a == ["income", "segment", "tenure_months", "missing_estimator"]
    assert b == ["income", "missing_estimator", "segment"]
    named = dict(marts.column_roles(df.columns))
    assert {c for c, r in named.items() if r in ("A", "A+B")} == set(a)
    assert {c for c, r in named.items() if r == "A+B"} == set(b)


def test_model_b_is_complete():
    assert {"missing_estimator", "no_financial_any", "has_housing_data", "incomplete_profile"} <= set(roles.SET_B)


def test_split_is_stratified_and_repeatable(spark):
    df = spark.createDataFrame([(i, int(i % 7 == 0)) for i in range(20_000)], "customer_id long, y int")
    s = models.stratified_split(df, "y")
    for r in s.groupBy("y").agg(F.avg("is_test").alias("share")).collect():
        assert abs(r.share - 0.2) < 0.025
    test = {r.customer_id for r in s.where("is_test = 1").collect()}
    again = {r.customer_id for r in models.stratified_split(df.repartition(9), "y").where("is_test = 1").collect()}
    want = {i for i in range(20_000) if int(hashlib.md5(f"42:{int(i % 7 == 0)}:{i}".encode()).hexdigest()[:8], 16)
            < int(0.2 * 2 ** 32)}
    assert test == again == want


def test_encoding_null_and_unseen_are_zero(spark):
    from pyspark.ml import Pipeline
    train = spark.createDataFrame([(1.0, "a"), (None, "b")], "x double, c string")
    enc, stages = models.encode(train, ["x", "c"])
    m = Pipeline(stages=stages).fit(enc)
    new = spark.createDataFrame([(None, None), (2.0, "zzz")], "x double, c string")
    enc2, _ = models.encode(new, ["x", "c"])
    vecs = [r.features.toArray().tolist() for r in m.transform(enc2).collect()]
    assert vecs[0] == [models.SENTINEL, 1.0, 0.0, 0.0]   # x NULL -> sentinel + flag; c NULL -> zeros
    assert vecs[1] == [2.0, 0.0, 0.0, 0.0]                # unseen level -> zeros


def test_permuted_rows_are_scored_by_the_trees(spark, monkeypatch):
    """Every AUC equals the model's own on rows with the donor's value; the model is
    not run for each variable and repeat, only the trees that split on it."""
    import random
    from balances.operators.stats import auc_exact
    rng = random.Random(3)
    rows = []
    for i in range(400):
        x, c = rng.choice([None, rng.random()]), rng.choice([None, "a", "b", "c"])
        rows.append((i, x, rng.random(), c, 1.0, int((x or 0.7) + (c == "b") * 0.4 + rng.random() > 1.1)))
    df = spark.createDataFrame(rows, "customer_id long, income double, assets double, segment string, equity double, y int")
    cols = ["income", "assets", "segment", "equity"]
    model = models.fit_classifier(df, cols, "y", max_iter=8, max_depth=4)
    pairs = models.permutations(df, 2).persist()
    base = auc_exact(models.score(model, df, cols), "customer_id", "score", "y").first()["auc"]
    want = {}
    donors = df.select(F.col("customer_id").alias("donor_id"), *[F.col(c).alias(f"d_{c}") for c in cols])
    both = pairs.join(df, "customer_id").join(donors, "donor_id").persist()
    for v in cols:
        moved = both.withColumn(v, F.col(f"d_{v}")).select("repeat", *df.columns)
        aucs = [r["auc"] for r in auc_exact(models.score(model, moved, cols), "", "score", "y", ["repeat"]).collect()]
        want[v] = base - sum(aucs) / len(aucs)
    monkeypatch.setattr(models, "score", lambda *a: pytest.fail("the whole model scores the rows"))
    got = {r.variable: r.importance_mean for r in models.permutation_importance(model, df, cols, "y", cols, repeats=2).collect()}
    assert got == pytest.approx(want, abs=1e-9) and got["income"] > 0 and got["segment"] > 0 and got["equity"] == 0


@pytest.mark.parametrize("cuts", [[], [0.5], [-1.0, 2.0, 2.0, 3.5, 9.0]])
def test_auc_of_counts_in_blocks(spark, cuts):
    from balances.operators import stats
    vals = [(g, float(v), t, min(t, (v + g) % 3)) for g in (1, 2) for v in range(6) for t in (1, 2)]
    counts = spark.createDataFrame(vals, "g int, value double, t long, events long")
    flat = spark.createDataFrame([(g, v, int(k < e)) for g, v, t, e in vals for k in range(t)], "g int, value double, y int")
    want = {r.g: r.auc for r in stats.auc_exact(flat, "", "value", "y", ["g"]).collect()}
    got = stats.auc_of_counts(counts, ["g"], cuts)
    assert {r.g: r.auc for r in got.collect()} == pytest.approx(want)
    assert got._jdf.queryExecution().sparkPlan().toString().count("Window") == 2
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning(g") == 2  # the counts once, and one row a block


def test_rows_are_encoded_once(spark, monkeypatch):
    """Training and scoring read the encoded rows; model and scores are those of
    the pipeline that encodes on every pass."""
    import random
    rng = random.Random(4)
    rows = [(i, rng.choice([None, rng.random()]), rng.choice([None, "a", "b"]), rng.randrange(2)) for i in range(600)]
    df = spark.createDataFrame([(*r, int((r[1] or 0.7) + (r[2] == "b") * 0.4 + rng.random() > 1.1)) for r in rows],
                               "customer_id long, income double, segment string, missing_estimator int, y int")
    split = models.stratified_split(df, "y")
    cols = ["income", "segment", "missing_estimator"]
    whole = models.fit_classifier(split.where("is_test = 0"), cols, "y")
    want = {r.customer_id: r.score for r in models.score(whole, df, cols).collect()}
    encoder, vectors = models.encode_once(split.where("is_test = 0"), split, cols, ["customer_id", "y", "is_test"], "vectors-test")
    assert vectors.schema["features"].metadata["ml_attr"]["num_attrs"] == 6
    model = models.fit_vectors(encoder, vectors.where("is_test = 0"), models.classifier("y"))
    got = {r.customer_id: r.score for r in models.score_vectors(model, vectors).collect()}
    assert got == pytest.approx(want, abs=1e-9)
    assert {r.customer_id: r.score for r in models.score(model, df, cols).collect()} == pytest.approx(want, abs=1e-9)
    monkeypatch.setattr(models, "score", lambda *a: pytest.fail("rows are encoded again"))
    assert models.auxiliary_model(df.drop("y"), "missing_estimator")["auc"] is not None
