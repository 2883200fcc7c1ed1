"""Model operators (M1-M17, DQ8, IO12) on pyspark.ml.

* Feature sets A / B come from the column roles (M1, M2) and are checked by
  the leak guard (DQ8) before encoding.
* GBT rejects NaN, so every numeric feature gets a sentinel fill plus a
  missing-indicator column; categoricals use StringIndexer(keep) +
  OneHotEncoder(dropLast): the dropped slot is the invalid bucket, so NULL
  and unseen levels encode as all zeros (M3).
* The 80/20 split is stratified by label and deterministic: a seeded md5
  bucket per label and id (M4), not randomSplit.
* AUCs are exact (mid-rank U statistic, distributed) (M6).
"""
from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from balances.config import SETTINGS
from balances.operators import order_stats, roles
from balances.operators.rank import distributed_row_number
from balances.operators.stats import auc_exact, auc_of_counts
from balances.session import materialise

S = SETTINGS
SENTINEL = -1.0e15

def feature_set_a(df: DataFrame) -> list[str]:
    """M1: the predictors the roles admit, dates left out."""
    types = dict(df.dtypes)
    return [c for c in roles.model_a(df.columns) if types[c] not in ("date", "timestamp", "timestamp_ntz")]


def feature_set_b(df: DataFrame) -> list[str]:
    """M2: financial-capacity white list, in order, if present."""
    return roles.model_b(df.columns)


def encode(df: DataFrame, cols) -> tuple[DataFrame, list]:
    """M3: numeric -> sentinel + indicator; categorical -> index + one-hot."""
    types = dict(df.dtypes)
    num = [c for c in cols if types[c] != "string"]
    cat = [c for c in cols if types[c] == "string"]
    vec_inputs = [x for c in num for x in (f"__{c}", f"__{c}_na")]
    out = df.withColumns({f"__{c}": F.coalesce(F.col(c).cast("double"), F.lit(SENTINEL)) for c in num}
                         | {f"__{c}_na": F.col(c).isNull().cast("double") for c in num})
    stages = []
    for c in cat:
        stages.append(StringIndexer(inputCol=c, outputCol=f"__{c}_idx", handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCol=f"__{c}_idx", outputCol=f"__{c}_oh", dropLast=True))
        vec_inputs.append(f"__{c}_oh")
    roles.leak_check(cols)
    stages.append(VectorAssembler(inputCols=vec_inputs, outputCol="features"))
    return out, stages


def stratified_split(df: DataFrame, label_col: str, id_col: str = "customer_id",
                     test_fraction: float = S.test_fraction, seed: int = S.seed) -> DataFrame:
    """M4: deterministic 80/20 split by a seeded hash bucket per (label, id): no
    shuffle, and any engine with md5 repeats it. Within each label the bucket
    is uniform, so the shares agree up to sampling error."""
    key = F.concat_ws(":", F.lit(seed), F.col(label_col).cast("string"), F.col(id_col).cast("string"))
    bucket = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")
    return df.withColumn("is_test", (bucket < F.lit(int(test_fraction * (1 << 32)))).cast("int"))


def fit_classifier(train: DataFrame, cols, label_col: str, seed: int = S.seed,
                   max_iter: int = 50, max_depth: int = 5) -> PipelineModel:
    """M5: GBT classifier pipeline (encoding + trees)."""
    enc, stages = encode(train, cols)
    return Pipeline(stages=stages + [classifier(label_col, seed, max_iter, max_depth)]).fit(enc)


def encode_once(train: DataFrame, df: DataFrame, cols, keep, name: str) -> tuple[PipelineModel, DataFrame]:
    """M3 for several passes: the encoding as learned from ``train``, and ``df``
    encoded with it and written once, as the columns ``keep`` and the vector.
    Training and scoring read that table; encoding a row costs more than any of
    their passes over it."""
    enc, stages = encode(train, cols)
    encoder = Pipeline(stages=stages).fit(enc)
    return encoder, materialise(encoder.transform(encode(df, cols)[0]).select(*keep, "features"), name)


def classifier(label_col: str, seed: int = S.seed, max_iter: int = 50, max_depth: int = 5) -> GBTClassifier:
    return GBTClassifier(labelCol=label_col, featuresCol="features", maxIter=max_iter, maxDepth=max_depth, seed=seed)


def fit_vectors(encoder: PipelineModel, vectors: DataFrame, trees) -> PipelineModel:
    """Encoding + trees, fitted on encoded rows (``encode_once``)."""
    return PipelineModel(encoder.stages + [trees.fit(vectors)])


def score_vectors(model: PipelineModel, vectors: DataFrame, out: str = "score") -> DataFrame:
    """Scores of encoded rows; their other columns stay, the vector does not."""
    rest = [c for c in vectors.columns if c != "features"]
    return model.stages[-1].transform(vectors).withColumn(out, vector_to_array("probability")[1]).select(*rest, out)


def predict_vectors(model: PipelineModel, vectors: DataFrame, out: str = "pred") -> DataFrame:
    rest = [c for c in vectors.columns if c != "features"]
    return model.stages[-1].transform(vectors).withColumnRenamed("prediction", out).select(*rest, out)


def score(model: PipelineModel, df: DataFrame, cols, out: str = "score") -> DataFrame:
    enc, _ = encode(df, cols)
    pred = model.transform(enc)
    return pred.withColumn(out, vector_to_array("probability")[1]).select(
        *df.columns, out)


def guarded_auc(scored: DataFrame, label_col: str, score_col: str = "score",
                id_col: str = "customer_id", ceiling: float = S.auc_leak_ceiling) -> float:
    """M6 + M7: exact AUC; above the ceiling a leak is suspected -> error."""
    row = auc_exact(scored, id_col, score_col, label_col).first()
    auc = row["auc"]
    if auc is not None and auc > ceiling:
        raise ValueError(f"AUC {auc:.4f} > {ceiling}: label leak suspected")
    return auc


def propensity(features: DataFrame, label_col: str = "adoption_label") -> dict:
    """M5 + M8 + M10: models A (customers with product history) and B (the
    rest) trained on trainable customers; every customer scored (asserted)."""
    split = stratified_split(features, label_col)
    base, hist = F.col("trainable") == 1, F.col("has_product_history") == 1
    train, test = split.where(base & (F.col("is_test") == 0)), split.where(base & (F.col("is_test") == 1))
    cols_a, cols_b = feature_set_a(features), feature_set_b(features)
    keep = ["customer_id", label_col, "trainable", "has_product_history", "is_test"]
    enc_a, rows_a = encode_once(train, split.where(base | hist), cols_a, keep, "vectors-a")
    enc_b, rows_b = encode_once(train, split.where(base | ~hist), cols_b, keep, "vectors-b")
    model_a = fit_vectors(enc_a, rows_a.where(base & (F.col("is_test") == 0)), classifier(label_col))
    model_b = fit_vectors(enc_b, rows_b.where(base & (F.col("is_test") == 0)), classifier(label_col))
    test_a = score_vectors(model_a, rows_a.where(base & (F.col("is_test") == 1)))
    test_b = score_vectors(model_b, rows_b.where(base & (F.col("is_test") == 1)))
    metrics = {
        "auc_a": guarded_auc(test_a, label_col),
        "auc_b": guarded_auc(test_b, label_col),
        "auc_a_with_products": guarded_auc(test_a.where(hist), label_col),
    }
    scored = score_vectors(model_a, rows_a.where(hist)).withColumn("model_used", F.lit("A")) \
        .unionByName(score_vectors(model_b, rows_b.where(~hist)).withColumn("model_used", F.lit("B")))
    return {"models": {"A": model_a, "B": model_b}, "cols": {"A": cols_a, "B": cols_b},
            "scores": scored.select("customer_id", "score", "model_used"), "metrics": metrics,
            "test": test}


def retrain_model_a(features: DataFrame, label_col: str) -> dict:
    """M15 helper: model A alone, retrained on another label (same split rule,
    same feature set A); scores the with-history population only."""
    split = stratified_split(features, label_col)
    base, hist = F.col("trainable") == 1, F.col("has_product_history") == 1
    cols_a = feature_set_a(features)
    encoder, rows = encode_once(split.where(base & (F.col("is_test") == 0)), split.where(base | hist), cols_a,
                                ["customer_id", label_col, "trainable", "has_product_history", "is_test"], "vectors-recent")
    model_a = fit_vectors(encoder, rows.where(base & (F.col("is_test") == 0)), classifier(label_col))
    auc = guarded_auc(score_vectors(model_a, rows.where(base & (F.col("is_test") == 1))), label_col)
    return {"model": model_a, "auc": auc,
            "scores": score_vectors(model_a, rows.where(hist)).select("customer_id", "score")}


def assert_all_scored(features: DataFrame, scores: DataFrame) -> None:
    """M10 DQ: one non-null score per customer."""
    g = features.select("customer_id").join(scores, "customer_id", "left").agg(
        F.count(F.lit(1)).alias("n"), F.count("score").alias("n_scored"))
    r = g.first()
    if r["n"] != r["n_scored"]:
        raise ValueError(f"{r['n'] - r['n_scored']} customers without a score")


def permutations(rows: DataFrame, repeats: int, seed: int = S.seed, id_col: str = "customer_id") -> DataFrame:
    """(repeat, id, donor_id): per repeat a random permutation of the whole set.
    The ids are numbered in two seeded hash orders; a row takes the place of the
    row that has its number in the other order. Only ids are ranked and joined,
    and neither partitions nor batches play a part."""
    order = rows.select(id_col, F.explode(F.sequence(F.lit(0), F.lit(2 * repeats - 1))).alias("_k"))
    order = order.withColumn("_h", F.xxhash64(F.lit(seed), "_k", id_col))
    numbered = distributed_row_number(order, ["_k"], ["_h", id_col], rn="_rn", n="_n").withColumn("repeat", F.floor(F.col("_k") / 2).cast("int"))
    own = numbered.where(F.col("_k") % 2 == 0).select("repeat", "_rn", id_col)
    donor = numbered.where(F.col("_k") % 2 == 1).select("repeat", "_rn", F.col(id_col).alias("donor_id"))
    return own.join(donor, ["repeat", "_rn"]).drop("_rn")


def variable_slots(model: PipelineModel, df: DataFrame, cols) -> dict[str, list[int]]:
    """Per variable its places in the model's feature vector."""
    ready = PipelineModel(model.stages[:-1]).transform(encode(df.limit(0), cols)[0])
    attrs = ready.schema["features"].metadata["ml_attr"]["attrs"]
    name_of = {a["idx"]: a["name"] for kind in attrs.values() for a in kind}
    return {c: [i for i, n in sorted(name_of.items()) if n in (f"__{c}", f"__{c}_na") or n.startswith(f"__{c}_oh")] for c in cols}


def variables_read(model: PipelineModel, df: DataFrame, cols) -> list[str]:
    """The variables that some tree of the model splits on: permuting another
    one changes no score."""
    used = {int(i) for i in model.stages[-1].featureImportances.indices}
    slots = variable_slots(model, df, cols)
    return [c for c in cols if used & set(slots[c])]


def tree_nodes(gbt) -> list[tuple]:
    """The fitted trees as rows: per tree (weight, depth, nodes), a node (place in
    the vector, threshold, left, right, prediction); a row goes left when its value
    is at most the threshold, a leaf is its own child. One-hot places split by
    category, which 0.5 tells apart."""
    out = []
    for tree, weight in zip(gbt._java_obj.trees(), gbt.treeWeights):
        nodes: list = []

        def add(node) -> int:
            at = len(nodes)
            nodes.append(None)
            if node.getClass().getSimpleName() == "LeafNode":
                nodes[at] = (0, 0.0, at, at, node.prediction())
                return at
            split = node.split()
            left, right = add(node.leftChild()), add(node.rightChild())
            if split.getClass().getSimpleName() == "ContinuousSplit":
                threshold = split.threshold()
            else:
                threshold = 0.5
                if [float(c) for c in split.leftCategories()] == [1.0]:
                    left, right = right, left
            nodes[at] = (split.featureIndex(), threshold, left, right, 0.0)
            return at
        add(tree.rootNode())
        out.append((float(weight), tree.depth(), nodes))
    return out


def permuted_scores(trees: list[tuple], slots: dict[str, list[int]]):
    """For ``mapInArrow`` over (repeat, _y, own, donor): rows (variable, repeat,
    value, t, events), the scores of the batch with one variable after the other
    taken from the donor, equal scores counted together. Only the trees that split
    on the variable are walked again; "" stands for the rows as they are (repeat 0)."""
    places = sorted({n[0] for _, _, nodes in trees for n in nodes if n[2] != n[3]})
    at = {f: i for i, f in enumerate(places)}
    mine = {v: [at[f] for f in fs if f in at] for v, fs in slots.items()}
    tables = [(w, depth, [at.get(n[0], 0) if n[2] != n[3] else 0 for n in nodes], *([n[k] for n in nodes] for k in (1, 2, 3, 4)))
              for w, depth, nodes in trees]
    reads = {v: [i for i, t in enumerate(trees) if any(n[2] != n[3] and n[0] in fs for n in t[2])] for v, fs in slots.items()}

    def run(batches):
        import numpy as np
        import pyarrow as pa
        arrays = [(depth, np.array(f), np.array(th), np.ravel(np.column_stack([right, left])), np.array(val) * w)
                  for w, depth, f, th, left, right, val in tables]

        def walked(i, x, rows):
            depth, f, th, child, val = arrays[i]
            start, flat = f * len(rows), x.ravel()
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(depth):
                left = np.take(flat, np.take(start, node) + rows) <= np.take(th, node)
                node = np.take(child, 2 * node + left)
            return np.take(val, node)

        def counted(name, repeat, y, value):
            for r in np.unique(repeat):
                here = repeat == r
                v, inv = np.unique(value[here], return_inverse=True)
                yield pa.RecordBatch.from_pydict({
                    "variable": pa.array([name] * len(v), pa.string()), "repeat": pa.array(np.full(len(v), r, dtype=np.int32)), "value": pa.array(v),
                    "t": pa.array(np.bincount(inv).astype(np.int64)), "events": pa.array(np.bincount(inv, weights=y[here]).astype(np.int64))})

        def score(leaves):
            return 1.0 - 1.0 / (1.0 + np.exp(2.0 * leaves.sum(axis=0)))
        for b in batches:
            if not b.num_rows:
                continue
            repeat = b.column("repeat").to_numpy(zero_copy_only=False)
            y = b.column("_y").to_numpy(zero_copy_only=False)
            own, donor = (np.ascontiguousarray(b.column(c).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).T)
                          for c in ("own", "donor"))
            rows = np.arange(b.num_rows)
            leaves = np.array([walked(i, own, rows) for i in range(len(arrays))])
            first = repeat == 0
            yield from counted("", repeat[first], y[first], score(leaves[:, first]))
            for v, places_v in mine.items():
                kept, kept_leaves = own[places_v], leaves[reads[v]]
                own[places_v] = donor[places_v]
                for i in reads[v]:
                    leaves[i] = walked(i, own, rows)
                yield from counted(v, repeat, y, score(leaves))
                own[places_v], leaves[reads[v]] = kept, kept_leaves
    return places, run


def permutation_importance(model: PipelineModel, test: DataFrame, cols, label_col: str,
                           variables, repeats: int = 5, seed: int = S.seed, pairs: DataFrame | None = None) -> DataFrame:
    """M9: drop in exact AUC when one variable is permuted over the whole test
    set, mean and std (population) over repeats; variables that no tree reads
    have 0.

    Every row is encoded once and meets its donor once a repeat (``pairs``, see
    ``permutations``; models with one test set share them). One variable after the
    other takes the donor's places in the vector, the model's trees that split on
    it are walked again, and what is shuffled, once, are counts per (variable,
    repeat, score) of a batch."""
    spark = test.sparkSession
    cols, variables = list(cols), list(variables)
    read = [v for v in variables_read(model, test, cols) if v in variables]
    rest = spark.createDataFrame([(v, 0.0, 0.0) for v in variables if v not in read],
                                 "variable string, importance_mean double, importance_std double")
    if not read:
        return rest
    slots = variable_slots(model, test, cols)
    places, run = permuted_scores(tree_nodes(model.stages[-1]), {v: slots[v] for v in read})
    ready = PipelineModel(model.stages[:-1]).transform(encode(test, cols)[0])
    x = vector_to_array("features")
    vectors = ready.select("customer_id", F.coalesce(F.col(label_col).cast("int"), F.lit(0)).alias("_y"), x.alias("_x")).select(
        "customer_id", "_y", F.array(*[F.col("_x")[i] for i in places]).alias("own"))
    vectors = materialise(vectors, "test-vectors")
    if pairs is None:
        pairs = materialise(permutations(test, repeats, seed), "permutations")
    donors = vectors.select(F.col("customer_id").alias("donor_id"), F.col("own").alias("donor"))
    both = pairs.join(vectors, "customer_id").join(donors, "donor_id").select("repeat", "_y", "own", "donor")
    n_rows = vectors.count()
    blocks = max(1, math.ceil(n_rows / order_stats.BLOCK_VALUES))
    cuts = [] if blocks == 1 else score(model, test, cols).agg(F.percentile_approx(
        "score", [i / blocks for i in range(1, blocks)], 10 * blocks).alias("c")).first()["c"]  # one row of blocks - 1 values
    counts = both.mapInArrow(run, "variable string, repeat int, value double, t long, events long")
    aucs = materialise(auc_of_counts(counts, ["variable", "repeat"], cuts), "permuted-aucs")  # variables x repeats rows
    base = aucs.where("variable = ''").first()["auc"]  # one scalar
    drop = F.lit(base) - F.col("auc")
    found = aucs.where("variable <> ''").groupBy("variable").agg(
        F.avg(drop).alias("importance_mean"), F.stddev_pop(drop).alias("importance_std"))
    return found.unionByName(rest)


def auxiliary_model(features: DataFrame, target_col: str, drop_cols=()) -> dict:
    """An auxiliary classifier of ``target_col`` from features A (minus
    tautological columns): model, test set, columns and exact AUC."""
    cols = [c for c in feature_set_a(features) if c not in drop_cols and c != target_col]
    split = stratified_split(features.where(F.col(target_col).isNotNull()), target_col)
    train, test = split.where(F.col("is_test") == 0), split.where(F.col("is_test") == 1)
    encoder, rows = encode_once(train, split, cols, ["customer_id", target_col, "is_test"], "vectors-auxiliary")
    m = fit_vectors(encoder, rows.where(F.col("is_test") == 0), classifier(target_col))
    auc = auc_exact(score_vectors(m, rows.where(F.col("is_test") == 1)), "customer_id", "score", target_col).first()["auc"]
    return {"model": m, "test": test, "cols": cols, "target": target_col, "auc": auc}


TOP_VARIABLES = 10


def top_variables(aux: dict, n: int = TOP_VARIABLES) -> DataFrame:
    """The variables an auxiliary model leans on most, by permutation
    importance (a top-n report): rank, variable, importance."""
    imp = permutation_importance(aux["model"], aux["test"], aux["cols"], aux["target"], aux["cols"])
    top = imp.orderBy(F.col("importance_mean").desc(), "variable").limit(n)
    w = Window.orderBy(F.col("importance_mean").desc(), "variable")  # n rows
    return top.select(F.row_number().over(w).alias("rank"), "variable", F.col("importance_mean").alias("importance"))


def regressor(label_col: str, seed: int = S.seed) -> GBTRegressor:
    return GBTRegressor(labelCol=label_col, featuresCol="features", maxIter=50, maxDepth=5, seed=seed)


def fit_regressor(train: DataFrame, cols, label_col: str, seed: int = S.seed) -> PipelineModel:
    """GBT regressor with the same null encoding."""
    enc, stages = encode(train, cols)
    return Pipeline(stages=stages + [regressor(label_col, seed)]).fit(enc)


def predict(model: PipelineModel, df: DataFrame, cols, out: str = "pred") -> DataFrame:
    enc, _ = encode(df, cols)
    return model.transform(enc).withColumnRenamed("prediction", out).select(*df.columns, out)


def save_models(models: dict, root: str) -> None:
    """IO12: persist fitted pipelines (overwrite)."""
    for name, m in models.items():
        m.write().overwrite().save(f"{root.rstrip('/')}/{name}")
