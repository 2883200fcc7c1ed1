"""Operator 11: hard negatives by spanning-tree bounds over anchors.

A row's score for an anchor is the inner product of the two vectors. Anchors lie
in a spanning tree whose edges are their distances. A root's scores are
computed; for a child, the score of a row lies within the edge's length times
the row's norm of its parent's (Cauchy-Schwarz), and bounds pass on from anchor
to anchor. Only rows whose bounds reach into the window an anchor still looks
at are scored again, which makes their bounds exact.

First search: an anchor's positives, the best rows of its own label; the window
runs from the worst of the best found so far upwards. Second search: for each
positive, the best rows of other labels with a score from ``LEAST`` to ``MOST``
per cent of the positive's; the windows' lower ends rise with what is found.

Anchors are taken in blocks of bounded bytes (``BLOCK_BYTES``), near ones
together; a block's trees go to all tasks, which read the rows where they lie:
no vector is shuffled. A task keeps the best few rows an anchor, and Spark
merges the tasks' few.

Defined results: rows without an id, label or vector, or with a null or
non-finite component (or one whose scaled value is not finite), take no part.
Vectors of unequal length are compared over the components both have; an empty
vector scores 0. Scores beyond a long count as the nearest long. Rows that share
an anchor's id are not "other rows" of it; otherwise repeated rows count one by
one, and each repeated anchor is mined. Higher scores come first, equal ones by
smaller id. An empty table, or one without anchors, gives an empty result; an
anchor without positives, or a positive without negatives, gives no row. Extra
columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from balances.llm.common import dropped, new_path, table, written
from balances.operators.rank import distributed_row_number

POSITIVES, NEGATIVES = 5, 3
#: A negative's score, in per cent of the positive's.
LEAST, MOST = 50, 95
ANCHOR_EVERY, RELABEL_EVERY, LABELS, SCALE = 50, 7, 10, 256
#: Bytes of anchors that go to every task at once.
BLOCK_BYTES = 16 << 20
#: Anchors of one tree, and rows scored at a time.
TREE, SLICE = 256, 4096
#: Components whose signs put near anchors into one tree.
CODE_BITS = 16
#: Norms whose products a double holds exactly.
EXACT_NORM = float(1 << 26)
MAX_LONG = (1 << 63) - 1
RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, "
          "positive_score long, negative_score long")


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, label, vector of the rows that take part."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= F.lit(np.finfo(float).max / SCALE)))
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                       F.col(vector_col).cast("array<double>").alias("vector")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~bad)


def matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    """The vectors of an Arrow column, scaled and floored, zeros at the end."""
    values = np.floor(column.flatten().to_numpy(zero_copy_only=False) * float(SCALE))
    sizes = np.diff(column.offsets.to_numpy())
    if len(sizes) and (sizes == dim).all():
        return values.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def spanning_tree(v: np.ndarray) -> tuple[list[int], list[int], list[float]]:
    """Prim's minimum spanning tree: the anchors in the order they join, and
    for each anchor its parent (-1 for the first) and the edge's length."""
    n = len(v)
    near, parent = np.full(n, np.inf), np.full(n, -1)
    order, length, inside = [], [0.0] * n, np.zeros(n, bool)
    at = 0
    for _ in range(n):
        inside[at] = True
        order.append(at)
        length[at] = float(near[at]) if parent[at] >= 0 else 0.0
        with np.errstate(over="ignore", invalid="ignore"):
            d = np.nan_to_num(np.sqrt(((v - v[at]) ** 2).sum(axis=1)), nan=1e300, posinf=1e300)
        closer = ~inside & (d < near)
        near[closer], parent[closer] = d[closer], at
        at = int(np.where(inside, np.inf, near).argmin())
    return order, parent.tolist(), length


def norms_of(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt((x * x).sum(axis=1))


class Block:
    """Anchors with their trees; fixed bounds on size, so it may be broadcast."""

    def __init__(self, number: np.ndarray, ids: np.ndarray, labels: np.ndarray, v: np.ndarray):
        self.number, self.ids, self.labels = number, ids, labels
        # whole numbers of up to 24 bits are exact in 32-bit floats
        self.v = v.astype(np.float32) if not v.size or np.abs(v).max() < 1 << 24 else v
        self.large = bool(len(v)) and not norms_of(v).max() < EXACT_NORM
        self.trees = []
        for a in range(0, len(ids), TREE):
            self.trees.append((a, *spanning_tree(v[a:a + TREE])))
        #: Per anchor the positives' scores, the best first (second search).
        self.positives: list[list[int]] = [[] for _ in ids]

    def scored(self, x: np.ndarray, norms: np.ndarray, wanted):
        """(anchor, rows, their exact scores) for every anchor; ``wanted(anchor,
        low, high)`` names the rows whose bounds reach into its window."""
        if self.large or not (norms.max(initial=0.0) < EXACT_NORM):
            none = np.full(len(x), -np.inf)
            for a in range(len(self.ids)):
                rows = wanted(a, none, -none)
                yield a, rows, whole_scores(x[rows], self.v[a])
            return
        for first, order, parent, length in self.trees:
            low, high = np.empty((len(order), len(x))), np.empty((len(order), len(x)))
            for k in order:
                v = self.v[first + k].astype(float)
                if parent[k] < 0:
                    low[k] = high[k] = x @ v
                    rows = wanted(first + k, low[k], high[k])
                    yield first + k, rows, low[k][rows].astype(np.int64)
                    continue
                reach = norms * (length[k] * (1 + 1e-9)) + 1e-3
                np.subtract(low[parent[k]], reach, out=low[k])
                np.add(high[parent[k]], reach, out=high[k])
                rows = wanted(first + k, low[k], high[k])
                s = (x @ v)[rows] if 2 * len(rows) > len(x) else x[rows] @ v
                low[k][rows] = high[k][rows] = s
                yield first + k, rows, s.astype(np.int64)


def whole_scores(x: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products in whole numbers of any size, held to the range of a long."""
    whole = [int(b) for b in v]
    got = [sum(int(a) * b for a, b in zip(row, whole)) for row in x]
    return np.array([max(-MAX_LONG - 1, min(MAX_LONG, s)) for s in got], np.int64)


def best(scores: np.ndarray, ids: np.ndarray, more_s: np.ndarray, more_i: np.ndarray, n: int):
    """The first ``n`` of both by descending score, then by id."""
    s, i = np.concatenate((scores, more_s)), np.concatenate((ids, more_i))
    at = np.lexsort((i, ~s))[:n]
    return s[at], i[at]


_NONE = (np.empty(0, np.int64), np.empty(0, np.int64))


class PositiveSearch:
    def __init__(self, block: Block):
        self.block, self.found = block, [_NONE] * len(block.ids)

    def add(self, x, norms, ids, labels):
        block, found = self.block, self.found
        same = {label: np.flatnonzero(labels == label) for label in set(block.labels.tolist())}

        def wanted(a, low, high):
            rows = same[int(block.labels[a])]
            rows = rows[ids[rows] != block.ids[a]]
            return rows if len(found[a][0]) < POSITIVES else rows[high[rows] >= found[a][0][-1]]
        for a, rows, s in block.scored(x, norms, wanted):
            if len(rows):
                if len(found[a][0]) == POSITIVES:
                    rows, s = rows[s >= found[a][0][-1]], s[s >= found[a][0][-1]]
                found[a] = best(*found[a], s, ids[rows], POSITIVES)

    def results(self):
        for a, (s, i) in enumerate(self.found):
            if len(s):
                yield int(self.block.number[a]), 0, s, i


class NegativeSearch:
    def __init__(self, block: Block):
        self.block = block
        #: Per anchor and positive: lowest and highest score, and what is found.
        self.windows = [[[-(-LEAST * p // 100), MOST * p // 100] for p in scores] for scores in block.positives]
        self.found = [[_NONE] * len(w) for w in self.windows]

    def add(self, x, norms, ids, labels):
        block, found, windows = self.block, self.found, self.windows
        other = {label: np.flatnonzero(labels != label) for label in set(block.labels.tolist())}
        none = np.empty(0, np.int64)

        def wanted(a, low, high):
            open_ = [w for w in windows[a] if w[0] <= w[1]]
            if not open_:
                return none
            rows = other[int(block.labels[a])]
            rows = rows[(high[rows] >= min(w[0] for w in open_)) & (low[rows] <= max(w[1] for w in open_))]
            hit = np.zeros(len(rows), bool)
            for least, most in open_:
                hit |= (high[rows] >= least) & (low[rows] <= most)
            return rows[hit]
        for a, rows, s in block.scored(x, norms, wanted):
            if not len(rows):
                continue
            for k, (least, most) in enumerate(windows[a]):
                fits = (s >= least) & (s <= most)
                if fits.any():
                    got = best(*found[a][k], s[fits], ids[rows[fits]], NEGATIVES)
                    found[a][k] = got
                    if len(got[0]) == NEGATIVES:
                        windows[a][k][0] = max(least, int(got[0][-1]))

    def results(self):
        for a, each in enumerate(self.found):
            for k, (s, i) in enumerate(each):
                if len(s):
                    yield int(self.block.number[a]), k, s, i


def search(rows: DataFrame, block: Block, kind: type, dim: int) -> DataFrame:
    """(a, k, score, id): what each task found for anchor ``a`` (and its k-th
    positive) among its rows."""
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        state = kind(shared.value)
        for b in batches:
            ids = b.column("id").to_numpy(zero_copy_only=False)
            labels = b.column("label").to_numpy(zero_copy_only=False)
            x = matrix(b.column("vector"), dim)
            norms = norms_of(x)
            fits = norms < EXACT_NORM
            for rows in (np.flatnonzero(fits), np.flatnonzero(~fits)):
                for at in range(0, len(rows), SLICE):
                    part = rows[at:at + SLICE]
                    state.add(x[part], norms[part], ids[part], labels[part])
        out = [(a, k, int(s), int(i)) for a, k, ss, ii in state.results() for s, i in zip(ss, ii)]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                names=["a", "k", "score", "id"])
    return rows.mapInArrow(run, "a long, k int, score long, id long")


def first_of(found: DataFrame, n: int) -> DataFrame:
    """Merge the tasks' few rows: the first ``n`` for each anchor and positive."""
    w = Window.partitionBy("a", "k").orderBy(F.col("score").desc(), "id")
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def numbered_anchors(rows: DataFrame, anchors: DataFrame, per_block: int) -> DataFrame:
    """a, block, id, label, vector: anchors in an order that puts vectors with
    equal signs side by side."""
    code = F.aggregate(F.transform(F.slice("vector", 1, CODE_BITS), lambda x, i: (x >= 0).cast("long") * F.pow(F.lit(2.0), i).cast("long")),
                       F.lit(0).cast("long"), lambda x, y: x + y)
    rows = anchors.withColumn("all", F.lit(0)).withColumn("code", code).withColumn("tie", F.xxhash64("label", "vector"))
    rows = distributed_row_number(rows, ["all"], ["code", "id", "tie"], rn="a")
    return rows.select((F.col("a") - 1).alias("a"), F.floor((F.col("a") - 1) / per_block).alias("block"), "id", "label", "vector")


def hard_negatives(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """``rows`` and ``anchors`` (id, label, vector) -> ``RESULT``."""
    spark = rows.sparkSession
    size = rows.agg(F.max(F.size("vector")).alias("dim")).first()["dim"]
    dim = max(1, size or 0)
    per_block = max(1, BLOCK_BYTES // (8 * dim))
    numbered = written(numbered_anchors(rows, anchors, per_block), "anchors")
    blocks = sorted(r["block"] for r in numbered.select("block").distinct().collect())  # one row per block
    path = new_path(spark, "negatives")
    for b in blocks:
        held = numbered.where(F.col("block") == b).orderBy("a").toArrow()  # at most ``per_block`` rows
        block = Block(held["a"].to_numpy(), held["id"].to_numpy(), held["label"].to_numpy(),
                      matrix(held["vector"].combine_chunks(), dim))
        positives = written(first_of(search(rows, block, PositiveSearch, dim), POSITIVES).select(
            "a", (F.col("place") - 1).alias("k"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
        at = {int(a): i for i, a in enumerate(block.number)}
        for r in positives.orderBy("a", "k").collect():  # at most POSITIVES a row of the block
            block.positives[at[r["a"]]].append(r["positive_score"])
        found = first_of(search(rows, block, NegativeSearch, dim), NEGATIVES)
        named = F.broadcast(positives.join(F.broadcast(numbered.where(F.col("block") == b).select(
            "a", F.col("id").alias("anchor_id"))), "a"))
        found.join(named, ["a", "k"]).select(
            "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(path)
        dropped(positives)
    dropped(numbered)
    return spark.read.schema(RESULT).parquet(path) if blocks else spark.createDataFrame([], RESULT)


def relabelled(rows: DataFrame) -> DataFrame:
    """Every ``RELABEL_EVERY``-th id takes the next label."""
    return rows.withColumn("label", F.when(F.col("id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = relabelled(usable(table(spark, sf_dir, "embeddings")))
    return hard_negatives(rows, rows.where(F.col("id") % ANCHOR_EVERY == 0))


SQL = f"""
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
         list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * {SCALE})) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label,
         CAST(list_sum(list_transform(list_zip(a.v, r.v, true), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM usable a JOIN usable r ON a.vec_id <> r.vec_id WHERE a.vec_id % {ANCHOR_EVERY} = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}),
negatives AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
   AND {LEAST} * p.positive_score <= 100 * s.score AND 100 * s.score <= {MOST} * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= {NEGATIVES}
"""
