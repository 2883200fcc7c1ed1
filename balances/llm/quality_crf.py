"""Operator 13: document quality by a linear-chain conditional random field
over lines.

Every line of a text is labelled good or bad. A line is described by its length,
its signs, digits, capitals and repeated words, and by the same measures of the
lines before and after it; two neighbours' labels share a transition weight.
The forward-backward recursion gives the probability that a line is good, and a
document's quality is the mean of these over its lines, each weighted with its
length (code points, one at least). A logistic curve fitted on the training
sample maps that mean to the share of good labels.

Training. Only documents are labelled, so lines start with the label of their
document. After a first fit, lines of bad documents that the field takes for
good become good (a bad document keeps its worst line bad), and the field is
fitted again. The fit is exact maximum likelihood with a ridge on a bounded
sample, ``SAMPLE_ROWS`` labelled training rows of each class (whole texts).

Defined results: a null or empty text is one empty line; blank lines are lines;
with no training rows, or only one class, every text gets the share of good
training rows (0.5 with none); labels are averaged where a doc_id is labelled
more than once, null labels are left out; repeated rows give one row each;
extra columns are ignored; an empty table gives an empty result; whole texts
are read, however long, in pieces of ``PIECE`` lines.
"""
from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balances.llm.common import table, text_or_empty
from balances.llm.langid import held_out

#: Bound of the labelled sample, rows of each class.
SAMPLE_ROWS = 3000
THRESHOLD = 0.7
RIDGE, STEPS, RATE = 1e-3, 120, 0.15
PIECE = 10_000
#: Words of a line up to which each length feature holds.
LENGTHS = (0, 2, 4, 7, 12, 20, 40)
_RUN = re.compile(r"([^\w\s])\1\1")
_SIGN = re.compile(r"[^\w\s]")
_DIGIT = re.compile(r"\d")
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_LINK = re.compile(r"https?://|www\.|\S@\S+\.\w")
#: Measures of one line; a line is described by its own and both neighbours'.
MEASURES = len(LENGTHS) + 19
INPUTS = 3 * MEASURES + 5


def measures(line: str) -> list[float]:
    """Length steps, then shares of signs, digits, capitals and repeats."""
    words = line.split()
    n, size = len(words), max(1, len(line))
    signs, digits = len(_SIGN.findall(line)) / size, len(_DIGIT.findall(line)) / size
    per = 1.0 / max(1, n)
    repeats = sum(a == b for a, b in zip(words, words[1:])) * per
    distinct = len(set(words)) * per
    letters = sum(map(len, words)) * per
    capitals = len(_CAPITAL.findall(line)) / size
    end = line.rstrip()[-1:]
    return [
        *[1.0 if n <= k else 0.0 for k in LENGTHS],
        signs, float(signs > 0.08), float(signs > 0.15), float(signs > 0.3),
        digits, float(digits > 0.2),
        min(1.0, line.count("|") * per), min(1.0, len(_RUN.findall(line)) * per), float("|" in line),
        repeats, float(repeats > 0.3), 1.0 - distinct if n else 0.0,
        min(2.0, letters / 10), float(letters > 12), float(end in (".", "!", "?", "。") if end else False),
        float(line[:1].isupper()), float(bool(_LINK.search(line))), capitals, float(capitals > 0.5),
    ]


def inputs(lines: list[str], before: str | None, after: str | None, at: int, total: int) -> np.ndarray:
    """One row per line: own measures, those of its neighbours, place and bias.
    ``before`` and ``after`` are the lines around the piece (None at an end)."""
    m = np.array([measures(x) for x in lines], np.float32).reshape(len(lines), MEASURES)
    none = np.zeros((1, MEASURES), np.float32)
    first = none if before is None else np.array([measures(before)], np.float32)
    last = none if after is None else np.array([measures(after)], np.float32)
    place = np.zeros((len(lines), 5), np.float32)
    place[:, 0] = 1.0
    place[:, 1] = np.arange(at, at + len(lines)) == 0
    place[:, 2] = np.arange(at, at + len(lines)) == total - 1
    place[:, 3] = total == 1
    place[:, 4] = min(1.0, math.log1p(total) / 8)
    return np.hstack([m, np.vstack([first, m[:-1]]), np.vstack([m[1:], last]), place])


def pieces(text: str | None):
    """The lines of a text and, for each piece of them, its inputs."""
    lines = (text or "").split("\n")
    for at in range(0, len(lines), PIECE):
        part = lines[at:at + PIECE]
        end = at + len(part)
        yield part, inputs(part, lines[at - 1] if at else None, lines[end] if end < len(lines) else None,
                           at, len(lines))


def _pass_on(r: float, t: np.ndarray) -> float:
    """Log odds for good that a neighbour's log odds ``r`` send over ``t``
    (rows: the neighbour's label, columns: the receiver's; 1 is good)."""
    r = max(-50.0, min(50.0, r))
    e = math.exp(r)
    return math.log((e * t[1][1] + t[0][1]) / (e * t[1][0] + t[0][0]))


class Field:
    """Weights of the good label, transition weights, and the final curve."""

    def __init__(self, weights: np.ndarray, transitions: np.ndarray, slope: float = 1.0, shift: float = 0.0,
                 constant: float | None = None):
        self.weights, self.transitions = weights, transitions
        self.slope, self.shift, self.constant = slope, shift, constant
        self.factors = np.exp(np.clip(transitions, -20, 20)).tolist()
        self.turned = np.exp(np.clip(transitions.T, -20, 20)).tolist()

    def potentials(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of each line by itself, and the lines' lengths."""
        u, size = [], []
        for part, x in pieces(text):
            u.append(x @ self.weights)
            size.append(np.array([max(1, len(p)) for p in part], float))
        return np.concatenate(u), np.concatenate(size)

    def marginals(self, u: np.ndarray) -> np.ndarray:
        """Probability that each line is good, by forward-backward."""
        u = u.tolist()
        forward, r = [], None
        for x in u:
            r = x if r is None else x + _pass_on(r, self.factors)
            forward.append(r)
        out, b = [0.0] * len(u), 0.0
        for i in range(len(u) - 1, -1, -1):
            out[i] = forward[i] + b
            b = _pass_on(u[i] + b, self.turned)
        return 1.0 / (1.0 + np.exp(-np.clip(out, -30, 30)))

    def quality(self, text: str | None) -> float:
        u, size = self.potentials(text)
        return float((self.marginals(u) * size).sum() / size.sum())

    def score(self, text: str | None) -> float:
        if self.constant is not None:
            return self.constant
        z = self.slope * _logit(self.quality(text)) + self.shift
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


class Batch:
    """Line inputs of the sampled documents, the longest first, laid out by
    position so that one step handles a line of every document."""

    def __init__(self, texts: list[str | None]):
        docs, lengths = [], []
        for t in texts:
            parts = list(pieces(t))
            docs.append(np.vstack([x for _, x in parts]))
            lengths.append(np.array([max(1, len(line)) for part, _ in parts for line in part], float))
        self.order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
        self.sizes = np.array([len(docs[i]) for i in self.order])
        self.active = [int((self.sizes > t).sum()) for t in range(self.sizes[0])]
        self.start = np.concatenate(([0], np.cumsum(self.active)))
        self.x = np.zeros((self.start[-1], INPUTS), np.float32)
        self.doc = np.concatenate([np.arange(a) for a in self.active])
        self.length = np.zeros(len(self.x))
        for k, i in enumerate(self.order):
            at = self.start[np.arange(len(docs[i]))] + k
            self.x[at], self.length[at] = docs[i], lengths[i]

    def steps(self):
        return [(slice(self.start[t], self.start[t + 1]), a) for t, a in enumerate(self.active)]

    def expected(self, u: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of good per line, and the summed expected label pairs."""
        node = np.stack([np.zeros_like(u), u])  # label, line
        f, b, steps = np.zeros_like(node), np.zeros_like(node), self.steps()
        for t, (at, a) in enumerate(steps):
            f[:, at] = node[:, at]
            if t:
                prev = f[:, steps[t - 1][0]][:, :a]
                f[:, at] += np.logaddexp(prev[0] + trans[0][:, None], prev[1] + trans[1][:, None])
        pairs = np.zeros((2, 2))
        for t in range(len(steps) - 1, 0, -1):
            at, a = steps[t]
            send = node[:, at] + b[:, at]
            before = slice(steps[t - 1][0].start, steps[t - 1][0].start + a)
            joint = f[:, None, before] + trans[:, :, None] + send[None]
            joint -= joint.max(axis=(0, 1))
            joint = np.exp(joint)
            pairs += (joint / joint.sum(axis=(0, 1))).sum(axis=2)
            b[:, before] = np.logaddexp(trans[:, 0][:, None] + send[0], trans[:, 1][:, None] + send[1])
        odds = (f + b)[1] - (f + b)[0]
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -30, 30))), pairs

    def observed_pairs(self, y: np.ndarray) -> np.ndarray:
        pairs, steps = np.zeros((2, 2)), self.steps()
        for t in range(1, len(steps)):
            at, a = steps[t]
            prev = y[steps[t - 1][0]][:a]
            np.add.at(pairs, (prev, y[at]), 1.0)
        return pairs


def _fit_field(batch: Batch, y: np.ndarray, weight: np.ndarray) -> Field:
    """Maximum likelihood with a ridge by Adam over the whole sample. ``weight``
    (a document's, for its lines) evens out the classes."""
    scale = np.abs(batch.x).max(axis=0)
    scale[scale == 0] = 1.0
    x = batch.x / scale
    w, trans = np.zeros(INPUTS), np.zeros((2, 2))
    seen, n = batch.observed_pairs(y), len(y)
    m, v = np.zeros(INPUTS + 4), np.zeros(INPUTS + 4)
    for step in range(1, STEPS + 1):
        p, pairs = batch.expected((x @ w.astype(np.float32)).astype(float), trans)
        g = np.concatenate((x.T @ ((y - p) * weight).astype(np.float32) / n - RIDGE * w,
                            (seen - pairs).ravel() / n - RIDGE * trans.ravel()))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, trans = w + move[:-4], trans + move[-4:].reshape(2, 2)
    return Field(w / scale, trans)


def _curve(quality: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve over the logit of the quality."""
    x = np.stack([_logit(quality), np.ones_like(quality)], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + 1e-3 * np.eye(2), x.T @ (y - p) - 1e-3 * w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(1e-3, float(w[0])), float(w[1])


def fit(texts: list[str | None], y: list[int]) -> Field:
    """Field and curve from labelled texts (1 good, 0 bad)."""
    y = np.array(y, int)
    if not len(y) or y.min() == y.max():
        return Field(np.zeros(INPUTS), np.zeros((2, 2)), constant=float(y.mean()) if len(y) else 0.5)
    batch = Batch(texts)
    label = y[batch.order]
    lines, weight = label[batch.doc], np.where(label == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))[batch.doc]
    field = _fit_field(batch, lines, weight)
    odds = batch.x @ field.weights
    worst = np.full(len(label), np.inf)
    np.minimum.at(worst, batch.doc, odds)
    lines = np.where((odds > 0) & (odds > worst[batch.doc]), 1, lines)
    field = _fit_field(batch, lines, weight)
    good, _ = batch.expected(batch.x @ field.weights, field.transitions)
    quality = np.bincount(batch.doc, good * batch.length) / np.bincount(batch.doc, batch.length)
    field.slope, field.shift = _curve(quality, label)
    return field


def labelled_sample(docs: DataFrame, labels: DataFrame) -> tuple[list, list]:
    """A bounded sample of labelled training rows, chosen by a hash of the id,
    and the share of good rows in each (texts, labels)."""
    marks = (labels.where(F.col("quality").isNotNull() & ~held_out()).groupBy("doc_id")
             .agg((F.avg(F.col("quality").cast("double")) >= 0.5).cast("int").alias("quality")))
    counts = {r["quality"]: r["count"] for r in marks.groupBy("quality").count().collect()}
    if not counts:
        return [], []
    u = F.pmod(F.xxhash64(F.lit("quality sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("quality") == 1, SAMPLE_ROWS / max(1, counts.get(1, 0))).otherwise(
        SAMPLE_ROWS / max(1, counts.get(0, 0)))
    texts = docs.where(~held_out()).select("doc_id", text_or_empty().alias("text"))
    # the sample's ids are few by construction: they go to the texts
    rows = texts.join(F.broadcast(marks.where(u < share)), "doc_id").select("text", "quality").distinct()
    rows = sorted(rows.toArrow().to_pylist(), key=lambda r: (r["quality"], r["text"]))
    return [r["text"] for r in rows], [r["quality"] for r in rows]


def score_texts(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, score for every row; the field (fixed size) goes to the tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        f = shared.value
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([f.score(t) for t in b.column("text").to_pylist()], pa.float64())],
                names=["doc_id", "score"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def label_lines(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, pos, good (probability) and length of every line of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        f = shared.value
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                u, size = f.potentials(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id] * len(u), pa.int64()), pa.array(np.arange(len(u)), pa.int32()),
                     pa.array(f.marginals(u)), pa.array(size.astype(np.int64))], names=["doc_id", "pos", "good", "length"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, pos int, good double, length long")


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    out = score_texts(docs, fit(*labelled_sample(docs, labels)))
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
