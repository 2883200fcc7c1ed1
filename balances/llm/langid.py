"""Operator 8: language identification by sparse multinomial logistic
regression on TF-IDF character n-grams.

Texts are lower-cased, everything but letters becomes one space, and the
n-grams of 1 to 3 characters are hashed into ``DIMS`` features. A feature's
weight in a text is its share of the text's n-grams times its inverse document
frequency, which is counted over every training document. The weights are
learned with follow-the-regularised-leader (per-coordinate rates, elastic net)
on a bounded sample of training documents and of short pieces of them; a
temperature then calibrates the probabilities on sampled documents held back
from the fit.

Defined results: null text, or text without a letter -> ``und`` with score
1.0; a corpus with no usable training row -> ``und`` with score 0.0 for every
text; with a single learned language that language gets score 1.0. Ties take
the alphabetically first language. Repeated rows give one row each; extra
columns are ignored; whole texts are read, however long.
"""
from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balances.llm.common import small, table

DIMS = 1 << 16
ORDERS = 3
#: Sampled training documents per language (the bound on what is collected).
SAMPLE_PER_LANG = 1200
EPOCHS = 3
#: FTRL: rate, smoothing of the rate, L1 and L2 penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-3
#: Short pieces (words) cut from each sampled document.
PIECE_WORDS = (2, 5, 12)
RESULT = "doc_id long, held_out boolean, lang_pred string, score double"

_folds: list = []


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2):
    """crc32 of the id as text, modulo ``folds``, equals ``fold``."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % folds == fold


def _letter_table() -> np.ndarray:
    if not _folds:
        _folds.append(np.fromiter((chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False
                                   for c in range(0x110000)), bool, 0x110000))
    return _folds[0]


def features(text: str | None) -> np.ndarray:
    """Hashed n-gram indices of a text, one per position and order; empty
    where the text has no letter."""
    if not text:
        return np.empty(0, np.int64)
    c = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    letter = _letter_table()[c]
    if not letter.any():
        return np.empty(0, np.int64)
    c = np.where(letter, c, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one space after a run of letters
    c = np.concatenate(([32], c[keep], [32])).astype(np.uint64)
    out, h = [], np.zeros(len(c), np.uint64)
    for n in range(ORDERS):
        h = (h[: len(c) - n] * np.uint64(0x100000001B3)) ^ c[n:] if n else c + np.uint64(7)
        mixed = h * np.uint64(0x9E3779B97F4A7C15)
        out.append((mixed >> np.uint64(48)).astype(np.int64))
        if len(c) <= n + 1:
            break
    return np.concatenate(out)


def document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """In how many training documents each feature occurs; one partial vector
    of fixed length per task, summed by Spark."""
    def run(batches):
        df, n = np.zeros(DIMS, np.int64), 0
        for b in batches:
            for text in b.column("text").to_pylist():
                idx = features(text)
                if len(idx):
                    df[np.unique(idx) if len(idx) < 4000 else
                       np.flatnonzero(np.bincount(idx, minlength=DIMS))] += 1
                    n += 1
        at = np.flatnonzero(df)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[at, DIMS], pa.int64()), pa.array(np.r_[df[at], n], pa.int64())],
                names=["feature", "n"])

    sums = (train.select("text").mapInArrow(run, "feature long, n long")
            .groupBy("feature").agg(F.sum("n").alias("n")).toArrow())  # at most DIMS + 1 rows
    df = np.zeros(DIMS + 1, np.int64)
    df[sums["feature"].to_numpy()] = sums["n"].to_numpy()
    return df[:DIMS], int(df[DIMS])


def sample_rows(train: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> list:
    """About ``per_lang`` whole training documents of each language, chosen by
    a hash of the id, without a sort or a window over a language."""
    counts = {r["lang"]: r["count"] for r in train.groupBy("lang").count().collect()}
    if not counts:
        return []
    # a share of the language's rows; shares above 1 keep every row
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, per_lang / n)])[F.col("lang")]
    u = F.pmod(F.xxhash64(F.lit("lang sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    rows = train.where(u < share).select("doc_id", "text", "lang").toArrow().to_pylist()
    return sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))


class Model:
    """Weights (features x languages, IDF folded in), bias, temperature."""

    def __init__(self, langs: list[str], weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.langs, self.weights, self.bias, self.temperature = langs, weights, bias, temperature

    def logits(self, idx: np.ndarray) -> np.ndarray:
        return self.weights[idx].mean(axis=0, dtype=np.float64) + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        idx = features(text)
        if not len(idx):
            return "und", 1.0
        if not self.langs:
            return "und", 0.0
        p = _softmax(self.logits(idx) / self.temperature)
        k = int(p.argmax())
        return self.langs[k], float(min(1.0, p[k]))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list, df: np.ndarray, n_docs: int, seed: int = 7) -> Model:
    """FTRL-proximal over the sampled rows, then temperature calibration. The
    features and counts of all examples lie in two buffers, which go back to
    the system as a whole: this runs in the driver."""
    langs = sorted({r["lang"] for r in rows})
    idf = np.log((1 + n_docs) / (1 + df)) + 1.0
    rng = random.Random(seed)
    examples, kept_back = [], []
    feature, count, at_end = bytearray(), bytearray(), 0
    for i, r in enumerate(rows):
        words = (r["text"] or "").split()
        texts = [r["text"]]
        for n in PIECE_WORDS:
            if len(words) > n:
                at = rng.randrange(len(words) - n + 1)
                texts.append(" ".join(words[at:at + n]))
        for t in texts:
            idx = features(t)
            if len(idx):
                f, tf = np.unique(idx, return_counts=True)
                feature += f.astype(np.uint16).tobytes()
                count += tf.astype(np.uint32).tobytes()
                (kept_back if i % 5 == 4 else examples).append(
                    (at_end, at_end + len(f), len(idx), langs.index(r["lang"])))
                at_end += len(f)
    feature, count = np.frombuffer(feature, np.uint16), np.frombuffer(count, np.uint32)

    def example(s, e, size):
        f = feature[s:e].astype(np.int64)
        return f, count[s:e] / size * idf[f]
    k = len(langs)
    z, n = np.zeros((DIMS + 1, k)), np.zeros((DIMS + 1, k))
    for _ in range(EPOCHS):
        rng.shuffle(examples)
        for *place, y in examples:
            f, x = example(*place)
            f, x = np.append(f, DIMS), np.append(x * 10.0, 1.0)  # the last feature is the bias
            zf, nf = z[f], n[f]
            w = _ftrl_weights(zf, nf)
            g = _softmax(x @ w)
            g[y] -= 1.0
            g = x[:, None] * g[None, :]
            sigma = (np.sqrt(nf + g * g) - np.sqrt(nf)) / ALPHA
            z[f] = zf + g - sigma * w
            n[f] = nf + g * g
    w = _ftrl_weights(z, n)
    weights = (w[:DIMS] * idf[:, None] * 10.0).astype(np.float32)
    model = Model(langs, weights, w[DIMS], 1.0)
    if kept_back and k > 1:
        model.temperature = _temperature(
            np.array([(x * 10.0) @ w[f] + w[DIMS] for f, x in (example(*place) for *place, _ in kept_back)]),
            np.array([y for *_, y in kept_back]))
    return model


def _ftrl_weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Closed form of the leader: zero where L1 holds, else shrunk by L2."""
    return np.where(np.abs(z) <= L1, 0.0,
                    -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, by golden section on its log."""
    def loss(log_t):
        p = _softmax(logits / math.exp(log_t))
        return -np.log(p[np.arange(len(y)), y] + 1e-12).mean()
    lo, hi, r = math.log(0.05), math.log(20.0), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return math.exp((lo + hi) / 2)


def train(docs: DataFrame) -> Model:
    """Fit on the training folds of ``docs`` (doc_id, text, lang)."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    sample = sample_rows(rows)
    if not sample:
        return Model([], np.zeros((DIMS, 0), np.float32), np.zeros(0), 1.0)
    df, n = document_frequencies(rows)
    return fit(sample, df, n)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score for every row; the model (fixed size) goes to
    the tasks as a broadcast variable."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            got = [m.predict(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "lang_pred", "score"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text has a language
    predicted with a score of at least ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in small(batches):
            got = [m.predict(t) for t in b.column("text").to_pylist()]
            yield b.filter(pa.array([lang != "und" and score >= least for lang, score in got], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _columns(table(spark, sf_dir, "documents"))
    out = identify(docs, train(docs))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
