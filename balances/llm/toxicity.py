"""Operator 7: toxicity by noisy-channel deobfuscation.

Writers hide words by swapping letters for look-alikes (``1d10t``), by setting
them apart (``i d i o t``) and by repeating them (``idiooot``). A suspicious
span becomes a lattice: every observed sign offers the letters it may stand
for, or nothing, each with a channel probability; a sign that stands for nothing
costs what a letter costs on average, so that short paths win nothing by their
length. Viterbi search over the last two letters, all of them, picks the path
that a character trigram model finds likeliest. A span is a word with signs, or
signs alone; letters set apart by separators; letters repeated three times, or
every letter twice; and a marking word cut into pieces. The restored text is then scored by a logistic regression on a few marking words
and word beginnings; a beginning counts once, twice, four or eight times, so one
that clean texts also use now and then marks only where it is frequent.

The character model counts the letter trigrams of every document; words that
mark toxic training rows take a fixed share of its mass, since those are the
words one hides. Spans without noise have a single path and stay as they are.

The classifier is fitted on at most ``TOXIC_ROWS`` and ``CLEAN_ROWS`` labelled
training rows (whole texts), on the words and beginnings that a fair share of
toxic rows has and clean rows lack.

Defined results: null or empty text is scored as a text without words; with no
training rows, or only one class, every text gets the training share of
toxic rows (0.5 with none); labels are averaged where a doc_id is labelled
more than once; repeated rows give one row each; extra columns are ignored.
"""
from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balances.llm.common import table, text_or_empty
from balances.llm.langid import held_out

#: Bounds of the labelled sample.
TOXIC_ROWS, CLEAN_ROWS = 2000, 4000
#: A word counts if this share of the toxic sample has it (three rows at least).
MIN_SUPPORT, MIN_ROWS, MIN_LIFT = 0.03, 3, 5.0
#: Letters of a word's beginning, and the counts that make it a feature.
BEGINNINGS, TIMES = (4, 5, 6, 7), (1, 2, 4, 8)
THRESHOLD = 0.7
RIDGE = 0.5
CLASSES = 64
#: Share of the character model's mass that the toxic words hold.
HIDDEN_SHARE = 0.2
#: Masks in a row that may hide a word; a longer row is a separator.
MASKED = 16
SPAN_MEMO = 100_000

#: What a sign may stand for (fixed values).
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¢": "c",
    "¡": "i", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s",
    "м": "m", "т": "t", "к": "k", "в": "b", "н": "h",
}
MASKS = "*#%?"
SEPARATORS = " .-_·,'~^"
INVISIBLE = re.compile("[​-‍⁠﻿­]")
_LETTER = r"[^\W\d_]"
_SIGN = r"0-9@$!|+(<€£¢¡аеорсхуіѕмтквн*#%?"
_NOISE = re.compile(f"[{_SIGN}]")
#: A token with a letter and a sign that is not just closing punctuation.
_TOKEN = re.compile(rf"(?=\S*{_LETTER})\S*[{_SIGN}]\S*")
#: A token of signs that look like letters, among them one that is no digit.
_SIGNS_ONLY = re.compile(r"(?<!\S)[^\w\s@$!€£¢¡]*(?=[0-9]*[@$!€£¢¡])[0-9@$!|+(<€£¢¡]{2,12}[^\w\s@$!€£¢¡]*(?!\S)")
#: Single signs or letters set apart by separators.
_SPACED = re.compile(rf"(?<![\w@$])(?:[\w@$!|+][ .\-_·,'~^*]{{1,2}}){{2,}}[\w@$!|+](?!\w)")
_WHOLE = re.compile(r"\S+")
_STRETCHED = re.compile(rf"{_LETTER}*({_LETTER})\1\1{_LETTER}*|(?<!\w)(?:({_LETTER})\2){{3,}}(?!\w)")
_EDGE = re.compile(r"^[\"'(\[<{.,;:¿¡#*%&-]+(?=[\w@$])|[.,;:!?'\")\]>}#*%&-]+$|([$@&*#%!?])\1\1+$")
_PUNCTUATION = {i: " " for i in range(0x250) if not chr(i).isalpha()} | {
    i: " " for i in range(0x2000, 0x2070)} | {i: " " for i in range(0x3000, 0x3020)}
#: Bits of a sign: a letter, a sign or separator of ``_SPACED``, what may not
#: stand before such a span, a mark of noise, a sign that is white space, and one
#: that parts words in ``spaced``.
LETTER, SPACED, SEPARATOR, BEFORE, NOISE, SPACE, PARTS = (np.uint8(1 << k) for k in range(7))
_state: dict = {}


def _kinds() -> np.ndarray:
    """Code point -> the bits above, as the patterns read them."""
    if "kinds" not in _state:
        signs = "".join(map(chr, range(0x110000)))
        t = np.zeros(len(signs), np.uint8)
        for bits, pattern in ((LETTER, _LETTER), (SPACED, r"[\w@$!|+]"), (SEPARATOR, r"[ .\-_·,'~^*]"), (BEFORE, r"[\w@$]"),
                              (NOISE, f"[{_SIGN}]"), (SPACE, r"\s")):
            for m in re.finditer(f"{pattern}+", signs):
                t[m.start():m.end()] |= bits
        t[[*_PUNCTUATION]] |= PARTS
        _state["kinds"] = t
    return _state["kinds"]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _has(kinds: np.ndarray, bits: np.uint8) -> np.ndarray:
    return (kinds & bits) != 0


def _replaced(text: str, at, pattern, by) -> str:
    """``pattern.sub(by, text)``; ``at``: where a match may begin, ascending."""
    parts, end = [], 0
    for i in at:
        if i >= end and (m := pattern.match(text, i)):
            parts += text[end:i], by(m)
            end = m.end()
    return "".join([*parts, text[end:]]) if parts else text


def _spaced_starts(text: str) -> list[int]:
    """Where ``_SPACED`` may match: sign, separators, sign, separator."""
    k = np.concatenate((_kinds()[_codes(text)], np.zeros(5, np.uint8)))
    sign, sep = _has(k, SPACED), _has(k, SEPARATOR)
    may = sign[:-5] & sep[1:-4]
    may[1:] &= ~_has(k[:-6], BEFORE)
    return np.flatnonzero(may & (sign[2:-3] & sep[3:-2] | sep[2:-3] & sign[3:-2] & sep[4:-1])).tolist()


def _stretched_starts(text: str) -> list[int]:
    """Where ``_STRETCHED`` may match: the letters before a letter that is there
    three times, or before three pairs."""
    c = _codes(text)
    same = c[1:] == c[:-1]
    hit = np.zeros(len(c), bool)
    hit[:-2] = same[1:] & same[:-1]
    hit[:-5] |= same[:-4] & same[2:-2] & same[4:]
    hits = np.flatnonzero(hit)
    letters = _kinds()
    starts: list[int] = []
    end = 0
    for i in hits[_has(letters[c[hits]], LETTER)].tolist():
        if i < end:
            continue
        start = end = i
        while start and letters[c[start - 1]] & LETTER:
            start -= 1
        while end < len(c) and letters[c[end]] & LETTER:
            end += 1
        starts.append(start)
    return starts


def _noisy_tokens(text: str) -> list[int]:
    """Where tokens with a mark of noise begin."""
    k = _kinds()[_codes(text)]
    noise = np.flatnonzero(k & NOISE)
    if not len(noise):
        return []
    blank = _has(k, SPACE)
    starts = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    at = np.searchsorted(starts, noise, "right") - 1
    return starts[at[np.concatenate(([True], at[1:] != at[:-1]))]].tolist()


def _class_table() -> np.ndarray:
    """Code point -> letter class: 0 none, a-z, Latin-1 letters, others."""
    if "classes" not in _state:
        t = np.zeros(0x110000, np.int64)
        for c in range(0x250):
            if chr(c).isalpha():
                t[c] = 63
        t[97:123] = np.arange(1, 27)
        for i, c in enumerate(range(0xDF, 0x100)):
            t[c] = 27 + i
        t[0xF7] = 0
        t[0x250:0xD800] = 63
        t[0x2000:0x2C00] = 0
        t[0x3000:0x3040] = 0
        _state["classes"] = t
    return _state["classes"]


def classes(text: str) -> np.ndarray:
    """Letter classes of a lower-cased text, between two boundaries."""
    c = _class_table()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    return np.concatenate(([0, 0], c, [0]))


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Letter trigrams of every document; a fixed-length partial per task."""
    def run(batches):
        n, held, size = np.zeros(CLASSES ** 3, np.int64), [], 0
        for b in batches:
            for text in b.column("text").to_pylist():
                held.append(classes(text.lower()))
                size += len(held[-1])
                if size > 500_000:
                    n += _bins(held)
                    held, size = [], 0
        if held:
            n += _bins(held)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())],
                                         names=["trigram", "n"])

    sums = (docs.select(text_or_empty().alias("text")).mapInArrow(run, "trigram long, n long")
            .groupBy("trigram").agg(F.sum("n").alias("n")).toPandas())  # at most CLASSES ** 3 rows
    out = np.zeros(CLASSES ** 3, np.int64)
    out[sums["trigram"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return out


def _bins(texts: list) -> np.ndarray:
    """Trigram counts of class sequences; two boundaries part one from the next."""
    c = np.concatenate(texts)
    return np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES ** 3)


def _conditional(counts: np.ndarray) -> np.ndarray:
    """P(c | a, b): trigram, bigram and unigram estimates interpolated."""
    n3 = counts.reshape(CLASSES, CLASSES, CLASSES).astype(float)
    n2, n1 = n3.sum(axis=0), n3.sum(axis=(0, 1))
    p1 = (n1 + 0.1) / (n1 + 0.1).sum()
    p2 = (n2 + 5 * p1) / (n2.sum(axis=1, keepdims=True) + 5)
    return (n3 + 5 * p2[None]) / (n3.sum(axis=2, keepdims=True) + 5)


class Restorer:
    """Viterbi decoding of character lattices under the trigram model."""

    def __init__(self, corpus: np.ndarray, hidden_words: dict[str, float], whole: list[str] | None = None):
        """``whole``: words that are sought cut into pieces (of four letters or
        more; the hidden words if none are named)."""
        hidden = np.zeros(CLASSES ** 3)
        for word, weight in hidden_words.items():
            c = classes(word)
            np.add.at(hidden, (c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], weight)
        p = _conditional(corpus)
        if hidden.any():
            n = hidden * (1e4 / hidden.sum())
            p = (1 - HIDDEN_SHARE) * p + HIDDEN_SHARE * _conditional(n)
        self.logp = np.log(p).astype(np.float32)
        seen = np.exp(np.log(corpus + 0.01) - np.log((corpus + 0.01).sum()))
        #: Mean log probability of a letter.
        self.per_sign = float((seen * self.logp.ravel()).sum())
        self.whole = sorted(w for w in (hidden_words if whole is None else whole) if len(w) >= 4)
        self.table, self.memo, self.tokens, self.pieces = None, {}, {}, None

    def __getstate__(self):
        return self.__dict__ | {"table": None, "memo": {}, "tokens": {}, "pieces": None}

    def decode(self, span: str) -> str:
        """The likeliest text behind a lower-cased span."""
        if self.table is None:
            self.table = self.logp.ravel().tolist()
        cls, lp = _class_table(), self.table
        scores, back = {0: 0.0}, []  # state: the last two classes
        for choices in lattice(span, self.per_sign):
            if len(scores) * len(choices) > 4000:
                scores, came = self._wide_step(scores, choices)
                back.append(came)
                continue
            new: dict = {}
            came = {}
            steps = [(out, cost, [int(cls[ord(ch)]) for ch in out]) for out, cost in choices]
            for state, score in scores.items():
                for out, cost, letters in steps:
                    x, y, s = state >> 6, state & 63, score + cost
                    for z in letters:
                        if z or y:
                            s += lp[(x * CLASSES + y) * CLASSES + z]
                            x, y = y, z
                    to = x << 6 | y
                    if to not in new or s > new[to]:
                        new[to] = s
                        came[to] = (state, out)
            scores = new
            back.append(came)
        state = max(scores, key=lambda k: scores[k] + lp[k * CLASSES])
        parts = []
        for came in reversed(back):
            state, out = came[state]
            parts.append(out)
        return "".join(reversed(parts))

    def _wide_step(self, scores: dict, choices: list) -> tuple[dict, dict]:
        """One step from many states, by array operations."""
        cls, flat = _class_table(), self.logp.ravel()
        states, held = np.fromiter(scores, np.int64), np.fromiter(scores.values(), float)
        to, value, by = [], [], []
        for k, (out, cost) in enumerate(choices):
            x, y, s = states >> 6, states & 63, held + cost
            for z in (int(cls[ord(ch)]) for ch in out):
                goes = (y > 0) | (z > 0)
                s = np.where(goes, s + flat[(x * CLASSES + y) * CLASSES + z], s)
                x, y = np.where(goes, y, x), np.where(goes, z, y)
            to.append(x << 6 | y)
            value.append(s)
            by.append(np.full(len(states), k))
        to, value, by = np.concatenate(to), np.concatenate(value), np.concatenate(by)
        order = np.lexsort((np.arange(len(to)), -value, to))
        best = order[np.r_[True, to[order][1:] != to[order][:-1]]]
        came = {int(to[i]): (int(states[i % len(states)]), choices[by[i]][0]) for i in best}
        return {int(to[i]): float(value[i]) for i in best}, came

    def _restored(self, span: str) -> str:
        hit = self.memo.get(span)
        if hit is None:
            hit = self.decode(span)
            if len(span) <= 64:
                if len(self.memo) >= SPAN_MEMO:
                    self.memo.clear()
                self.memo[span] = hit
        return hit

    def _token(self, token: str) -> str:
        """A token with its signs read as letters, if they are no punctuation."""
        hit = self.tokens.get(token)
        if hit is None:
            core = token
            while (cut := _EDGE.sub("", core)) != core:
                core = cut
            hit = f" {self._restored(core)} " if _NOISE.search(core) else token
            if len(token) <= 64:
                if len(self.tokens) >= SPAN_MEMO:
                    self.tokens.clear()
                self.tokens[token] = hit
        return hit

    def _noisy(self, m) -> str:
        token = m[0]
        return self._token(token) if _TOKEN.match(token) or _SIGNS_ONLY.match(token) else token

    def restore(self, text: str) -> str:
        """The lower-cased text with every suspicious span decoded."""
        text = text.lower()
        if not text.isascii():
            text = INVISIBLE.sub("", text)
        text = _replaced(text, _spaced_starts(text), _SPACED, lambda m: f" {self._restored(m[0])} ")
        text = _replaced(text, _stretched_starts(text), _STRETCHED, lambda m: self._restored(m[0]))
        text = self._joined(text)
        return _replaced(text, _noisy_tokens(text), _WHOLE, self._noisy)

    def _joined(self, text: str) -> str:
        """Marking words that separators cut into pieces."""
        if not self.whole:
            return text
        close = text
        for sep in SEPARATORS:
            close = close.replace(sep, "")
        for word in self.whole:
            if (n := close.count(word)) and n > text.count(word):
                if self.pieces is None:
                    self.pieces = {}
                if word not in self.pieces:
                    between = "[" + re.escape(SEPARATORS) + "]{0,2}"
                    self.pieces[word] = re.compile(r"(?<!\w)(?!" + word + ")" + between.join(word) + r"(?!\w)")
                text = self.pieces[word].sub(lambda m: f" {self._restored(m[0])} ", text)
        return text


def lattice(span: str, per_sign: float = 0.0):
    """Per observed sign (or run of one letter) what it may stand for, with
    log probabilities. ``per_sign``, the mean log probability of a letter, is
    charged where a sign stands for no letter of its own."""
    i = 0
    while i < len(span):
        ch, j = span[i], i + 1
        while j < len(span) and span[j] == ch:
            j += 1
        n, i = j - i, j
        if ch in SEPARATORS:
            yield [("", math.log(0.7 / n)), (" ", math.log(0.3))]
        elif ch in MASKS and n > MASKED:
            yield [("", math.log(0.3)), (" ", math.log(0.7))]
        elif ch in MASKS:
            for _ in range(n):
                yield [("", math.log(0.1) + per_sign), *((c, math.log(0.03)) for c in "abcdefghijklmnopqrstuvwxyz")]
        elif ch in LOOKS_LIKE:
            letters = LOOKS_LIKE[ch]
            share = 0.9 / len(letters)
            one = 1.0 if n == 1 else 0.2 if n == 2 else 0.6
            less = per_sign if n >= 2 else 0.0
            choices = [(c, math.log(share * one) + less) for c in letters] + [(" ", math.log(0.02))]
            if n >= 2:
                choices += [(c * 2, math.log(share * (1 - one))) for c in letters]
            if not ch.isalnum():
                choices.append(("", math.log(0.005) + (1 + (n >= 2)) * per_sign))
            yield choices
        elif n == 1:
            yield [(ch, 0.0)]
        elif n == 2:
            yield [(ch * 2, math.log(0.8)), (ch, math.log(0.2) + per_sign)]
        else:
            yield [(ch, math.log(0.6) + per_sign), (ch * 2, math.log(0.4))]


def spaced(restored: str) -> str:
    """The words of a text, one space before and after each."""
    c = _codes(restored)
    parted = np.where(_has(_kinds()[c], PARTS), np.uint32(32), c).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return " ".join(["", *parted.split(), ""])


def features(text: str) -> set[str]:
    """Words (`` word ``) and beginnings with their count (`` begin*4``)."""
    tokens = text.split()
    counts = Counter(t[:k] for t in tokens for k in BEGINNINGS if len(t) >= k)
    out = {f" {t} " for t in tokens}
    for begin, n in counts.items():
        out.update(f" {begin}*{k}" for k in TIMES if n >= k)
    return out


def has(text: str, feature: str) -> bool:
    begin, star, n = feature.partition("*")
    return text.count(begin) >= int(n) if star else begin in text


def labelled_sample(docs: DataFrame, labels: DataFrame) -> list:
    """A bounded sample of labelled training rows, chosen by a hash of the id."""
    marks = (labels.where(F.col("toxic").isNotNull() & ~held_out(folds=3, fold=1))
             .groupBy("doc_id").agg((F.avg(F.col("toxic").cast("double")) >= 0.5).cast("int").alias("toxic")))
    counts = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    if not counts:
        return []
    u = F.pmod(F.xxhash64(F.lit("toxic sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, TOXIC_ROWS / max(1, counts.get(1, 0))).otherwise(
        CLEAN_ROWS / max(1, counts.get(0, 0)))
    texts = docs.where(~held_out(folds=3, fold=1)).select("doc_id", text_or_empty().alias("text"))
    # the sample's ids are few by construction: they go to the texts, not the texts to them
    rows = texts.join(F.broadcast(marks.where(u < share)), "doc_id").select("text", "toxic").distinct()
    return rows.toArrow().to_pylist()


class Scorer:
    def __init__(self, restorer: Restorer, weights: dict[str, float], bias: float):
        self.restorer, self.weights, self.bias = restorer, weights, bias

    def score(self, text: str | None) -> float:
        z = self.bias
        if text:
            text = spaced(self.restorer.restore(text))
            z += sum(w for f, w in self.weights.items() if has(text, f))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _marks(texts: list[str], y: np.ndarray) -> tuple[list[str], list[set]]:
    """Features that a fair share of toxic rows has and clean rows lack, the
    best first, and those each text has; of features that begin alike, one is
    left out when another covers most of its toxic rows. Only counts, and of
    each text only the candidates, are held at a time."""
    n1, n0 = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    pos, neg, least = Counter(), Counter(), max(MIN_ROWS, MIN_SUPPORT * n1)
    for text, t in zip(texts, y):
        if t:
            pos.update(features(text))
    pos = Counter({f: c for f, c in pos.items() if c >= least})
    bags = [features(text) & pos.keys() for text in texts]
    for bag, t in zip(bags, y):
        if not t:
            neg.update(bag)
    lift = {f: (c / n1) / ((neg[f] + 0.5) / n0) for f, c in pos.items()}
    gain = {f: c * math.log(lift[f]) - neg[f] for f, c in pos.items() if lift[f] >= MIN_LIFT}
    ranked = sorted(gain, key=lambda f: (-gain[f], "*" in f, -len(f), f))
    rows = {f: set() for f in ranked}
    for i, (bag, t) in enumerate(zip(bags, y)):
        if t:
            for f in bag & rows.keys():
                rows[f].add(i)
    kept: list[str] = []
    for f in ranked:
        alike = [g for g in kept if g[1:5] == f[1:5]]
        covered = set().union(*(rows[g] for g in alike)) if alike else set()
        if len(rows[f] & covered) < 0.8 * len(rows[f]):
            kept.append(f)
    chosen = set(kept)
    return kept, [bag & chosen for bag in bags]


def _logistic(bags: list[set], y: np.ndarray, names: list[str]):
    """Logistic regression on presence of ``names`` by Newton steps, with a
    ridge towards each word's own log odds (smoothed by two clean rows), so a
    word that toxic rows mostly have in company keeps its weight alone. Words
    whose weight comes out negative are left out in a second fit."""
    n1, n0 = y.sum(), (1 - y).sum()
    for _ in range(2):
        col = {w: i for i, w in enumerate(names)}
        x = np.zeros((len(bags), len(names) + 1))
        x[:, -1] = 1.0
        for i, bag in enumerate(bags):
            x[i, [col[w] for w in bag if w in col]] = 1.0
        ridge = np.full(x.shape[1], RIDGE)
        ridge[-1] = 1e-6
        prior = np.log((x.T @ y + 0.5) / n1) - np.log((x.T @ (1 - y) + 2.0) / n0)
        prior[-1] = 0.0
        w = prior.copy()
        w[-1] = math.log(n1 / n0)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + np.diag(ridge), x.T @ (y - p) - ridge * (w - prior))
            w += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break
        names = [n for n, c in zip(names, w) if c > 0]
        if len(names) == len(col):
            break
    kept = [c for c in w[:-1] if c > 0]
    return dict(zip(names, map(float, kept))), float(w[-1])


def train(docs: DataFrame, labels: DataFrame) -> Scorer:
    corpus = trigram_counts(docs)
    sample = labelled_sample(docs, labels)
    y = np.array([r["toxic"] for r in sample], float)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        return Scorer(Restorer(corpus, {}), {}, math.log((share + 1e-6) / (1 - share + 1e-6)))
    marks, _ = _marks([spaced(r["text"].lower()) for r in sample], y)
    restorer = Restorer(corpus, {f.partition("*")[0].strip(): 1.0 for f in marks}, [f.strip() for f in marks if f.endswith(" ")])
    marks, bags = _marks([spaced(restorer.restore(r["text"])) for r in sample], y)
    weights, bias = _logistic(bags, y, marks)
    return Scorer(restorer, weights, bias)


def score_texts(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id, score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches):
        s = shared.value
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"),
                 pa.array([s.score(t) for t in b.column("text").to_pylist()], pa.float64())],
                names=["doc_id", "score"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    out = score_texts(docs, train(docs, labels))
    return out.select("doc_id", held_out(folds=3, fold=1).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
