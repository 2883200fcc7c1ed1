"""Operator 1: main text of web pages by a recurrent block labeller.

A page becomes a sequence of leaf blocks. A bidirectional LSTM, in numpy, reads
each block's hashed tag path, hashed words and plain measures; the forward and
backward states carry what stands before and after, so every block is
classified with the whole document in view. Blocks labelled as article, in page
order, are the main text.

Training. There are no labelled pages, so a bounded sample of pages
(``SAMPLE_PAGES``, chosen by a hash of the id) is labelled by the containers a
page declares, and shown again with its markup varied: containers renamed or
their hints taken away, and blocks of known kind (menus, notices, forms,
adverts, sidebars, comments) set around and inside the article. The network so
learns from context and words what the markup does not say. The varied articles
also hold lists, tables, preformatted text, short paragraphs and by-lines, and
some pages have no container, or no markup at all.

A page of more than ``LONG`` blocks is read in pieces that carry the states on,
so that memory holds two bytes a state and block instead of the input vectors.

Defined results: null or empty html, or a page without article blocks, gives an
empty text of 0 characters; character references are decoded; white space in a
block becomes one space; blocks are joined by two line breaks; nothing is cut
short. Repeated rows give one row each; extra columns are ignored; an empty
table gives an empty result.
"""
from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balances.llm.common import table
from balances.llm.html_blocks import INPUT, Block, blocks, declared, vectors

SAMPLE_PAGES = 240
VARIANTS = 4
HIDDEN = 24
EPOCHS = 6
LONG, PIECE = 20_000, 4096
RATE = 0.01
RESULT = "page_id long, url string, text string, n_chars long"

def teach(page_blocks: list[Block]) -> np.ndarray:
    """Training labels; blocks no container declares count as article if they
    are prose and the page declares no article."""
    y = np.array([declared(b.path) for b in page_blocks])
    prose = np.array([len(b.text.split()) >= 12 and b.linked < 0.3 * max(1, b.chars) for b in page_blocks], bool)
    unsaid = y < 0
    y[unsaid] = prose[unsaid] if not (y == 1).any() else 0
    return y


_LABELS = {"menu": "home news sport contact about archive topics".split(),
           "notice": "we use cookies to improve this site accept decline settings privacy policy".split(),
           "form": "subscribe to our newsletter enter your email address name password sign in search".split(),
           "advert": "advertisement sponsored offer sale buy now best price learn more".split(),
           "side": "most read related articles popular trending latest recommended for you".split(),
           "comment": "reply posted by says thanks great comment ago guest user agree".split(),
           "foot": "copyright all rights reserved terms imprint contact privacy".split()}
_PLACES = {
    "menu": [("nav", ()), ("div", ("menu",)), ("ul", ("nav",)), ("header", ()), ("div", ("top",))],
    "notice": [("div", ("cookie", "notice")), ("div", ("consent",)), ("section", ("alert",)), ("div", ())],
    "form": [("form", ()), ("div", ("newsletter",)), ("div", ("login",)), ("div", ("search",))],
    "advert": [("div", ("ad",)), ("aside", ("promo",)), ("div", ("sponsored",)), ("section", ("banner",))],
    "side": [("aside", ()), ("div", ("sidebar",)), ("section", ("related",)), ("div", ("widget",))],
    "comment": [("div", ("comments",)), ("section", ("comment",)), ("ol", ("replies",)), ("div", ("discussion",))],
    "foot": [("footer", ()), ("div", ("footer",)), ("div", ("legal",)), ("div", ("bottom",))]}
_HOLDERS = [("article", ()), ("main", ()), ("div", ("content",)), ("div", ("post", "body")), ("div", ("entry",)),
            ("section", ("story",)), ("div", ()), ("section", ())]


def variant(page_blocks: list[Block], y: np.ndarray, words: list[str], rng: random.Random):
    """The same page under other markup, with further blocks of known kind."""
    root = (("html", ()), ("body", ()))
    holder = rng.choice(_HOLDERS)
    wrap = root + ((("div", (rng.choice(("page", "wrap", "site", "container")),)),) if rng.random() < 0.5 else ())

    def say(n):
        return " ".join(rng.choice(words) for _ in range(n))

    def extra(kind, base):
        place = rng.choice(_PLACES[kind])
        for _ in range(rng.randint(1, 6)):
            own = _LABELS[kind]
            text = " ".join(rng.choice(own) for _ in range(rng.randint(1, 6)))
            link = kind in ("menu", "side") and rng.random() < 0.8
            if kind == "comment" and place[1] and rng.random() < 0.5:  # its container alone tells it from an article
                text = f"{say(rng.randint(3, 30))}."
            elif kind == "comment" or rng.random() < 0.25:
                text = f"{text} {say(rng.randint(3, 40))}."
            leaf = {"menu": "li", "side": "li", "comment": "p", "form": "label"}.get(kind, rng.choice(("p", "div")))
            yield Block(text.capitalize(), base + (place, (leaf, ())), len(text) if link else 0, len(text)), 0

    def within(base):
        """Article blocks other than running prose."""
        kind = rng.choice(("list", "list", "table", "pre", "short", "short", "heading", "quote"))
        if kind == "list":
            place, leaf, n = (rng.choice(("ul", "ol")), ()), "li", rng.randint(2, 6)
        elif kind == "table":
            place, leaf, n = ("table", ()), rng.choice(("td", "th", "td")), rng.randint(3, 9)
        else:
            place, leaf, n = None, {"pre": "pre", "heading": rng.choice(("h2", "h3")), "quote": "blockquote"}.get(kind, rng.choice(("p", "p", "div"))), 1
        for _ in range(n):
            text = say(rng.randint(1, 5) if kind in ("table", "heading") else rng.randint(2, 14))
            if kind == "table" and rng.random() < 0.5:
                text = str(rng.randint(1, 5000))
            text = text.capitalize() + ("." if kind in ("short", "quote") or (kind == "list" and rng.random() < 0.5) else "")
            yield Block(text, base + ((place, ("tr", ())) if kind == "table" else (place,) if place else ()) + ((leaf, ()),), 0, len(text)), 1

    out = [*extra("menu", wrap)]
    for kind in ("notice", "advert", "form"):
        if rng.random() < 0.4:
            out += extra(kind, wrap)
    started, inner = False, wrap + ((holder,) if rng.random() < 0.85 else ())
    for b, label in zip(page_blocks, y):
        if label:
            first, started = not started, True
            leaf = b.path[-1] if b.path and b.path[-1][0] in ("h1", "h2", "h3", "p", "li", "blockquote", "pre") else ("p", ())
            out.append((Block(b.text, inner + ((leaf[0], ()),), b.linked, b.chars), 1))
            if first and rng.random() < 0.2:
                line = f"By {say(2).title()}"
                out.append((Block(line, inner + ((rng.choice(("p", "div")), (rng.choice(("byline", "author", "meta")),)),), 0, len(line)), 1))
            if rng.random() < 0.15:
                out += within(inner)
            if rng.random() < 0.04:
                out += extra(rng.choice(("advert", "side", "form")), inner)
        else:
            place = rng.choice(_PLACES["menu" if not started else "foot"]) if rng.random() < 0.5 else None
            path = wrap + ((place,) if place else b.path[2:-1]) + (b.path[-1:] or (("div", ()),))
            out.append((Block(b.text, path, b.linked, b.chars), 0))
    if rng.random() < 0.8:
        out += extra("comment", wrap + ((holder,) if rng.random() < 0.5 else ()))
    for kind in ("side", "advert", "foot"):
        if rng.random() < 0.5:
            out += extra(kind, wrap)
    bs, ys = zip(*out)
    return list(bs), np.array(ys)


def plain(page_blocks: list[Block], y: np.ndarray) -> list[Block]:
    """The page's article as one block without any markup around it."""
    text = " ".join(b.text for b, label in zip(page_blocks, y) if label)
    return [Block(text, (), 0, len(text))] if text else []


# --- the network ----------------------------------------------------------------

def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def new_weights(seed: int = 5) -> dict:
    r = np.random.default_rng(seed)
    w = {}
    for d in "fb":  # forward, backward; gates: input, forget, cell, output
        w["x" + d] = r.normal(0, 1 / np.sqrt(INPUT), (INPUT, 4 * HIDDEN)).astype(np.float32)
        w["h" + d] = r.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        w["c" + d] = np.zeros(4 * HIDDEN, np.float32)
        w["c" + d][HIDDEN:2 * HIDDEN] = 1.0
    w["o"] = r.normal(0, 0.2, 2 * HIDDEN + INPUT).astype(np.float32)
    w["oc"] = np.zeros(1, np.float32)
    return w


def _lstm(x, mask, wx, wh, c0, keep: bool, start=None):
    """States (T, B, H) of one direction; padded steps pass the state on.
    ``start`` (h, c) is the state before the first step."""
    t_len, batch, _ = x.shape
    pre = x @ wx + c0
    h, c = start or (np.zeros((batch, HIDDEN), np.float32), np.zeros((batch, HIDDEN), np.float32))
    states, trace = np.empty((t_len, batch, HIDDEN), np.float32), []
    for t in range(t_len):
        z = pre[t] + h @ wh
        gate = _sigmoid(z)
        g = np.tanh(z[:, 2 * HIDDEN:3 * HIDDEN])
        i, f, o = gate[:, :HIDDEN], gate[:, HIDDEN:2 * HIDDEN], gate[:, 3 * HIDDEN:]
        m = mask[t][:, None]
        new_c = f * c + i * g
        th = np.tanh(new_c)
        if keep:
            trace.append((h, c, i, f, g, o, th, m))
        c = m * new_c + (1 - m) * c
        h = m * (o * th) + (1 - m) * h
        states[t] = h
    return states, trace, (h, c)


def _lstm_back(x, dh_out, trace, wx, wh):
    """Gradients of one direction by back-propagation through time."""
    dwx, dwh = np.zeros_like(wx), np.zeros_like(wh)
    dc0 = np.zeros(4 * HIDDEN, np.float32)
    dh, dc = np.zeros_like(dh_out[0]), np.zeros_like(dh_out[0])
    for t in range(len(trace) - 1, -1, -1):
        h, c, i, f, g, o, th, m = trace[t]
        dh = dh + dh_out[t]
        do = m * dh * th
        dcn = m * (dc + dh * o * (1 - th * th))
        dz = np.concatenate([dcn * g * i * (1 - i), dcn * c * f * (1 - f), dcn * i * (1 - g * g), do * o * (1 - o)], axis=1)
        dwx += x[t].T @ dz
        dwh += h.T @ dz
        dc0 += dz.sum(axis=0)
        dc = dcn * f + (1 - m) * dc
        dh = dz @ wh.T + (1 - m) * dh
    return dwx, dwh, dc0


def _padded(pages: list[np.ndarray]):
    t_len = max(map(len, pages))
    x = np.zeros((t_len, len(pages), INPUT), np.float32)
    mask = np.zeros((t_len, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[:len(p), k] = p
        mask[:len(p), k] = 1
    return x, mask


def forward(w: dict, pages: list[np.ndarray], keep: bool = False):
    """Probability that a block is article, (T, pages)."""
    x, mask = _padded(pages)
    hf, tf, _ = _lstm(x, mask, w["xf"], w["hf"], w["cf"], keep)
    hb, tb, _ = _lstm(x[::-1], mask[::-1], w["xb"], w["hb"], w["cb"], keep)
    joined = np.concatenate([hf, hb[::-1], x], axis=2)
    p = _sigmoid(joined @ w["o"] + w["oc"][0])
    return (p, mask, x, joined, tf, tb) if keep else (p, mask)


def forward_long(w: dict, page_blocks: list[Block], piece: int = PIECE) -> np.ndarray:
    """``forward`` of one page, in pieces: the backward states first (kept with
    16 bits each), then the forward ones, whose pieces are classified at once."""
    n = len(page_blocks)
    back = np.empty((n, HIDDEN), np.float16)
    state = None
    cuts = list(range(0, n, piece))
    ones = np.ones((piece, 1), np.float32)
    for at in reversed(cuts):
        x = vectors(page_blocks[at:at + piece], at, n)[:, None]
        states, _, state = _lstm(x[::-1], ones[:len(x)], w["xb"], w["hb"], w["cb"], False, state)
        back[at:at + len(x)] = states[::-1, 0]
    out, state = np.empty(n, np.float32), None
    for at in cuts:
        x = vectors(page_blocks[at:at + piece], at, n)[:, None]
        states, _, state = _lstm(x, ones[:len(x)], w["xf"], w["hf"], w["cf"], False, state)
        joined = np.concatenate([states[:, 0], back[at:at + len(x)].astype(np.float32), x[:, 0]], axis=1)
        out[at:at + len(x)] = _sigmoid(joined @ w["o"] + w["oc"][0])
    return out


def fit(examples: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 5, batch: int = 24) -> dict:
    """Adam on the mean log loss of blocks."""
    w, rng = new_weights(seed), random.Random(seed)
    m1 = {k: np.zeros_like(v) for k, v in w.items()}
    m2 = {k: np.zeros_like(v) for k, v in w.items()}
    step = 0
    for epoch in range(epochs):
        order = sorted(range(len(examples)), key=lambda i: (len(examples[i][1]) // 8, rng.random()))
        groups = [order[i:i + batch] for i in range(0, len(order), batch)]
        rng.shuffle(groups)
        for group in groups:
            xs, ys = [examples[i][0] for i in group], [examples[i][1] for i in group]
            p, mask, x, joined, tf, tb = forward(w, xs, keep=True)
            y = np.zeros_like(mask)
            for k, v in enumerate(ys):
                y[:len(v), k] = v
            d = ((p - y) * mask / mask.sum()).astype(np.float32)
            dj = d[:, :, None] * w["o"][None, None]
            g = {"o": np.tensordot(joined, d, axes=([0, 1], [0, 1])), "oc": d.sum(keepdims=True).reshape(1)}
            g["xf"], g["hf"], g["cf"] = _lstm_back(x, dj[:, :, :HIDDEN], tf, w["xf"], w["hf"])
            g["xb"], g["hb"], g["cb"] = _lstm_back(x[::-1], dj[::-1, :, HIDDEN:2 * HIDDEN], tb, w["xb"], w["hb"])
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            step += 1
            rate = RATE * (1 - 0.8 * epoch / epochs)
            for k, v in g.items():
                v = v * min(1.0, 2.0 / (norm + 1e-9))
                m1[k] = 0.9 * m1[k] + 0.1 * v
                m2[k] = 0.99 * m2[k] + 0.01 * v * v
                w[k] = (w[k] - rate * (m1[k] / (1 - 0.9 ** step))
                        / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return w


def train(pages: DataFrame, seed: int = 5) -> dict:
    """Fit on the bounded sample; with no pages, untrained weights."""
    rows = pages.where("html IS NOT NULL").select("html", F.xxhash64(F.lit(seed), "page_id").alias("h"))
    sample = rows.orderBy("h", F.md5("html")).limit(SAMPLE_PAGES).select("html").toArrow().column(0).to_pylist()
    parsed = [b for b in map(blocks, sample) if b]
    words = [w for bs in parsed for b in bs[:8] for w in b.text.split()[:12]] or ["text"]
    rng, examples = random.Random(seed), []
    for bs in parsed:
        y = teach(bs)
        examples.append((vectors(bs), y))
        for _ in range(VARIANTS):
            vb, vy = variant(bs, y, words, rng)
            examples.append((vectors(vb), vy))
        if len(examples) % 3 == 0 and (bare := plain(bs, y)):
            examples.append((vectors(bare), np.ones(1, int)))
    return fit(examples, seed=seed) if examples else new_weights(seed)


def main_texts(w: dict, pages: list[str | None]) -> list[str]:
    """The article text of each page; pages of like length share a batch."""
    parsed = [blocks(p) if p else [] for p in pages]
    out = [""] * len(pages)
    for i, bs in enumerate(parsed):
        if len(bs) > LONG:
            out[i] = "\n\n".join(b.text for b, s in zip(bs, forward_long(w, bs)) if s >= 0.5)
    order = sorted((i for i, b in enumerate(parsed) if 0 < len(b) <= LONG), key=lambda i: len(parsed[i]))
    at = 0
    while at < len(order):
        size = max(1, min(64, 20_000 // len(parsed[order[at]])))
        group = order[at:at + size]
        at += size
        p, _ = forward(w, [vectors(parsed[i]) for i in group])
        for k, i in enumerate(group):
            out[i] = "\n\n".join(b.text for b, s in zip(parsed[i], p[:, k]) if s >= 0.5)
    return out


def extract(pages: DataFrame, w: dict) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(w)

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                texts = main_texts(shared.value, part.column("html").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(run, RESULT)


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages.select(F.col("page_id").cast("long").alias("page_id"), "html")))
