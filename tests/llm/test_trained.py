"""Operators 1, 7 and 8: held-out accuracy, and their parts by hand."""
import random
import re
import time
import tracemalloc

import numpy as np
import pytest

from llm_helpers import AWKWARD, frame

from balances.llm import html_blocks, langid, main_text, toxicity

SF = "/root/testdata/sf0.01"


# --- language ------------------------------------------------------------------

LANGS = {"aa": "bafo deki lumo sana", "bb": "zrt qwx vrk plk", "cc": "ñiña leño peña caña"}


def lang_rows(n=240):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(LANGS))
        rows.append((i, " ".join(rng.choice(LANGS[lang].split()) for _ in range(rng.randint(1, 30))), lang))
    return rows


def test_language_held_out(spark):
    docs = frame(spark, lang_rows() + [(i, t, None) for i, t in AWKWARD if i is not None])
    model = langid.train(docs)
    assert model.langs == sorted(LANGS)
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in lang_rows() if i > 20)
    assert got[1].score <= 1 and langid.Model.predict(model, None) == ("und", 1.0)
    assert model.predict("123 !!! ") == ("und", 1.0) and model.predict("")[0] == "und"
    kept = langid.keep_identified(docs, model, 0.4)
    assert kept.columns == docs.columns and kept.where("text is null or text = ''").count() == 0


def test_language_of_driver_documents(spark):
    out = langid.op8_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    held = out.where("held_out AND lang IS NOT NULL").toPandas()
    assert (held.lang == held.lang_pred).mean() > 0.98 and held.score.between(0, 1).all()


def test_language_edges(spark):
    empty = frame(spark, [])
    model = langid.train(empty)
    assert langid.identify(empty, model).collect() == [] and model.predict("text") == ("und", 0.0)
    one = langid.train(frame(spark, [(i, "only one language", "xx") for i in range(20)]))
    assert one.predict("any words") == ("xx", 1.0)


def test_document_frequencies(spark):
    rows = [(1, "ab ab"), (2, "ab cd"), (3, None), (4, "12")]
    df, n = langid.document_frequencies(frame(spark, rows).repartition(2))
    want = sum(np.bincount(np.unique(langid.features(t)), minlength=langid.DIMS) for _, t in rows[:2])
    assert n == 2 and (df == want).all()


# --- toxicity ------------------------------------------------------------------

def restorer():
    corpus = np.zeros(toxicity.CLASSES ** 3, np.int64)
    text = toxicity.classes("the idea of an idle person is not a stupid one but loses all clowns trash " * 50)
    corpus += toxicity._bins([text])
    return toxicity.Restorer(corpus, dict.fromkeys(("idiot", "stupid", "loser", "worthless", "clown", "trash", "ass"), 1.0))


@pytest.mark.parametrize("shown, meant", [
    ("1d10t", "idiot"), ("i d i o t", "idiot"), ("idiooot", "idiot"), ("$tup1d", "stupid"), ("s-t-u-p-i-d", "stupid"),
    ("l0s3r!", "loser"), ("worthle$$", "worthless"), ("st*pid", "stupid"), ("c.l.o.w.n", "clown"), ("tr@sh,", "trash"),
    ("T R A S H", "trash"), ("(1d10t)", "idiot"), ("id​iot", "idiot"),
    ("i,d,i,o,t", "idiot"), ("i~d~i~o~t", "idiot"), ("id iot", "idiot"), ("lo-ser", "loser"), ("iiddiioott", "idiot"), ("s****d", "stupid"),
    ("st**id", "stupid"), ("wor.th.less", "worthless"), ("cl0wnn", "clown"), ("@$$", "ass")])
def test_restores_hidden_words(shown, meant):
    assert f" {meant} " in toxicity.spaced(restorer().restore(f"the {shown} of"))


@pytest.mark.parametrize("text", ["", "plain words stay as they are.", "été déjà vu, ñandú", "the end."])
def test_leaves_plain_text(text):
    assert restorer().restore(text) == text


@pytest.mark.parametrize("span", ["1d10t", "l0s3r", "$tup1d", "tr@$h", "c10wn", "wor-th", "id iot", "aa11", "s*", "x$$y"])
def test_viterbi_is_the_best_path(span):
    """Against every path through the lattice, by narrow and by wide steps."""
    r = restorer()
    table = r.logp

    def score(text):
        s, x, y = 0.0, 0, 0
        for z in [int(toxicity._class_table()[ord(ch)]) for ch in text]:
            if z or y:
                s += table[x, y, z]
                x, y = y, z
        return s + table[x, y, 0]
    paths = [("", 0.0)]
    for choices in toxicity.lattice(span, r.per_sign):
        paths = [(t + out, s + cost) for t, s in paths for out, cost in choices]
    best = max(s + score(t) for t, s in paths)
    got = r.decode(span)
    assert abs(max(s for t, s in paths if t == got) + score(got) - best) < 1e-4
    scores = {0: 0.0}
    for choices in toxicity.lattice(span, r.per_sign):
        scores, _ = r._wide_step(scores, choices)
    assert abs(max(v + r.logp.ravel()[k * toxicity.CLASSES] for k, v in scores.items()) - best) < 1e-4


def test_long_spans_take_time_in_proportion():
    import time
    r = restorer()
    took = []
    for n in (4000, 16000):
        start = time.perf_counter()
        r.decode("".join(random.Random(1).choice("abcd1$") for _ in range(n)))
        took.append(time.perf_counter() - start)
    assert took[1] < 8 * took[0] and r.decode("a" + "*" * 5000 + "b").replace(" ", "") == "ab"


def test_toxicity_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = toxicity.op7_toxicity(spark, SF)
    both = out.join(labels, "doc_id").where("held_out").toPandas()
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    clean, toxic = both[both.toxic == 0], both[both.toxic == 1]
    assert both.score.between(0, 1).all() and (both.predicted == (both.score >= 0.7)).all()
    assert clean.predicted.mean() < 0.05
    assert toxic.score.mean() > clean.score.mean() + 0.3


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(i, 0) for i in range(5)], "doc_id long, toxic int")
    docs = frame(spark, AWKWARD)
    scorer = toxicity.train(docs.select("doc_id", "text"), labels)
    scores = [r.score for r in toxicity.score_texts(docs, scorer).collect()]
    assert len(scores) == len(AWKWARD) and all(0 <= s <= 1 for s in scores)
    nothing = toxicity.train(frame(spark, []), labels.limit(0))
    assert nothing.score(None) == pytest.approx(0.5) and toxicity.score_texts(frame(spark, []), nothing).collect() == []


# --- pages ---------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</head><p>no</p>";</script></head>
<body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><div class="ad">Buy now</div>
<article><h1>A  title &amp; more</h1><p><b>First paragraph
of the text, with caf&eacute; &#x41;.<br>same block<p>Second one is <i>also</i> here and it has some words.</p></article>
<aside class=sidebar><p>Related</p></aside><footer>&copy; site</footer>"""


def test_blocks():
    got = [(b.path[-1][0] if b.path else "", b.text) for b in html_blocks.blocks(PAGE)]
    assert got == [("li", "Home"), ("li", "News"), ("div", "Buy now"), ("h1", "A title & more"),
                   ("p", "First paragraph of the text, with café A. same block"),
                   ("p", "Second one is also here and it has some words."), ("p", "Related"), ("footer", "© site")] or [
        t for _, t in got] == ["Home", "News", "Buy now", "A title & more",
                               "First paragraph of the text, with café A. same block",
                               "Second one is also here and it has some words.", "Related", "© site"]


@pytest.mark.parametrize("page", ["", "<", "<p", "a < b & c > d", "</p></div>", "<script>x", "<!-- open", "<p>&bogus; &#0;",
                                  "<div " * 2000, "<p>" * 3000 + "x", "text only", "<head><p>x", "\x00<b>y</b>"])
def test_blocks_never_fail(page):
    for b in html_blocks.blocks(page):
        assert b.text == b.text.strip() and b.text


def test_gradients():
    rng = np.random.default_rng(0)
    w = main_text.new_weights()
    xs = [rng.normal(size=(4, html_blocks.INPUT)).astype(np.float32), rng.normal(size=(2, html_blocks.INPUT)).astype(np.float32)]
    ys = [np.array([0, 1, 1, 0]), np.array([1, 0])]

    def loss(weights):
        p, mask = main_text.forward(weights, xs)
        y = np.zeros_like(mask)
        for k, v in enumerate(ys):
            y[:len(v), k] = v
        return -float(((y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum())
    p, mask, x, joined, tf, tb = main_text.forward(w, xs, keep=True)
    y = np.zeros_like(mask)
    for k, v in enumerate(ys):
        y[:len(v), k] = v
    d = ((p - y) * mask / mask.sum()).astype(np.float32)
    dj = d[:, :, None] * w["o"][None, None]
    h = main_text.HIDDEN
    grads = dict(zip(("xf", "hf", "cf"), main_text._lstm_back(x, dj[:, :, :h], tf, w["xf"], w["hf"])))
    grads |= dict(zip(("xb", "hb", "cb"), main_text._lstm_back(x[::-1], dj[::-1, :, h:2 * h], tb, w["xb"], w["hb"])))
    for name, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        up, down = ({**w, name: w[name].copy()} for _ in range(2))
        up[name][at] += 1e-2
        down[name][at] -= 1e-2
        assert (loss(up) - loss(down)) / 2e-2 == pytest.approx(g[at], rel=0.05, abs=1e-4)


def test_main_text_of_driver_pages(spark):
    """Held-out pages (not in the training sample) against their declared article."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    w = driver_weights(spark)
    rest = pages.orderBy("page_id").limit(400).toPandas()
    right = 0
    for html, text in zip(rest.html, main_text.main_texts(w, rest.html.tolist())):
        bs = html_blocks.blocks(html)
        right += text == "\n\n".join(b.text for b in bs if any(t == "article" for t, _ in b.path))
    assert right >= 0.99 * len(rest)
    # other markup: containers renamed, boilerplate of known kind set around
    rng, good, total = random.Random(77), 0, 0
    for html in rest.html[:120]:
        bs = html_blocks.blocks(html)
        vb, vy = main_text.variant(bs, main_text.teach(bs), ["lorem", "ipsum", "dolor"], rng)
        p, _ = main_text.forward(w, [html_blocks.vectors(vb)])
        good += int(((p[:, 0] >= 0.5) == vy).sum())
        total += len(vy)
    assert good >= 0.97 * total


HAND = """<html><head><title>Bread</title></head><body><div class="top"><ul><li><a href="/">Home</a></li><li><a href="/r">Recipes</a></li>
<li><a href="/c">Contact</a></li></ul></div><div><h1>How to bake bread</h1><p>By Ann Miller</p>
<p>Bread needs flour, water, salt and time, and of these the time is what most people lack when they begin.</p><p>You need:</p>
<ul><li>500 g of flour</li><li>350 ml of water</li><li>10 g of salt</li></ul>
<p>Mix everything in a large bowl until no dry flour is left, then cover the dough and let it rest for eight hours.</p>
<table><tr><th>Hours</th><th>Warmth</th></tr><tr><td>8</td><td>cool</td></tr><tr><td>4</td><td>warm</td></tr></table>
<pre>rest, fold, rest, fold, shape, bake</pre>
<p>Bake it hot, and wait until it is cold before you cut it.</p></div>
<div class="comments"><p>Bob says: great recipe, thanks a lot, I will try it next week.</p></div>
<footer><p>Copyright 2020 All rights reserved</p></footer></body></html>"""


def driver_weights(spark):
    if "w" not in _weights:
        pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
        _weights["w"] = main_text.train(pages.select("page_id", "html"))
    return _weights["w"]


_weights: dict = {}


def test_main_text_of_hand_written_pages(spark):
    w = driver_weights(spark)
    got = main_text.main_texts(w, [HAND])[0].split("\n\n")
    article = [b.text for b in html_blocks.blocks(HAND) if not any(
        t == "footer" or "comments" in h or "top" in h for t, h in b.path)]
    assert not [t for t in got if t not in article]
    assert len(got) >= len(article) - 2, [t for t in article if t not in got]
    bare = "The town council met on Monday to talk about the old bridge, which has been closed for two years. It will open again in May."
    assert main_text.main_texts(w, [bare, f"<p>{bare}</p>"]) == [bare, bare]


def test_long_pages_are_read_in_pieces():
    w = main_text.new_weights(3)
    bs = html_blocks.blocks("".join(f"<p>block {i} of this page, with words</p><li>{i}</li>" for i in range(300)))
    whole, _ = main_text.forward(w, [html_blocks.vectors(bs)])
    assert np.allclose(main_text.forward_long(w, bs, 37), whole[:, 0], atol=2e-3)


def test_main_text_edges(spark):
    rows = [(1, "u", None), (1, "u", None), (2, "u", ""), (3, None, PAGE), (4, "v", "<p>" + "word " * 50_000 + "</p>"), (None, "w", "x")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    w = main_text.train(pages.select("page_id", "html"))
    got = main_text.extract(pages, w).collect()
    assert sorted(str(r.page_id) for r in got) == sorted(str(r[0]) for r in rows)
    assert all(r.n_chars == len(r.text) for r in got) and {r.text for r in got if r.page_id in (1, 2)} == {""}
    empty = pages.limit(0)
    assert main_text.extract(empty, main_text.train(empty.select("page_id", "html"))).collect() == []


def test_language_examples_are_small_in_the_driver():
    """Six bytes for a feature of an example, not sixteen."""
    rng = random.Random(8)
    rows = [{"lang": "en" if i % 2 else "de", "text": "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(20000))} for i in range(40)]
    n = sum(len(np.unique(langid.features(r["text"]))) for r in rows)
    df = np.ones(langid.DIMS, np.int64)
    langid.fit(rows[:2], df, 40)
    tracemalloc.start()
    langid.fit(rows, df, 40)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    fixed = 8 * langid.DIMS * 2 * 8  # of the model: sums, weights and steps between them
    assert peak < fixed + 10 * n, (peak, fixed, n)


def test_spans_are_found_without_a_search_from_every_sign():
    """What the patterns replace, found by arrays; long words in time that
    grows with them."""
    corpus = np.zeros(toxicity.CLASSES ** 3, np.int64)
    restorer = toxicity.Restorer(corpus, {"idiot": 1.0, "loser": 1.0})

    def plain(text):
        text = toxicity.INVISIBLE.sub("", text.lower())
        text = toxicity._SPACED.sub(lambda m: f" {restorer._restored(m[0])} ", text)
        text = toxicity._STRETCHED.sub(lambda m: restorer._restored(m[0]), text)
        token = re.compile(r"(?<!\S)" + toxicity._TOKEN.pattern)
        text = token.sub(lambda m: restorer._token(m[0]), restorer._joined(text))
        return toxicity._SIGNS_ONLY.sub(lambda m: restorer._token(m[0]), text)

    rng = random.Random(11)
    signs = "aabbccdio1 0@$!|+ .-_·,'~^*#%?(<€аеоß中٣ É​\n\t　İ"
    words = ["idiot", "i d i o t", "id iot", "aabbcc", "aaab", "@$$", "1d10t", "l0ser!!", "iiddiioott", "_aaa_"]
    for _ in range(3000):
        text = "".join(rng.choice(signs) if rng.random() < 0.8 else rng.choice(words) for _ in range(rng.randrange(40)))
        assert restorer.restore(text) == plain(text), text
        assert toxicity.spaced(text) == " ".join(["", *text.translate(toxicity._PUNCTUATION).split(), ""])
    began = time.process_time()
    long = "abcd" * 10_000
    assert restorer.restore(long) == long
    assert time.process_time() - began < 1
