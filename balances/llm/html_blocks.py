"""Pages to leaf blocks: a tolerant tokeniser that yields, in page order, every
block of visible text with its tag path, and the vectors the labeller reads."""
from __future__ import annotations

import html
import re
import zlib

import numpy as np

#: Elements whose content is never text of the page.
_RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math",
        "object", "canvas", "select", "button", "option", "head")
_VOID = {"br", "img", "hr", "input", "meta", "link", "wbr", "area", "base", "col", "embed", "source", "track"}
_INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i",
           "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
           "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
#: An opening tag on the left ends the open elements on the right.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "option": {"option"}}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>|[^<]+|<",
                    re.S)
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_HINT = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_CLOSE = {n: re.compile(rf"</{n}\b[^>]*>", re.I) for n in _RAW}
_PART = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


class Block:
    __slots__ = ("text", "path", "linked", "chars")

    def __init__(self, text, path, linked, chars):
        self.text, self.path, self.linked, self.chars = text, path, linked, chars


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order. A path is a tuple of (tag, hint words)."""
    out: list[Block] = []
    stack: list[tuple[str, tuple]] = []
    run: list[str] = []
    state = [None, 0, 0]  # path of the run, characters in links, characters

    def flush():
        if run:
            text = _SPACE.sub(" ", html.unescape("".join(run))).strip()
            if text:
                out.append(Block(text, state[0], state[1], state[2]))
            run.clear()
        state[:] = [None, 0, 0]

    pos, n = 0, len(page)
    while pos < n:
        m = _TOKEN.match(page, pos)
        token = m[0]
        pos = m.end()
        if token[0] != "<" or token == "<":
            if state[0] is None:
                if token.isspace():
                    continue
                state[0] = tuple(e for e in stack if e[0] not in _INLINE)
            run.append(token)
            size = len(token)
            state[2] += size
            if any(t == "a" for t, _ in stack[-4:]):
                state[1] += size
            continue
        if token[1] in "!?":
            continue
        name = _NAME.match(token)[1].lower()
        if token[1] == "/":
            if name in _INLINE:
                for k in range(len(stack) - 1, max(-1, len(stack) - 9), -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
                    if stack[k][0] not in _INLINE:
                        break
                continue
            flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        if name == "br":
            if run:
                run.append(" ")
            continue
        if name in _RAW and not token.endswith("/>"):
            if name == "head":
                end = re.compile(r"</head\s*>|<body\b", re.I).search(page, pos)
                if end:  # scripts may hold either string: step over them
                    pos = _head_end(page, pos)
                continue
            if name not in ("option", "button"):
                flush()
            end = _CLOSE[name].search(page, pos)
            if end:
                pos = end.end()
            elif name in ("script", "style", "textarea", "title"):
                pos = n
            continue
        if name in _VOID:
            if name == "hr":
                flush()
            continue
        hints = tuple(w for g in _HINT.findall(token) for v in g if v for w in _PART.findall(v.lower())) \
            if "=" in token else ()
        if name not in _INLINE:
            flush()
            for k in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph and its like
                t = stack[k][0]
                if t == "p" or t in _ENDS.get(name, ()):
                    del stack[k:]
                    break
                if t not in _INLINE:
                    break
        if not token.endswith("/>"):
            stack.append((name, hints))
    flush()
    return out


def _head_end(page: str, pos: int) -> int:
    """Where the head ends, its raw elements left aside."""
    while True:
        m = re.compile(r"<(script|style|title|noscript|template)\b[^>]*>|</head\s*>|<body\b", re.I).search(page, pos)
        if not m:
            return len(page) if "<body" not in page[pos:].lower() else pos
        if m[1]:
            end = _CLOSE[m[1].lower()].search(page, m.end())
            if not end:
                return len(page)
            pos = end.end()
        else:
            return m.start() if m[0][1] != "/" else m.end()


#: Containers and hint words that declare what a block is.
ARTICLE_TAGS = {"article", "main"}
ARTICLE_HINTS = {"article", "content", "post", "story", "entry", "main", "body", "text"}
OTHER_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "address", "fieldset"}
OTHER_HINTS = {"ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "banner", "nav", "navbar",
               "menu", "sidebar", "aside", "footer", "header", "masthead", "cookie", "cookies", "consent", "notice",
               "alert", "newsletter", "subscribe", "signup", "login", "search", "form", "share", "social", "related",
               "recommended", "comment", "comments", "reply", "replies", "disqus", "breadcrumb", "breadcrumbs",
               "pagination", "pager", "modal", "popup", "widget", "tags", "copyright", "legal"}


def declared(path: tuple) -> int:
    """1 article, 0 other, by the innermost container that says so; -1 unsaid."""
    inside = any(t in ARTICLE_TAGS for t, _ in path)
    for tag, hints in reversed(path):
        if tag in OTHER_TAGS and not (tag == "header" and inside):
            return 0
        if tag not in ("html", "body", *ARTICLE_TAGS) and OTHER_HINTS & set(hints):
            return 0
    if inside or any(tag not in ("html", "body") and ARTICLE_HINTS & set(hints) for tag, hints in path):
        return 1
    return -1


PATH_DIMS, WORD_DIMS, PLAIN = 64, 48, 12
INPUT = PATH_DIMS + WORD_DIMS + PLAIN
_bucket: dict[str, tuple[int, float]] = {}


def _hashed(key: str, dims: int) -> tuple[int, float]:
    got = _bucket.get(key)
    if got is None:
        if len(_bucket) > 200_000:
            _bucket.clear()
        h = zlib.crc32(key.encode("utf-8", "replace"))
        got = _bucket[key] = (h % dims, 1.0 if h & 0x10000 else -1.0)
    return got


def vectors(page_blocks: list[Block], at: int = 0, total: int | None = None) -> np.ndarray:
    """One input row per block: hashed tag path, hashed words, plain measures.
    A piece of a page starts ``at`` one of its ``total`` blocks."""
    x = np.zeros((len(page_blocks), INPUT), np.float32)
    n = max(1, len(page_blocks) if total is None else total)
    for i, b in enumerate(page_blocks):
        row = x[i]
        for depth, (tag, hints) in enumerate(b.path):
            near = 1.0 if depth >= len(b.path) - 3 else 0.6
            k, s = _hashed("t:" + tag, PATH_DIMS)
            row[k] += s * near
            for w in hints:
                k, s = _hashed("h:" + w, PATH_DIMS)
                row[k] += s
        words = b.text.lower().split()
        idx = [_hashed(w.strip(".,;:!?\"'()"), WORD_DIMS) for w in words]
        said = row[PATH_DIMS:PATH_DIMS + WORD_DIMS]
        if len(idx) <= 32:
            for k, s in idx:
                said[k] += s
        else:
            ks, ss = zip(*idx)
            said[:] = np.bincount(ks, ss, WORD_DIMS)
        said /= max(1.0, float(said @ said) ** 0.5)
        chars = len(b.text)
        letters = sum(map(b.text.count, "aeiou"))
        tag = b.path[-1][0] if b.path else ""
        said_by = declared(b.path)
        row[-PLAIN:] = (
            np.log1p(chars) / 5, np.log1p(len(words)) / 3, b.linked / max(1, b.chars),
            b.text[-1] in ".!?…\"”", sum(map(b.text.count, ".,;")) / len(words), letters / chars,
            tag in ("h1", "h2", "h3", "h4"), tag in ("p", "blockquote", "pre"),
            said_by == 0, said_by == 1, (at + i + 0.5) / n, 1.0)
    return x
