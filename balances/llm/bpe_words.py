"""Byte-level BPE of pre-tokens: the pre-token pattern, and bounded memos in
which the tokenizers library encodes each distinct pre-token once. Encoding a
text is the concatenation over its pre-tokens, so a memo is exact."""
from __future__ import annotations

import json
import os
import re

import numpy as np
import regex

#: Pre-token pattern of the byte-level vocabulary (fixed value). White space is
#: the Unicode property, which leaves out the separators U+001C..U+001F.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Pre-tokens remembered per Python worker.
MEMO_WORDS = 1_000_000
#: The same pattern for texts of Latin-1 characters but those that ``_UNLIKE``
#: names, on which the standard library's classes agree; it scans twice as fast.
_LATIN = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+").findall
_UNLIKE = re.compile("[^\x00-\xff]|[\x1c-\x1f\xb2\xb3\xb9\xbc\xbd\xbe]").search
_ANY = regex.compile(PATTERN).findall


class WordEncoder:
    """Pre-tokens -> little-endian id bytes (``dtype`` '<u4', or '<u2' for a
    vocabulary below 65,536)."""

    def __init__(self, path: str, dtype: str = "<u4", memo_words: int = MEMO_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            added = json.load(f)["added_tokens"]
        self.dtype = np.dtype(dtype)
        self.special = {t["content"]: np.array([t["id"]], self.dtype).tobytes() for t in added}
        self.split_special = regex.compile(
            "(" + "|".join(regex.escape(s) for s in self.special) + ")").split
        self.memo: dict[str, bytes] = {}
        self.room = memo_words

    def learn(self, words) -> dict[str, bytes]:
        """Make sure the memo has all of ``words``."""
        memo = self.memo
        new = {w for w in words if w not in memo}
        if new:
            if len(memo) + len(new) > self.room:
                new = set(words)
                memo.clear()
            self._learn_joined([w for w in new if w[0] == " " and w[1:].isalpha()], "", memo)
            self._learn_joined([w for w in new if w.isalpha()], "\n", memo)
            rest = [w for w in new if w not in memo]
            for w, e in zip(rest, self.library.encode_batch_fast(rest, add_special_tokens=False)):
                memo[w] = np.array(e.ids, self.dtype).tobytes()
        return memo

    def _learn_joined(self, words: list[str], between: str, memo: dict) -> None:
        """Encode many words as one text in which each is a pre-token by itself:
        a space before a word, or a line break between two, parts them. Groups
        in which the library sees other pre-tokens are left to the caller."""
        step = 2 if between else 1
        for at in range(0, len(words), 4096):
            group = words[at:at + 4096]
            e = self.library.encode(between.join(group), add_special_tokens=False)
            ids, of = np.array(e.ids, self.dtype), np.array(e.word_ids, np.int64)
            starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            if len(starts) != step * (len(group) - 1) + 1:
                continue
            raw, size = ids.tobytes(), self.dtype.itemsize
            bounds = [*(starts * size).tolist(), len(raw)]
            memo.update(zip(group, (raw[a:b] for a, b in zip(bounds[::step], bounds[1::step]))))

    def parts(self, text: str):
        """(part, is_special) in order; a special string is one token."""
        if "<|" not in text:
            yield text, False
            return
        for part in self.split_special(text):
            if part:
                yield part, part in self.special

    @staticmethod
    def words(text: str) -> list[str]:
        return _ANY(text) if _UNLIKE(text) else _LATIN(text)


#: Character classes of the pre-token pattern.
_LETTER, _NUMBER, _SPACE, _OTHER, _EDGE = 1, 2, 3, 4, 5
_SENTINEL = 0x110000
_MIX = 0x9E3779B97F4A7C15
_MIX_INV = pow(_MIX, -1, 1 << 64)
#: Words whose ids a ``BatchEncoder`` keeps (about 25 bytes each).
TABLE_WORDS = 3_000_000
_tables: dict = {}


def _class_table() -> np.ndarray:
    if "class" not in _tables:
        t = np.full(_SENTINEL + 1, _OTHER, np.uint8)
        code = np.r_[0:0xD800, 0xE000:0x110000].astype("<u4")  # without surrogates
        every = code.tobytes().decode("utf-32-le")
        for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\p{White_Space}+")):
            for run in regex.finditer(pattern, every):
                t[code[run.start():run.end()]] = kind
        t[_SENTINEL] = _EDGE
        _tables["class"] = t
    return _tables["class"]


def _powers(base: int, n: int) -> np.ndarray:
    t = _tables.get(base)
    if t is None or len(t) < n:
        t = np.full(max(n, 1 << 16), base, np.uint64)
        t[0] = 1
        t = _tables[base] = np.multiply.accumulate(t)
    return t[:n]


def pretoken_starts(c: np.ndarray) -> np.ndarray:
    """Start positions of the pre-tokens of code points ``c``, in which
    sentinels part one text from the next (each sentinel is a start, too). The
    pattern's alternatives, as rules on runs of one character class:

    * a run of letters, numbers or other signs is a pre-token, and takes a
      single U+0020 before it;
    * white space before something else leaves out its last character, which
      is a pre-token by itself unless it is that U+0020;
    * an apostrophe that is a run by itself, with no U+0020 before it, takes
      the letters of a contraction from the run behind it.
    """
    k = _class_table()[c]
    start = np.empty(len(c), bool)
    start[0] = True
    np.not_equal(k[1:], k[:-1], out=start[1:])
    space = k == _SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:])  # last white space before something else
    last = last[k[last + 1] != _EDGE]
    start[last] = True
    start[last[c[last] == 32] + 1] = False
    quote = np.flatnonzero((c[1:-2] == 39) & (k[:-3] != _OTHER) & (c[:-3] != 32) & (k[2:-1] == _LETTER)) + 1
    if len(quote):
        x, y = c[quote + 1], c[quote + 2]
        one = (x == 115) | (x == 116) | (x == 109) | (x == 100)
        two = ((x == 114) & (y == 101)) | ((x == 118) & (y == 101)) | ((x == 108) & (y == 108))
        for hit, size in ((one, 1), (two & ~one, 2)):
            p = quote[hit]
            start[p + 1] = False
            rest = p + 1 + size
            start[rest[k[rest] == _LETTER]] = True
    return np.flatnonzero(start)


class BatchEncoder:
    """Ids of many texts at once. Pre-tokens are found and hashed (64 bits) by
    array operations; a sorted table holds characters and ids of the hashes met
    so far, and the library encodes each pre-token that is not among them. A
    hit counts only where all characters agree; texts with two pre-tokens of
    one hash are encoded word by word."""

    def __init__(self, path: str, dtype: str = "<u4", table_words: int = TABLE_WORDS):
        self.words = WordEncoder(path, dtype)
        self.dtype, self.library, self.room = self.words.dtype, self.words.library, table_words
        self._empty()

    def _empty(self):
        self.hashes = np.empty(0, np.uint64)
        self.at = np.empty(0, np.int64)
        self.count = np.empty(0, np.int64)
        self.ids, self.used = np.empty(1 << 16, self.dtype), 0
        self.chars, self.written = np.empty(1 << 16, "<u4"), 0
        self.chars_at, self.size = np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        if len(self.hashes) + len(hashes) > self.room:
            self._empty()
        memo = self.words.learn(texts)
        raw = [memo[t] for t in texts]
        memo.clear()
        size = self.dtype.itemsize
        count = np.array([len(r) // size for r in raw], np.int64)
        new = np.frombuffer(b"".join(raw), self.dtype)
        while self.used + len(new) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.used:self.used + len(new)] = new
        at = self.used + np.cumsum(count) - count
        self.used += len(new)
        length = np.array([len(t) for t in texts], np.int64)
        signs = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        while self.written + len(signs) > len(self.chars):
            self.chars = np.concatenate([self.chars, np.empty_like(self.chars)])
        self.chars[self.written:self.written + len(signs)] = signs
        chars_at = self.written + np.cumsum(length) - length
        self.written += len(signs)
        place = np.searchsorted(self.hashes, hashes)
        self.chars_at = np.insert(self.chars_at, place, chars_at)
        self.size = np.insert(self.size, place, length)
        self.hashes = np.insert(self.hashes, place, hashes)
        self.at = np.insert(self.at, place, at)
        self.count = np.insert(self.count, place, count)

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))
        return at, self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)

    def _one_by_one(self, text: str) -> bytes:
        out = []
        for part, special in self.words.parts(text):
            if special:
                out.append(self.words.special[part])
            else:
                words = self.words.words(part)
                memo = self.words.learn(words)
                out += [memo[w] for w in words]
        return b"".join(out)

    def encode_many(self, texts: list[str]) -> list[bytes]:
        parts = [list(self.words.parts(t)) for t in texts]
        plain = [p for ps in parts for p, special in ps if not special]
        edge = np.array([_SENTINEL], "<u4").tobytes()
        c = np.frombuffer(edge + b"".join([p.encode("utf-32-le") + edge for p in plain]) + edge, "<u4")
        starts = pretoken_starts(c)
        ends = np.append(starts[1:], len(c))
        inner = c[starts] != _SENTINEL
        starts, ends = starts[inner], ends[inner]
        total = np.zeros(len(c) + 1, np.uint64)
        np.cumsum((c.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)) * _powers(_MIX, len(c)), out=total[1:])
        h = (total[ends] - total[starts]) * _powers(_MIX_INV, len(c))[starts]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        uniq, first, back = np.unique(h, return_index=True, return_inverse=True)
        at, known = self._find(uniq)
        whole = "" if known.all() else np.where(c == _SENTINEL, 0, c).astype("<u4").tobytes().decode("utf-32-le")
        while not known.all():  # twice where the table begins anew
            new = first[~known]
            self._learn(uniq[~known], [whole[s:e] for s, e in zip(starts[new].tolist(), ends[new].tolist())])
            at, known = self._find(uniq)
        size = ends - starts
        same = _equal_runs(c, starts, size, c, starts[first][back], size[first][back])
        same = same and _equal_runs(c, starts[first], size[first], self.chars, self.chars_at[at], self.size[at])
        if not same:  # two pre-tokens of one hash
            return [self._one_by_one(t) for t in texts]
        count = self.count[at][back]
        upto = np.cumsum(count)
        ids = self.ids[np.repeat(self.at[at][back] - (upto - count), count) + np.arange(upto[-1] if len(upto) else 0)]
        bounds = np.append(0, upto)[np.searchsorted(starts, np.flatnonzero(c == _SENTINEL))]
        raw, size = ids.tobytes(), self.dtype.itemsize
        bounds = (bounds * size).tolist()
        done, out = 0, []
        for ps in parts:
            pieces = []
            for p, special in ps:
                if special:
                    pieces.append(self.words.special[p])
                else:
                    pieces.append(raw[bounds[done]:bounds[done + 1]])
                    done += 1
            out.append(pieces[0] if len(pieces) == 1 else b"".join(pieces))
        return out


def _equal_runs(x, x_at, x_size, y, y_at, y_size) -> bool:
    """Whether all runs of ``x`` hold what those of ``y`` hold."""
    if not (x_size == y_size).all():
        return False
    upto = np.cumsum(x_size)
    within = np.arange(upto[-1] if len(upto) else 0) - np.repeat(upto - x_size, x_size)
    return bool((x[within + np.repeat(x_at, x_size)] == y[within + np.repeat(y_at, x_size)]).all())


def slices(texts: list[str], chars: int = 1_000_000):
    """Index ranges of about ``chars`` characters each (a longer text alone)."""
    start = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > chars:
            yield start, i
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield start, len(texts)
