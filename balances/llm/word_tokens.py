"""Operator 3: token counts by heap-and-linked-list byte-pair merging.

A word's symbols form a doubly linked list; a heap holds every adjacent pair
that has a merge rank. The lowest rank (leftmost on ties) is popped again and
again, stale entries are skipped, and each merge shortens the list by one. The
count is the number of initial symbols minus the number of merges: no token
identifiers are made.

Defined results: null or empty text -> 0 bytes, 0 tokens, not over the limit;
repeated rows give one output row each; a null ``doc_id`` is carried through;
extra columns of the input are ignored. A text of any length is counted whole.
"""
from __future__ import annotations

import heapq
import json
import unicodedata

import pyarrow as pa
import regex

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balances.llm.common import table, text_or_empty

#: Words remembered per Python worker (about 100 bytes each).
MEMO_WORDS = 600_000
OVER_LIMIT = 2048
SCHEMA = "doc_id long, n_bytes long, n_tokens long"

_counters: dict = {}


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: a byte
    that prints stands for itself, the others follow from code point 256 on."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(spare)) for b in range(256)]


class WordCounter:
    """Counts the tokens of whole texts for one tokenizer file whose
    pre-tokenizer drops white space and marks word ends."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.symbols = byte_symbols()
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[a, b] = (rank, a + b)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word = regex.compile(split["pattern"]["Regex"])
        self.special = regex.compile("|".join(
            regex.escape(t["content"]) for t in spec["added_tokens"] if t["special"]))
        self.memo: dict[str, int] = {}
        self.room = memo_words

    def word_tokens(self, word: str) -> int:
        """Heap-and-linked-list merging of one word."""
        sym = [self.symbols[b] for b in word.encode("utf-8")]
        if not sym:
            return 0
        sym[-1] += self.end
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        merges, heap = self.merges, []
        for i in range(n - 1):
            hit = merges.get((sym[i], sym[i + 1]))
            if hit:
                heap.append((hit[0], i, hit[1]))
        heapq.heapify(heap)
        done = 0
        while heap:
            rank, i, joined = heapq.heappop(heap)
            if sym[i] is None or (j := nxt[i]) >= n:
                continue
            now = merges.get((sym[i], sym[j]))
            if now is None or now[0] != rank:
                continue  # stale: one of the two was merged meanwhile
            sym[i], sym[j] = joined, None
            done += 1
            k = nxt[i] = nxt[j]
            if k < n:
                prv[k] = i
                hit = merges.get((joined, sym[k]))
                if hit:
                    heapq.heappush(heap, (hit[0], i, hit[1]))
            h = prv[i]
            if h >= 0:
                hit = merges.get((sym[h], joined))
                if hit:
                    heapq.heappush(heap, (hit[0], h, hit[1]))
        return n - done

    def _plain(self, text: str) -> int:
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # lower-cased by character, without regard to its place in the word
            text = text.replace("Σ", "σ")
        memo, total = self.memo, 0
        for w in self.word.findall(text.lower()):
            n = memo.get(w)
            if n is None:
                n = self.word_tokens(w)
                if len(w) <= 64:
                    if len(memo) >= self.room:
                        memo.clear()
                    memo[w] = n
            total += n
        return total

    def count(self, text: str) -> int:
        if "<|" not in text:
            return self._plain(text)
        parts = self.special.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1


def _counter(path: str) -> WordCounter:
    if path not in _counters:
        _counters[path] = WordCounter(path)
    return _counters[path]


def count_batches(batches, path: str):
    c = _counter(path)
    for b in batches:
        texts = b.column("text").to_pylist()
        yield pa.RecordBatch.from_arrays([
            b.column("doc_id"),
            pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
            pa.array([c.count(t) for t in texts], pa.int64())],
            names=["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = OVER_LIMIT,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: bytes, tokens, and whether it has more than ``limit``.
    No shuffle: every task counts the texts it reads."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       text_or_empty(text_col).alias("text"))
    return (rows.mapInArrow(lambda bs: count_batches(bs, tokenizer_path), SCHEMA)
            .withColumn("over_limit", F.col("n_tokens") > F.lit(limit)))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_counts(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("word_bpe_49k.json"))
