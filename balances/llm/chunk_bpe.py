"""Operator 2: BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the last 16 characters cuts a text into chunks, so equal
passages give equal chunks wherever they stand. A worker encodes each distinct
chunk once and keeps it (bounded) for all documents it meets. A chunk's edges
may split a pre-token; the join of two chunks is repaired by re-encoding a
window around it, widened until its pre-token boundaries agree exactly with the
right chunk's own ones. What lies left of the window's start and right of the
agreement is then what one pass over the whole text gives: the scanner has no
memory, and an end of text can only change the last two pre-tokens before it.

Decoding looks up each id's bytes, joins them and reads UTF-8.

Defined results: null or empty text -> no ids, empty text; strings of special
tokens become those ids; lone surrogates cannot occur in Arrow strings;
repeated rows give one row each; extra columns are ignored.
"""
from __future__ import annotations

import hashlib
from itertools import accumulate

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balances.llm.bpe_words import WordEncoder, slices
from balances.llm.common import table, text_or_empty
from balances.llm.word_tokens import byte_symbols

#: Mean characters of a chunk (a power of two).
CHUNK = 512
#: Chunks remembered per Python worker (about 8 kB each).
MEMO_CHUNKS = 16_000
#: Pre-tokens at a chunk's end that more text may still change.
UNSETTLED = 3
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

_coders: dict = {}


def cut_points(text: str, mean: int = CHUNK) -> list[int]:
    """Character positions after which the rolling hash of the last 16
    characters is 0 modulo ``mean``."""
    if len(text) <= 16:
        return []
    h = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    h *= np.uint64(0x9E3779B97F4A7C15)
    factor = 0xD6E8FEB86659FD93
    width = 1
    while width < 16:  # hash of a window twice as wide from two halves
        wide = h.copy()
        wide[width:] += h[:-width] * np.uint64(factor)
        h, width, factor = wide, width * 2, factor * factor % (1 << 64)
    at = np.flatnonzero((h[15:-1] >> np.uint64(40)) % np.uint64(mean) == 0) + 16
    return at.tolist()


class ChunkCoder:
    def __init__(self, path: str, memo_chunks: int = MEMO_CHUNKS, mean: int = CHUNK):
        self.coder = WordEncoder(path, "<u4")
        self.memo: dict[str, tuple[list, list]] = {}
        self.room, self.mean = memo_chunks, mean
        stand_in = {c: b for b, c in enumerate(byte_symbols())}
        vocab = self.coder.library.get_vocab(with_added_tokens=True)
        self.bytes_of = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(stand_in[c] for c in token)

    def chunks(self, texts: list[str]) -> dict[str, tuple[list, list]]:
        """Each distinct chunk -> its pre-tokens by itself and their id bytes.
        Only chunks not met before are encoded, all of them at once."""
        new = {t: self.coder.words(t) for t in set(texts) if t not in self.memo}
        if len(self.memo) + len(new) > self.room:
            known = {t: self.memo[t] for t in set(texts) if t in self.memo}
            self.memo = known
        memo = self.coder.learn(set().union(*new.values()))
        for t, words in new.items():
            self.memo[t] = words, [memo[w] for w in words]
        return self.memo

    def _join(self, chunks: list[tuple[list, list]]) -> bytes:
        """Concatenate the chunks of one text, repairing every join."""
        words: list[str] = []
        ids: list[bytes] = []
        for right, right_ids in chunks:
            if not words:
                words, ids = list(right), list(right_ids)
                continue
            tail = "".join(words[-UNSETTLED:])
            del words[-UNSETTLED:], ids[-UNSETTLED:]
            seen = 6
            while True:  # widen the window until it agrees with the right chunk
                head = right[:seen]
                window = self.coder.words(tail + "".join(head))
                if seen >= len(right):  # the window reaches the chunk's end, as does its own scan
                    take, rest = len(window), len(right)
                    break
                ends = list(accumulate(map(len, window), initial=0))
                own = {e: j for j, e in enumerate(accumulate(map(len, head), initial=len(tail)))}
                take = next((k for k in range(len(window) - UNSETTLED + 1) if ends[k] in own), None)
                if take is not None:
                    rest = own[ends[take]]
                    break
                seen *= 2
            window = window[:take]
            memo = self.coder.memo
            try:
                ids += [memo[w] for w in window]
            except KeyError:
                memo = self.coder.learn(window)
                ids += [memo[w] for w in window]
            words += window
            words += right[rest:]
            ids += right_ids[rest:]
        return b"".join(ids)

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        plan, seen = [], []
        for text in texts:
            parts = []
            for part, special in self.coder.parts(text):
                if special:
                    parts.append(self.coder.special[part])
                else:
                    at = [0, *cut_points(part, self.mean), len(part)]
                    pieces = [part[a:b] for a, b in zip(at, at[1:]) if a < b]
                    seen += pieces
                    parts.append(pieces)
            plan.append(parts)
        memo = self.chunks(seen)
        return [b"".join(x if isinstance(x, bytes) else self._join([memo[c] for c in x]) for x in parts)
                for parts in plan]

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def decode(self, ids: bytes) -> str:
        """The text of ids; broken UTF-8 gives replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode(
            "utf-8", "replace")


def coder(path: str) -> ChunkCoder:
    if path not in _coders:
        _coders[path] = ChunkCoder(path)
    return _coders[path]


def encode_texts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int), decoded text: the operator's own output."""
    def run(batches):
        c = coder(tokenizer_path)
        for b in batches:
            texts, keys = b.column("text").to_pylist(), b.column("doc_id")
            for i, j in slices(texts):
                raw = c.encode_many(texts[i:j])
                yield pa.RecordBatch.from_arrays(
                    [keys[i:j], pa.array([np.frombuffer(r, "<i4") for r in raw], pa.list_(pa.int32())),
                     pa.array([c.decode(r) for r in raw], pa.string())], names=["doc_id", "ids", "decoded"])
    return _rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """As ``encode_texts``, with digests in place of ids and text."""
    def run(batches):
        c = coder(tokenizer_path)
        for b in batches:
            out, texts = [], b.column("text").to_pylist()
            for i, j in slices(texts):
                for raw in c.encode_many(texts[i:j]):
                    back = c.decode(raw).encode("utf-8")
                    out.append((len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256(back).hexdigest()))
            n, a, d = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()),
                 pa.array(d, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return _rows(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def _rows(docs, id_col, text_col):
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       text_or_empty(text_col).alias("text"))


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return encode_digests(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_50k.json"))
