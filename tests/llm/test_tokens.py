"""Operators 2, 3 and 4 against the tokenizers library."""
import hashlib
import random
import zlib

import numpy as np
import pytest

from llm_helpers import AWKWARD, frame, prose

P = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from balances.llm import bpe_words, chunk_bpe, token_records, word_tokens  # noqa: E402

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
PIECES = ["'s", "'ll", "'", "l", "s", "  ", " ", "\n", "\t", "é", "日本", "1", "٣", "!", "...", "<|endoftext|>", "<|",
          "word", " word", " the", "\x1c", "\x85", "　", "😀", "​", "Ab", "Σ", "İ", "é", "<|startoftext|>"]


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def noise(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 120))) for _ in range(n)]


@pytest.mark.parametrize("mean", [2, 16, 64])
def test_chunk_joins_are_exact(mean):
    lib, coder = Tokenizer.from_file(BYTE), chunk_bpe.ChunkCoder(BYTE, mean=mean, memo_chunks=40)
    for text in noise(mean, 300):
        raw = coder.encode(text)
        assert np.frombuffer(raw, "<u4").tolist() == ids(lib, text)
        assert coder.decode(raw) == lib.decode(ids(lib, text), skip_special_tokens=False)


def test_word_memo_is_exact_and_bounded():
    lib, coder = Tokenizer.from_file(BYTE), bpe_words.BatchEncoder(BYTE, "<u2", table_words=300)
    texts = noise(5, 300) + ["trailing ", " leading", "two  spaces", "line \n break", "word\n word"]
    for i in range(0, len(texts), 20):
        got = coder.encode_many(texts[i:i + 20])
        assert [np.frombuffer(g, "<u2").tolist() for g in got] == [ids(lib, t) for t in texts[i:i + 20]]


def test_pretokens_of_one_hash():
    """Two words that a polynomial hash modulo a power of two confuses, in one batch and one after the other."""
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    lib = Tokenizer.from_file(BYTE)
    for batches in ([[a, b, f"x {b} {a}<|endoftext|>{b}", "plain"]], [[a], [b], ["other", b + " " + a]]):
        coder = bpe_words.BatchEncoder(BYTE, "<u2")
        for texts in batches:
            assert [np.frombuffer(r, "<u2").tolist() for r in coder.encode_many(texts)] == [ids(lib, t) for t in texts]


def test_chunks_are_content_defined():
    shared = prose(random.Random(1), 600)
    a = {c for c in _chunks("start one " + shared)}
    b = {c for c in _chunks("another longer beginning " + shared)}
    assert len(a & b) >= len(a) - 2


def _chunks(text):
    at = [0, *chunk_bpe.cut_points(text), len(text)]
    return [text[i:j] for i, j in zip(at, at[1:])]


def test_token_counts(spark):
    lib = Tokenizer.from_file(WORD)
    rows = AWKWARD + [(100 + i, t) for i, t in enumerate(noise(9, 60))]
    got = word_tokens.token_counts(frame(spark, rows), WORD).collect()
    want = sorted((str(i), len((t or "").encode()), len(ids(lib, t)), len(ids(lib, t)) > 2048) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    assert word_tokens.token_counts(frame(spark, []), WORD).collect() == []


def test_round_trip_query(spark):
    lib = Tokenizer.from_file(BYTE)
    got = chunk_bpe.encode_digests(frame(spark, AWKWARD), BYTE).collect()

    def row(i, t):
        raw = np.array(ids(lib, t), "<u4").tobytes()
        return str(i), len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(
        row(i, t) for i, t in AWKWARD)
    assert chunk_bpe.encode_digests(frame(spark, []), BYTE).collect() == []
    full = chunk_bpe.encode_texts(frame(spark, AWKWARD), BYTE).collect()
    assert sorted(r.decoded for r in full) == sorted(t or "" for _, t in AWKWARD)


def test_records(spark, tmp_path):
    lib = Tokenizer.from_file(BYTE)
    rows = AWKWARD + [(20 + i, t) for i, t in enumerate(noise(3, 50))]
    shards = token_records.write_records(frame(spark, rows).repartition(3), f"file://{tmp_path}/r", BYTE)
    got = token_records.read_digests(spark, shards).collect()
    want, start = {}, 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        n = len(ids(lib, t)) + 1
        crc = zlib.crc32(np.array(ids(lib, t) + [2], "<u4").tobytes())
        want.setdefault(i, []).append((start, n, crc))
        start += n
    assert len(got) == len(rows)
    for r in got:
        mine = want[r.doc_id]
        if len(mine) == 1:
            assert (r.start, r.n_tokens, r.ids_crc32) == mine[0]
        else:
            assert (r.n_tokens, r.ids_crc32) in {m[1:] for m in mine}
    # shuffled reads by the index, and damage is seen
    path = shards[-1][0]
    entries = token_records.read_index(path)
    for k in reversed(range(len(entries))):
        doc, values = token_records.read_record(path, entries[k])
        assert len(values) == entries[k]["n_ids"] and values[-1] == 2
    file = path.removeprefix("file://") + ".records"
    raw = bytearray(open(file, "rb").read())
    raw[-6] ^= 1
    open(file, "wb").write(raw)
    with pytest.raises(ValueError):
        token_records.read_record(path, entries[-1])
    assert token_records.read_digests(spark, token_records.write_records(
        frame(spark, []), f"file://{tmp_path}/e", BYTE)).collect() == []
