"""Operator 5: near-duplicate documents by HyperMinHash.

A document's word shingles are hashed to 64 bits; the top 8 bits pick one of
256 buckets, and a bucket keeps the leading-zero count and 10 mantissa bits of
its least value: 16 bits that stand for a 56-bit minimum. Empty buckets borrow,
for banding only, from the first filled one of a fixed order. Seven registers
make a band; documents that share a band are candidates.

1. Texts with equal shingle sets form a class, which goes on as one, so copies
   never meet each other. Equal counts and hash sums of the sets name a class;
   each further text of it is checked once against the class's first text, set
   against set, and one that differs is a class of its own.
2. Each band bucket names its smallest id as hub; a member pairs with the
   smallest of its hubs, and with its others only where that has not joined
   them (a pair per member and bucket at most, however large the bucket).
3. The registers estimate the Jaccard index of a pair, corrected for chance
   collisions; pairs that cannot reach the threshold go. The rest are verified
   on the full sets of word tuples.
4. Buckets that still hold several components go on without their hub: their
   members are compared in blocks inside the tasks, by registers and then by
   sets of 32-bit hashes, so that pairs far below the threshold never become
   rows. A block first names a spanning forest of its close pairs; if components
   remain apart, it then names every close pair not yet verified. So no
   candidate pair between two components is left untested, and none inside a
   component needs a test.
5. Union-find over the verified links gives the components.

Defined results: null, empty or blank text -> no shingles, linked with nothing;
fewer words than a shingle -> the whole sequence is the one shingle; rows that
repeat an id are one document, linked by any of its texts (``n_shingles`` is the
row's own); a null id is never linked, has a null component and is kept
(``without_duplicates`` judges every row, with or without an id); an empty table gives
an empty result; extra columns are ignored.
"""
from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balances.llm.bpe_words import slices
from balances.llm.common import BROADCAST_IDS, dropped, kept, narrow, release, small, table, text_key, text_or_empty, written
from balances.llm.components import components

WORDS = 5
#: Link if 100 * intersection >= PERCENT * union.
PERCENT = 85
BUCKETS, MANTISSA = 256, 10
ROWS, BANDS = 7, 36
#: Standard deviations by which an estimate may miss the threshold.
MARGIN = 5.0
#: Documents of a bucket that one task compares with each other at a time.
BLOCK = 1024
#: Set elements that collisions of 32-bit hashes may hide or add in a pair.
SLACK = 2
#: Expected collisions of two independent registers, times 2^mantissa (fixed value).
COLLISION = 0.1699
SIGNATURE = "doc_id long, n long, hi long, lo long, registers binary, bands array<long>, text_key binary"

_U = np.uint64
_rng = np.random.default_rng(20240501)
#: Words are hashed by two polynomials modulo this prime.
PRIME = (1 << 31) - 1
_BASES = tuple(int(x) for x in _rng.integers(1 << 20, PRIME, 2))
_BYTES = _rng.integers(1, PRIME, (2, 256), dtype=np.uint64)
_PLACE = _rng.integers(1, 1 << 63, WORDS + 1, dtype=np.uint64) | _U(1)
_BAND = _rng.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | _U(1)
#: Order in which an empty bucket looks for a filled one.
_PROBE = np.stack([_rng.permutation(BUCKETS) for _ in range(BUCKETS)])
_P = 0x9E3779B97F4A7C15
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_BYTES[:, 65:91] = _BYTES[:, 97:123]  # A-Z count as a-z
_powers: dict = {}


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _power_table(base: int, n: int) -> np.ndarray:
    """Powers of ``base`` modulo ``PRIME``."""
    t = _powers.get(base)
    if t is None or len(t) < n:
        t, size = np.ones(1, np.uint64), 1
        while size < max(n, 1 << 16):
            t = np.concatenate((t, t * _U(pow(base, size, PRIME)) % _U(PRIME)))
            size *= 2
        if n <= 1 << 22:
            _powers[base] = t
    return t[:n]


def _word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of a buffer from two polynomials modulo a
    prime (modulo a power of two, long words of one pattern would agree)."""
    size = (ends - starts).astype(np.uint64)
    w = np.zeros(len(starts), np.uint64)
    for base, values in zip(_BASES, _BYTES):
        prefix = np.cumsum(values[buf] * _power_table(base, len(buf)) % _U(PRIME))
        part = (prefix[ends - 1] - prefix[starts - 1]) % _U(PRIME)
        w = (w << _U(31)) | part * _power_table(pow(base, -1, PRIME), len(buf))[starts] % _U(PRIME)
    return _mix(w ^ (size << _U(40)))


def shingle_hashes(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its word shingles."""
    raw = [t.encode("utf-8") for t in texts]
    buf = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
    inside = _IS_WORD[buf]
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = change[::2], change[1::2]
    w = _word_hashes(buf, starts, ends)
    doc_starts = np.cumsum([1] + [len(r) + 1 for r in raw])
    at = np.searchsorted(starts, doc_starts)
    n = len(w)
    full = np.zeros(max(0, n - words + 1), np.uint64)
    for k in range(words):
        full += w[k:n - words + 1 + k] * _PLACE[k] if n >= words else 0
    full = _mix(full)
    out = []
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= words:
            out.append(np.unique(full[a:b - words + 1]))
        elif b > a:  # the whole sequence, marked by its length
            h = (w[a:b] * _PLACE[:b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append(_mix(h + _PLACE[words:] * _U(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """HyperMinHash registers (texts x buckets): leading zeros + 1 above the
    mantissa bits; 0 where a bucket is empty. Hashes must be sorted."""
    least = np.zeros((len(sets), BUCKETS), np.uint64)
    filled = np.zeros((len(sets), BUCKETS), bool)
    for i, h in enumerate(sets):
        if len(h):
            bucket = (h >> _U(56)).astype(np.int64)
            first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            least[i, bucket[first]] = (h[first] << _U(8)) | _U(255)
            filled[i, bucket[first]] = True
    zeros = 64 - np.frexp((least >> _U(11)).astype(np.float64))[1] - 11
    zeros = np.clip(zeros, 0, 55).astype(np.uint64)
    mantissa = (least << (zeros + _U(1))) >> _U(64 - MANTISSA)
    reg = ((zeros + _U(1)) << _U(MANTISSA)) | mantissa
    return np.where(filled, reg, 0).astype(np.uint16)


def band_keys(reg: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of the densified registers."""
    full = reg.copy()
    for t in range(BUCKETS):
        empty = full == 0
        if not empty.any():
            break
        full = np.where(empty, reg[:, _PROBE[:, t]], full)
    full = full[:, :BANDS * ROWS].reshape(len(reg), BANDS, ROWS).astype(np.uint64)
    return _mix(_mix((full * _BAND).sum(axis=2, dtype=np.uint64)) + np.arange(BANDS, dtype=np.uint64))


def estimate(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray):
    """Collision-corrected Jaccard estimates of register rows and, for each,
    the number of registers it rests on."""
    used = ((x != 0) | (y != 0)).sum(axis=1)
    same = ((x == y) & (x != 0)).sum(axis=1)
    n, m = np.maximum(n, 1).astype(float), np.maximum(m, 1).astype(float)
    chance = COLLISION * 2.0 ** -MANTISSA * 4 * n * m / (n + m) ** 2 * used
    return np.maximum(0.0, same - chance) / np.maximum(1, used), used


def likely(x, y, n, m, percent: int = PERCENT) -> np.ndarray:
    """Pairs whose index may reach the threshold: by size, and by the estimate
    less its margin."""
    est, used = estimate(x, y, n, m)
    t = percent / 100.0
    slack = MARGIN * np.sqrt(t * (1 - t) / np.maximum(1, used))
    return (est >= t - slack) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))


def sign(batches):
    for b in small(batches):
        texts = b.column("text").to_pylist()
        for i, j in slices(texts, 400_000):
            sets = shingle_hashes(texts[i:j])
            reg = registers(sets)
            keys = band_keys(reg).astype(np.uint64).view(np.int64)
            n = np.array([len(s) for s in sets], np.int64)
            hi = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            lo = np.array([np.bitwise_xor.reduce(_mix(s ^ _U(_P))) if len(s) else 0 for s in sets],
                          np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id")[i:j], pa.array(n), pa.array(hi), pa.array(lo),
                 pa.array([r.tobytes() for r in reg], pa.binary()),
                 pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), BANDS).cast(pa.list_(pa.int64())),
                 pa.array([hashlib.md5(t.encode()).digest() for t in texts[i:j]], pa.binary())],
                names=["doc_id", "n", "hi", "lo", "registers", "bands", "text_key"])


def _reg(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BUCKETS)


def keep_likely(percent: int):
    def run(batches):
        for b in batches:
            if b.num_rows:
                ok = likely(_reg(b.column("ra")), _reg(b.column("rb")), np.asarray(b.column("na")),
                            np.asarray(b.column("nb")), percent)
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(ok))
    return run


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_set(text: str, words: int = WORDS) -> frozenset:
    """The exact set of word tuples."""
    w = _WORD.findall(text.encode("utf-8").translate(_LOWER))
    if len(w) < words:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(zip(*(w[k:] for k in range(words))))


def linked(x: frozenset, y: frozenset, percent: int = PERCENT) -> bool:
    both = len(x & y)
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def verify(percent: int, words: int):
    """Exact check of (a, b, ta, tb) rows; sets of the last texts are kept, as
    rows of one hub follow each other."""
    def run(batches):
        last: dict = {}
        for b in small(batches):
            ok = []
            for x, y in zip(b.column("ta").to_pylist(), b.column("tb").to_pylist()):
                for t in (x, y):
                    if t not in last:
                        if len(last) >= 8:
                            last.pop(next(iter(last)))
                        last[t] = shingle_set(t, words)
                ok.append(linked(last.get(x) or shingle_set(x, words), last.get(y) or shingle_set(y, words), percent))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(ok, pa.bool_())],
                                             names=["a", "b", "linked"])
    return run


def _runs(batches):
    """Rows of whole runs (same key and block pair), which arrive sorted."""
    import pandas as pd
    rest = None
    for b in batches:
        d = b.to_pandas()
        d = pd.concat([rest, d]) if rest is not None else d
        if not len(d):
            continue
        run = (d["key"].values, d["i"].values, d["j"].values)
        cut = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in run])) + 1
        if len(cut):
            yield d.iloc[:cut[-1]], np.r_[0, cut[:-1], cut[-1]]
            rest = d.iloc[cut[-1]:]
        else:
            rest = d
    if rest is not None and len(rest):
        yield rest, np.array([0, len(rest)])


def open_sets(batches):
    """rep, n, registers and the set as sorted 32-bit hashes, for block tasks."""
    for b in small(batches):
        texts = b.column("text").to_pylist()
        for i, j in slices(texts, 400_000):
            sets = shingle_hashes(texts[i:j])
            yield pa.RecordBatch.from_arrays(
                [b.column("rep")[i:j], pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([r.tobytes() for r in registers(sets)], pa.binary()),
                 pa.array([np.unique((s >> _U(20)).astype(np.uint32)).tobytes() for s in sets], pa.binary())],
                names=["rep", "n", "registers", "shingles"])


def _close(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets of 32-bit hashes may reach the threshold, allowing for
    a few collisions among the hashes."""
    both = len(np.intersect1d(x, y, assume_unique=True)) + SLACK
    return 100 * both >= percent * (len(x) + len(y) - both)


def block_pairs(percent: int, forest: bool):
    """Close pairs of different components within each block pair. With
    ``forest`` a found pair joins its components there and then, so a block
    names fewer pairs than it has members."""
    def run(batches):
        for d, at in _runs(batches):
            reg = np.frombuffer(b"".join(d["registers"]), np.uint16).reshape(-1, BUCKETS)
            sets = [np.frombuffer(v, np.uint32) for v in d["shingles"]]
            n, comp, rep = d["n"].values, d["component"].values.copy(), d["rep"].values
            side, cross = d["side"].values, (d["i"] != d["j"]).values
            a_out, b_out = [], []
            for s, e in zip(at[:-1], at[1:]):
                for x in range(s, e):
                    if cross[x] and side[x]:
                        continue
                    ys = np.arange(s, e)[side[s:e] == 1] if cross[x] else np.arange(x + 1, e)
                    ys = ys[comp[ys] != comp[x]]
                    if not len(ys):
                        continue
                    xs = np.full(len(ys), x)
                    for y in ys[likely(reg[xs], reg[ys], n[xs], n[ys], percent)]:
                        if comp[x] != comp[y] and _close(sets[x], sets[y], percent):
                            a_out.append(min(rep[x], rep[y]))
                            b_out.append(max(rep[x], rep[y]))
                            if forest:
                                part = comp[s:e]
                                part[part == comp[y]] = comp[x]
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())],
                                             names=["a", "b"])
    return run


def same_sets(batches):
    """Exact check that two texts of one class have one set: (n, hi, lo,
    text_key, same) of each further text."""
    for b in small(batches):
        same = [shingle_set(x) == shingle_set(y) for x, y in zip(b.column("first_text").to_pylist(), b.column("text").to_pylist())]
        yield b.select(["n", "hi", "lo", "text_key"]).append_column("same", pa.array(same, pa.bool_()))


_CLASS = ["n", "hi", "lo"]


def classes_of(rows: DataFrame, linkable: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes of texts with equal sets, checked: (rep, rep_doc, text_key, n,
    hi, lo), where ``rep`` is the class's number and the rest its first text,
    and ``odd`` (n, hi, lo, text_key, rep): the texts that only their sums put
    beside others."""
    texts = narrow(linkable.groupBy(*_CLASS, "text_key").agg(F.min("doc_id").alias("doc")), "class-texts")
    first = texts.groupBy(*_CLASS).agg(F.min(F.xxhash64("text_key")).alias("least"), F.count(F.lit(1)).alias("size"))
    firsts = texts.join(first, _CLASS).where(F.xxhash64("text_key") == F.col("least"))
    firsts = narrow(firsts.groupBy(*_CLASS).agg(F.min("text_key").alias("text_key"), F.max("size").alias("size")), "firsts")
    # every further text beside the first one of its class
    further = texts.join(firsts.where("size > 1").select(*_CLASS, F.col("text_key").alias("first_key")), _CLASS).where("text_key <> first_key")
    further = narrow(further.select(*_CLASS, "text_key", "first_key"), "further")
    wanted = further.select("text_key").union(further.select("first_key")).distinct()
    wanted = written(wanted, "class-keys")
    read = rows.select(text_key().alias("text_key"), "text").join(
        F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted, "text_key", "left_semi").distinct()
    read = kept(read)
    pairs = further.join(read, "text_key").join(read.select(F.col("text_key").alias("first_key"), F.col("text").alias("first_text")), "first_key")
    odd = written(pairs.mapInArrow(same_sets, "n long, hi long, lo long, text_key binary, same boolean").where("NOT same").drop("same"), "odd")
    dropped(wanted, read, further)
    named = firsts.select(*_CLASS, "text_key").union(odd.select(*_CLASS, "text_key"))
    named = named.join(texts, [*_CLASS, "text_key"]).select(F.col("doc").alias("rep_doc"), "text_key", *_CLASS)
    classes = narrow(named.withColumn("rep", F.monotonically_increasing_id()), "classes")
    dropped(firsts, texts)
    odd_named = classes.join(odd, [*_CLASS, "text_key"]).select(*_CLASS, "text_key", "rep")
    return classes, odd_named


def classed(signed: DataFrame, classes: DataFrame, odd: DataFrame) -> DataFrame:
    """``signed`` with the class of each row's text as ``rep``."""
    plain = classes.join(odd.select("rep"), "rep", "left_anti").select(*_CLASS, "rep")
    out = signed.join(plain, _CLASS)
    if odd.isEmpty():
        return out
    odd = F.broadcast(odd) if odd.count() <= BROADCAST_IDS else odd
    return out.join(odd.withColumnRenamed("rep", "odd_rep"), [*_CLASS, "text_key"], "left").withColumn(
        "rep", F.coalesce("odd_rep", "rep")).drop("odd_rep")


def _linked_classes(rows: DataFrame, signed: DataFrame, linkable: DataFrame, percent: int, by_text: bool):
    """(classes, odd, components of classes): everything up to union-find.
    Unless ``by_text``, the classes of one doc_id are linked."""
    classes, odd = classes_of(rows, linkable)
    n_classes = classes.count()
    of_rep = classes.select("rep", F.col("rep_doc").alias("doc_id"), "text_key")
    # one signature per class, by its first text
    mine = linkable.select("doc_id", F.col("text_key").alias("key_"), "n", "registers", "bands")
    reps = mine.join(of_rep, mine["doc_id"].eqNullSafe(of_rep["doc_id"]) & (F.col("key_") == F.col("text_key")))
    reps = kept(reps.select("rep", "n", "registers", "bands").dropDuplicates(["rep"]))
    member = reps.select("rep", F.explode("bands").alias("key"))
    buckets = member.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("hub"))
    shared = narrow(member.join(buckets.where("size > 1"), "key"), "buckets")
    regs = reps.select("rep", "n", "registers")
    tested, links = [], []
    if not by_text:
        own = classed(linkable.select("doc_id", *_CLASS, "text_key"), classes, odd).groupBy("doc_id").agg(
            F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b")
        several = classed(linkable.select("doc_id", *_CLASS, "text_key"), classes, odd).join(own.select("doc_id", "a"), "doc_id")
        links.append(narrow(several.where("rep <> a").select("a", F.col("rep").alias("b")).distinct(), "one-id"))

    def texts_of(ends):
        """(rep, text): the first text of each class among ``ends``."""
        keys = of_rep.join(ends, "rep", "left_semi").select("rep", "text_key")
        keys = F.broadcast(keys) if n_classes <= BROADCAST_IDS else keys
        return rows.select(text_key().alias("text_key"), "text").join(keys, "text_key").select("rep", "text").dropDuplicates(["rep"])

    def settle(pairs):
        """Estimate and verify new pairs; returns the written verdicts."""
        with_a = pairs.join(regs.select(F.col("rep").alias("a"), F.col("n").alias("na"),
                                        F.col("registers").alias("ra")), "a")
        with_b = with_a.join(regs.select(F.col("rep").alias("b"), F.col("n").alias("nb"),
                                         F.col("registers").alias("rb")), "b")
        maybe = narrow(with_b.mapInArrow(keep_likely(percent), "a long, b long").distinct(), "likely")
        texts = kept(texts_of(maybe.select(F.col("a").alias("rep")).union(maybe.select("b")).distinct()))
        full = (maybe.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("tb")), "b")
                .join(texts.select(F.col("rep").alias("a"), F.col("text").alias("ta")), "a")
                .select("a", "b", "ta", "tb"))
        verdict = narrow(full.mapInArrow(verify(percent, WORDS), "a long, b long, linked boolean"), "verdicts")
        dropped(maybe, texts)
        release(rows.sparkSession)
        tested.append(verdict)
        links.append(verdict.where("linked").select("a", "b"))

    def union(frames):
        out = frames[0].select("a", "b")
        for f in frames[1:]:
            out = out.union(f.select("a", "b"))
        return out

    # first each member with the smallest of its hubs, then, across what that left apart, with the others
    member_hub = shared.where("rep <> hub")
    settle(member_hub.groupBy(F.col("rep").alias("b")).agg(F.min("hub").alias("a")).select("a", "b"))
    comp = components(union(links))
    top = comp.select(F.col("id").alias("hub"), F.col("component").alias("hub_top"))
    rest = (member_hub.select("rep", "hub").distinct().join(comp.withColumnRenamed("id", "rep"), "rep", "left")
            .join(top, "hub", "left").where(~F.coalesce("component", "rep").eqNullSafe(F.coalesce("hub_top", "hub"))))
    settle(rest.select(F.col("hub").alias("a"), F.col("rep").alias("b")).join(tested[0].select("a", "b"), ["a", "b"], "left_anti"))
    dropped(comp)
    comp = components(union(links))
    # buckets without their hub that still hold several components
    others = shared.where("rep <> hub AND size > 2").select("key", "rep")
    for forest in (True, False):
        placed = others.join(comp.withColumnRenamed("id", "rep"), "rep", "left").select(
            "key", "rep", F.coalesce("component", "rep").alias("component"))
        apart = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                          F.count(F.lit(1)).alias("left")).where("lo <> hi")
        open_rows = narrow(placed.join(apart.select("key", "left"), "key"), "open")
        if open_rows.isEmpty():
            dropped(open_rows)
            break
        sets = kept(texts_of(open_rows.select("rep").distinct()).mapInArrow(
            open_sets, "rep long, n long, registers binary, shingles binary"))
        pairs = _blocks(open_rows, sets).mapInArrow(block_pairs(percent, forest), "a long, b long").distinct()
        settle(pairs.join(union(tested).distinct(), ["a", "b"], "left_anti"))
        dropped(sets, open_rows, comp)
        comp = components(union(links))
    dropped(reps, shared, *tested, *([] if by_text else links[:1]))
    return classes, odd, comp


def near_duplicates(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    signed = kept(rows.mapInArrow(sign, SIGNATURE))
    linkable = signed.where("n > 0 AND doc_id IS NOT NULL")
    classes, odd, comp = _linked_classes(rows, signed, linkable, percent, False)
    found = classed(linkable.select("doc_id", *_CLASS, "text_key"), classes, odd).join(
        comp.withColumnRenamed("id", "rep"), "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("component"))
    # the smallest id of each component, from one row per document and component
    found = found.distinct()
    least = found.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    found = written(found.join(least, "component").select("doc_id", "component_id").distinct(), "found")
    out = signed.select("doc_id", F.col("n").alias("n_shingles")).join(found, "doc_id", "left")
    own = F.coalesce("component_id", "doc_id")
    out = out.select("doc_id", "n_shingles", own.alias("component_id"),
                     F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))
    out = written(out, "near-duplicates")
    dropped(signed, classes, comp, found)
    return out


def without_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with one row of each group
    of near duplicates, the one with the smallest id. Rows are judged one by
    one, whatever id they share; rows without an id come last, and of rows with
    one id and one text, which are alike, one stays. Texts without words stay."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    signed = kept(rows.mapInArrow(sign, SIGNATURE))
    linkable = signed.where("n > 0")
    classes, odd, comp = _linked_classes(rows, signed, linkable, percent, True)
    alike = classed(linkable.select("doc_id", *_CLASS, "text_key"), classes, odd).groupBy("rep", "doc_id", "text_key").count()
    alike = written(alike.join(comp.withColumnRenamed("id", "rep"), "rep", "left").select(
        F.coalesce("component", "rep").alias("component"), "doc_id", "text_key", "count",
        F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("place"), F.xxhash64("text_key").alias("tie")), "near-rows")
    least = alike.groupBy("component").agg(F.min("place").alias("place"))
    first = alike.join(least, ["component", "place"]).groupBy("component", "place").agg(F.min("tie").alias("tie"))
    judged = alike.join(first.toDF("component", "first_place", "first_tie"), "component")
    stays = (F.col("place") == F.col("first_place")) & (F.col("tie") == F.col("first_tie"))
    judged = written(judged.where(~stays | (F.col("count") > 1)).select(
        F.col("doc_id").alias("_near_doc"), F.col("text_key").alias("_near_key"), stays.alias("_near_stays")), "near-judged")
    dropped(signed, classes, comp, alike)
    mine = F.broadcast(judged) if judged.count() <= BROADCAST_IDS else judged
    out = docs.join(mine, docs["doc_id"].cast("long").eqNullSafe(mine["_near_doc"]) & (text_key() == mine["_near_key"]), "left")
    single = out.where("_near_stays IS NULL").select(*[docs[c] for c in docs.columns])
    if judged.where("_near_stays").isEmpty():
        return single
    several = out.where("_near_stays").dropDuplicates(["_near_doc", "_near_key"]).select(*[docs[c] for c in docs.columns])
    return single.union(several)


def _blocks(open_rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Deal the members of each open bucket into block pairs of bounded size,
    sorted so that a task reads one block pair after another."""
    chunks = F.ceil(F.col("left") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    rows = open_rows.withColumn("chunks", chunks).withColumn("own", own).join(sets, "rep")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("key", "rep", "component", "n", "registers", "shingles",
                       F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                       (F.col("own") > F.col("other")).cast("int").alias("side"))
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side", "rep")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
