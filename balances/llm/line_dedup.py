"""Operator 10: fuzzy line dedup by MinHash.

Lines are trimmed; blank lines are left alone. Equal lines are one node (the
md5 of the line). Lines whose character 5-gram sets have a Jaccard index of at
least 0.8 are linked; every component keeps its first line (by doc_id, then
position) and loses the others.

Splitting, joining, banding and union-find are DataFrame operations; signatures
and the Jaccard index are numpy over Arrow batches, since as column expressions
they take several times the CPU seconds that the operator may use (README).

Signatures. Every line hashes the 5-grams that are verified; a MinHash is the
least product of a gram's hash and a fixed odd number. ``ROWS`` of them make a
band; a pair at the threshold shares one of the ``BANDS`` bands with a
probability of 0.99 or more. A byte of each MinHash is the line's sketch.

Candidates. Buckets with two lines or more name a hub. A member first meets the
smallest of its hubs, and the others only where that has left them apart. A
pair goes on if set sizes allow the threshold and the sketches do within
``MARGIN`` standard deviations; the Jaccard index of the full sets decides.
Members of buckets that still hold several components are then compared in
blocks of bounded size inside the tasks: first by size and sketch, which leaves
the members that may link with another component, then those by their texts. The
tasks return a spanning forest of the links they verify. So no candidate pair
between two components is left out, pairs below the threshold never become rows
there, and texts go to the blocks of such members only.

Result: one row per document: doc_id, n_lines (lines that are not blank),
n_kept, dropped (positions of the lines that go, ascending, from 0).

Defined results: null or empty texts have no lines; documents that share an id
are one row, their equal positions being equally first; documents without an id
come after all others and are one row per text; an empty table gives an empty
result; extra columns are ignored; lines of fewer than ``LEAST`` characters have
no 5-gram and are linked with equal lines only.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balances.llm.bpe_words import slices
from balances.llm.common import dropped, narrow, release, small, table, text_key, written
from balances.llm.components import components

#: What is trimmed off a line's ends.
BLANKS = " \t\r\f\x0b\x00"
GRAM = 5
LEAST = GRAM
ROWS, BANDS = 4, 10
#: Standard deviations by which a sketch may miss the threshold.
MARGIN = 5.0
#: Keys or ids that go to every task at once; beyond it both sides shuffle.
BROADCAST_KEYS = 1_000_000
#: Jaccard threshold as a fraction.
NUM, DEN = 4, 5
#: Bands whose buckets are sought at a time.
AT_ONCE = 5
#: Members of a bucket that one task compares with each other at a time.
BLOCK = 1024
#: Pairs of a block whose sketches are compared at a time.
PAIRS = 100_000
#: Lines a task remembers as signed.
MEMO_LINES = 200_000
#: Set elements that collisions of 40-bit hashes may hide or add in a pair.
SLACK = 2

_U = np.uint64
_rng = np.random.default_rng(1709)
_PLACE = _rng.integers(1, 1 << 63, GRAM, dtype=np.uint64) | _U(1)
_BAND = _rng.integers(1, 1 << 63, 16, dtype=np.uint64) | _U(1)
_FACTORS = (_rng.integers(1, 1 << 32, 1024, dtype=np.uint64) | _U(1)).astype(np.uint32)


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the key of the row, pos, line: trimmed lines that are not blank."""
    parts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("row"),
                        F.split(F.col(text_col), "\n").alias("parts"))
    rows = parts.select("doc_id", "row", F.posexplode_outer("parts").alias("pos", "line"))
    return rows.select("doc_id", "row", "pos", trimmed(F.col("line")).alias("line")).where("line <> ''")


def trimmed(line):
    """``line`` without blanks at its ends; ``btrim`` walks through all characters
    of a line, so that only lines that begin or end with a blank take it."""
    edge = F.lit(False)
    for blank in BLANKS:
        edge = edge | line.startswith(F.lit(blank)) | line.endswith(F.lit(blank))
    return F.when(edge, F.btrim(line, F.lit(BLANKS))).otherwise(line)


def line_id(col: str = "line"):
    return F.unhex(F.md5(F.col(col)))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(29))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(32))


def gram_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all 5-grams, line after line, and how many each line has
    (a line of fewer characters is its own only gram)."""
    size = np.array([max(len(x), GRAM) for x in lines], np.int64)
    c = np.frombuffer("".join(x.ljust(GRAM, "\0") for x in lines).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    h = np.zeros(max(0, len(c) - GRAM + 1), np.uint64)
    for k in range(GRAM):
        h += (c[k:k + len(h)] + _U(1)) * _PLACE[k]
    n = size - GRAM + 1
    inside = np.ones(len(c), bool)
    ends = np.cumsum(size)
    for k in range(1, GRAM):
        inside[ends - k] = False
    return _mix(h[inside[:len(h)]]), n


def gram_sets(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct 40-bit hashes of each line, ascending, and how many."""
    line = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    key = (line << _U(40)) | (h >> _U(24))
    key.sort()
    key = key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key
    return key & _U((1 << 40) - 1), np.bincount((key >> _U(40)).astype(np.int64), minlength=len(n))


def signatures(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per line the size of its set, a key per band, and its sketch."""
    h, n = gram_hashes(lines)
    short, at = (h >> _U(32)).astype(np.uint32), np.cumsum(n) - n
    least = np.empty((len(lines), BANDS * ROWS), np.uint32)
    for k in range(BANDS * ROWS):
        least[:, k] = np.minimum.reduceat(short * _FACTORS[k], at)
    sketch = (least >> np.uint32(8)).astype(np.uint8)
    band = (least.reshape(len(lines), BANDS, ROWS).astype(np.uint64) * _BAND[:ROWS]).sum(axis=2, dtype=np.uint64)
    keys = _mix(_mix(band) + np.arange(BANDS, dtype=np.uint64))
    return gram_sets(h, n)[1], keys.view(np.int64), sketch


def _sign(own: list[str]):
    """Rows of lines -> the same without the text, with set size, band keys and
    sketch where a task meets a line for the first time."""
    def run(batches):
        seen: set = set()
        for b in small(batches, 2048):
            lines, ids = b.column("line").to_pylist(), b.column("id").to_pylist()
            new = []
            for i, (x, key) in enumerate(zip(lines, ids)):
                if len(x) >= LEAST and key not in seen:
                    if len(seen) >= MEMO_LINES:
                        seen.clear()
                    seen.add(key)
                    new.append(i)
            n, keys, sketches = [None] * len(lines), [None] * len(lines), [None] * len(lines)
            for s, e in slices([lines[i] for i in new], 200_000):
                size, key, sketch = signatures([lines[i] for i in new[s:e]])
                for j, i in enumerate(new[s:e]):
                    n[i], keys[i], sketches[i] = int(size[j]), key[j], sketch[j].tobytes()
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in own], b.column("pos"), b.column("id"), pa.array(n, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                names=[*own, "pos", "id", "n", "keys", "sketch"])
    return run


def first_met(batches):
    """(id, line) rows without those a task has met lately, so that a line which
    many rows share goes through a shuffle about once a task."""
    seen: set = set()
    for b in small(batches, 2048):
        new = []
        for i, key in enumerate(b.column("id").to_pylist()):
            if key not in seen:
                if len(seen) >= MEMO_LINES:
                    seen.clear()
                seen.add(key)
                new.append(i)
        yield b.take(pa.array(new, pa.int64()))


def _fits(na, nb):
    """Set sizes that allow the threshold."""
    return np.minimum(na, nb) * DEN >= np.maximum(na, nb) * NUM


def _alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sketches (rows of bytes) that allow the threshold."""
    t = NUM / DEN
    least = x.shape[-1] * t - MARGIN * np.sqrt(x.shape[-1] * t * (1 - t))
    return (x == y).sum(axis=-1) >= least


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def keep_alike(batches):
    for b in batches:
        if b.num_rows:
            ok = _fits(b.column("na").to_numpy(), b.column("nb").to_numpy()) & _alike(_sketches(b.column("sa")), _sketches(b.column("sb")))
            yield b.select(["a", "b"]).filter(pa.array(ok))


def gram_set(line: str) -> set:
    """The exact set of 5-grams."""
    return {line[i:i + GRAM] for i in range(len(line) - GRAM + 1)} or {line}


def _reaches(both, na, nb):
    """both / union >= NUM / DEN, without a division."""
    return both * (DEN + NUM) >= (na + nb) * NUM


def linked(la: list[str], lb: list[str]) -> np.ndarray:
    """Pairs of lines at or above the threshold. Common elements are counted by
    one sort over all pairs; what collisions could decide is counted again on
    the sets themselves."""
    place: dict = {}
    for x in (*la, *lb):
        place.setdefault(x, len(place))
    h, n = gram_sets(*gram_hashes(list(place)))
    at = np.cumsum(n) - n
    ia, ib = (np.array([place[x] for x in side], np.int64) for side in (la, lb))
    both_sides, pair = np.concatenate((ia, ib)), np.tile(np.arange(len(ia), dtype=np.uint64), 2)
    size = n[both_sides]
    upto = np.cumsum(size)
    take = np.repeat(at[both_sides] - (upto - size), size) + np.arange(upto[-1])
    key = (np.repeat(pair, size) << _U(40)) | h[take]
    key.sort()
    both = np.bincount((key[1:][key[1:] == key[:-1]] >> _U(40)).astype(np.int64), minlength=len(ia))
    ok = _reaches(both, n[ia], n[ib])
    unsure = _reaches(both + SLACK, n[ia] + SLACK, n[ib] + SLACK) | ok
    unsure &= ~_reaches(both - SLACK, n[ia] + SLACK, n[ib] + SLACK)
    for i in np.flatnonzero(unsure):
        x, y = gram_set(la[i]), gram_set(lb[i])
        ok[i] = _reaches(len(x & y), len(x), len(y))
    return ok


def verify(batches):
    for b in small(batches, 2048):
        la, lb = b.column("la").to_pylist(), b.column("lb").to_pylist()
        ok = [linked(la[i:j], lb[i:j]) for i, j in slices([x + y for x, y in zip(la, lb)], 300_000)]
        if ok:
            yield b.select(["a", "b"]).append_column("linked", pa.array(np.concatenate(ok)))


def block_members(batches):
    """The members of a block pair (rows that follow each other) that by size
    and sketch may link with a member of another component."""
    for d, at in _runs(batches):
        n, comp, side = d["n"].values, d["component"].values, d["side"].values
        sketch = np.frombuffer(b"".join(d["sketch"]), np.uint8).reshape(len(d), -1)
        # a row meets those after it; where two blocks meet, one of the first all of the second
        start, end = np.arange(len(d)) + 1, np.repeat(at[1:], np.diff(at))
        second = at[:-1] + np.add.reduceat((side == 0).astype(np.int64), at[:-1])
        cross = (d["i"] != d["j"]).values
        start = np.where(cross, np.where(side == 1, end, np.repeat(second, np.diff(at))), start)
        upto = np.cumsum(end - start)
        may, s = np.zeros(len(d), bool), 0
        while s < len(d):
            base = upto[s - 1] if s else 0
            e = max(s + 1, int(np.searchsorted(upto, base + PAIRS, "right")))
            met = (end - start)[s:e]
            x = np.repeat(np.arange(s, e), met)
            y = np.arange(len(x)) - np.repeat(upto[s:e] - met - base, met) + start[x]
            ok = (comp[x] != comp[y]) & _fits(n[x], n[y])
            x, y = x[ok], y[ok]
            ok = _alike(sketch[x], sketch[y])
            may[x[ok]] = may[y[ok]] = True
            s = e
        yield pa.RecordBatch.from_arrays([pa.array(d[c].values[may], pa.int64()) for c in ("key", "nid", "component")],
                                         names=["key", "nid", "component"])


def block_links(batches):
    """Within each block pair (rows that follow each other) a spanning forest of
    the verified links between components."""
    for d, at in _runs(batches):
        n, comp, nid, lines = d["n"].values, d["component"].values.copy(), d["nid"].values, d["line"].values
        sketch = np.frombuffer(b"".join(d["sketch"]), np.uint8).reshape(len(d), -1)
        side, cross = d["side"].values, (d["i"] != d["j"]).values
        a, b = [], []
        for s, e in zip(at[:-1], at[1:]):
            for x in range(s, e):
                if cross[x] and side[x]:
                    continue
                ys = np.arange(s, e)[side[s:e] == 1] if cross[x] else np.arange(x + 1, e)
                ys = ys[comp[ys] != comp[x]]
                ys = ys[_fits(n[ys], n[x])] if len(ys) else ys
                ys = ys[_alike(sketch[ys], sketch[x])] if len(ys) else ys
                if not len(ys):
                    continue
                for y in ys[linked([lines[x]] * len(ys), [lines[y] for y in ys])]:
                    if comp[x] != comp[y]:
                        a.append(nid[x])
                        b.append(nid[y])
                        part = comp[s:e]
                        part[part == comp[y]] = comp[x]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _runs(batches):
    """Rows of whole runs (same key and block pair), which arrive sorted."""
    import pandas as pd
    rest = None
    for b in batches:
        d = b.to_pandas()
        d = pd.concat([rest, d], ignore_index=True) if rest is not None else d
        if not len(d):
            continue
        run = (d["key"].values, d["i"].values, d["j"].values)
        cut = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in run])) + 1
        if len(cut):
            yield d.iloc[:cut[-1]], np.r_[0, cut]
            rest = d.iloc[cut[-1]:]
        else:
            rest = d
    if rest is not None and len(rest):
        yield rest, np.array([0, len(rest)])


def _few(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_KEYS else df


def _dealt(df: DataFrame) -> DataFrame:
    """A table that grows with the lines: it is joined by a shuffle at every
    size, and never goes through the driver."""
    return df.hint("merge")


def _open(members: DataFrame, kind: str) -> DataFrame:
    """The members (key, nid, component) of buckets that hold several
    components, with ``left``, how many members their bucket has."""
    apart = members.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                       F.count(F.lit(1)).alias("left")).where("lo <> hi")
    return written(members.join(apart.select("key", "left"), "key"), kind)


def _blocks(open_rows: DataFrame, *of_member: DataFrame) -> DataFrame:
    """Deal the members of each open bucket, with what ``of_member`` has of
    them, into block pairs of bounded size."""
    rows = open_rows.withColumn("chunks", F.ceil(F.col("left") / F.lit(BLOCK)).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("nid"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("key", "nid", "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                       (F.col("own") > F.col("other")).cast("int").alias("side"))
    for table_ in of_member:
        rows = rows.join(_dealt(table_), "nid")
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side", "nid")


def fuzzy_components(signed: DataFrame, lines: DataFrame) -> DataFrame | None:
    """(id, component) of the lines linked with a different line; a component is
    named by a number. ``signed``: what ``_sign`` makes of ``lines``, a scratch
    table that is deleted once its buckets are known."""
    sigs = signed.where("n IS NOT NULL").select("id", F.xxhash64("id").alias("h"), "n", "keys", "sketch")
    # a number stands for a line until buckets are found; a line that several tasks signed is one
    member = sigs.select("h", F.explode("keys").alias("key"))
    found = []
    for at in range(1, BANDS + 1, AT_ONCE):  # some bands at a time: their keys are the largest shuffle
        some = sigs.select("h", F.explode(F.slice("keys", at, AT_ONCE)).alias("key"))
        found.append(written(some.groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi"), F.count(F.lit(1)).alias("rows"))
                             .where("lo <> hi"), "keys"))
    buckets = found[0]
    for more in found[1:]:
        buckets = buckets.union(more)
    # a bucket of two rows is its least and greatest number; only larger ones need their members
    two = buckets.where("rows = 2").select("key", F.explode(F.array("lo", "hi")).alias("h"))
    larger = buckets.where("rows > 2").select("key")
    shared = two.union(member.join(_few(larger, larger.count()), "key", "left_semi").select("key", "h")).distinct()
    shared = written(shared, "members")
    dropped(*found)
    wanted = written(shared.select("h").distinct(), "wanted")
    # lines of one number are told apart by their whole key: both are members of its buckets
    ids = sigs.select("id", "h").join(_dealt(wanted), "h", "left_semi").distinct()
    numbers = written(ids.withColumn("nid", F.monotonically_increasing_id()), "numbers")
    dropped(wanted)
    by_bucket = shared
    shared = written(shared.join(_dealt(numbers.select("h", "nid")), "h").select("key", "nid"), "buckets")
    dropped(by_bucket)
    meta = written(sigs.select("id", "n", "sketch").join(_dealt(numbers.select("id", "nid")), "id").groupBy("nid", "n", "sketch").count().drop("count"), "meta")
    dropped(signed)  # band keys and sketches of all lines are the largest table
    release(lines.sparkSession)

    def texts_of(ends: DataFrame) -> DataFrame:
        """(nid, line) of the lines in ``ends`` (nid), read from the documents
        again: no table of all texts, and few of them go through a shuffle."""
        named = written(numbers.select("id", "nid").join(ends.distinct(), "nid", "left_semi"), "ends")
        few = named.count()
        own = lines.where(F.length("line") >= LEAST).select("id", "line")
        # one shuffle of lines: dealt by id they are told apart and joined where they lie
        own = own if few <= BROADCAST_KEYS else own.mapInArrow(first_met, "id binary, line string").repartition("id")
        texts = written(own.join(_few(named, few), "id").groupBy("id", "nid", "line").count().select("nid", "line"), "texts")
        dropped(named)
        return texts

    hubs = shared.groupBy("key").agg(F.min("nid").alias("hub"), F.count(F.lit(1)).alias("size"))
    shared_ = written(shared.join(_dealt(hubs), "key"), "hubs")
    dropped(shared)
    member_hub = shared_.where("nid <> hub")

    def settle(pairs: DataFrame) -> DataFrame:
        """Size and sketch, then the sets themselves: (a, b, linked)."""
        wide = pairs.join(_dealt(meta.toDF("a", "na", "sa")), "a").join(_dealt(meta.toDF("b", "nb", "sb")), "b")
        maybe = narrow(wide.mapInArrow(keep_alike, "a long, b long"), "alike")
        texts = texts_of(maybe.select(F.col("a").alias("nid")).union(maybe.select("b")))
        full = maybe.join(texts.toDF("b", "lb"), "b").join(texts.toDF("a", "la"), "a").select("a", "b", "la", "lb")
        verdict = narrow(full.mapInArrow(verify, "a long, b long, linked boolean"), "verdicts")
        dropped(maybe, texts)
        release(lines.sparkSession)
        return verdict

    first = settle(member_hub.groupBy(F.col("nid").alias("b")).agg(F.min("hub").alias("a")).select("a", "b"))
    links = first.where("linked").select("a", "b")
    comp = components(links)
    top = comp.toDF("hub", "hub_top")
    rest = (member_hub.select("nid", "hub").distinct().join(comp.withColumnRenamed("id", "nid"), "nid", "left").join(top, "hub", "left")
            .where(~F.coalesce("component", "nid").eqNullSafe(F.coalesce("hub_top", "hub"))).select(F.col("hub").alias("a"), F.col("nid").alias("b")))
    second = settle(rest.join(first.select("a", "b"), ["a", "b"], "left_anti"))
    links = links.union(second.where("linked").select("a", "b"))
    if not second.where("linked").isEmpty():
        dropped(comp)
        comp = components(links)
    placed = member_hub.where("size > 2").join(comp.withColumnRenamed("id", "nid"), "nid", "left").select(
        "key", "nid", F.coalesce("component", "nid").alias("component"))
    open_rows = _open(placed, "open")
    third = None
    if not open_rows.isEmpty():
        may = narrow(_blocks(open_rows, meta).mapInArrow(block_members, "key long, nid long, component long").distinct(), "may-link")
        dropped(open_rows)
        open_rows = _open(may, "open")
        dropped(may)
    if not open_rows.isEmpty():
        texts = texts_of(open_rows.select("nid"))
        mine = open_rows.select("nid").distinct()
        ends = meta.join(_few(mine, open_rows.count()), "nid", "left_semi")
        third = narrow(_blocks(open_rows, ends, texts).mapInArrow(block_links, "a long, b long").distinct(), "block-links")
        dropped(texts)
        if not third.isEmpty():
            dropped(comp)
            comp = components(links.union(third))
    out = narrow(comp.withColumnRenamed("id", "nid").join(numbers, "nid").select("id", "component"), "fuzzy")
    dropped(comp, first, second, open_rows, meta, numbers, shared_, *([third] if third is not None else []))
    return out


def _judged(docs: DataFrame, id_col: str, text_col: str, by_row: bool) -> DataFrame:
    """doc_id, row (without ``by_row`` only where there is no id), n_lines, n_kept, dropped of those that have lines."""
    lines = lines_of(docs, id_col, text_col)
    if not by_row:
        lines = lines.withColumn("row", F.when(F.col("doc_id").isNull(), F.col("row")))
    lines = lines.withColumn("id", line_id())
    own = ["doc_id", "row"]
    signed = written(lines.mapInArrow(_sign(own), "doc_id long, row binary, pos int, id binary, n long, keys array<long>, sketch binary"), "signed")
    placed = written(signed.select(*own, "pos", "id"), "seen")
    comp = fuzzy_components(signed, lines)
    # doc_id and position in one number: a fixed-width key that sorts like the pair; null ids last
    place = (F.coalesce(F.col("doc_id").cast("decimal(20)"), F.lit(str(1 << 63)).cast("decimal(20)"))
             * F.lit(1 << 31) + F.col("pos")).cast("decimal(38)")
    place = F.struct(place.alias("place"), "row") if by_row else place
    seen = placed.withColumn("place", place)
    first = seen.groupBy("id").agg(F.min("place").alias("first"))
    moved = first.join(comp, "id")
    best = moved.groupBy("component").agg(F.min("first").alias("best"))
    moved = written(moved.join(best, "component").select("id", "best"), "moved")
    first = first.join(_few(moved, moved.count()), "id", "left").select("id", F.coalesce("best", "first").alias("first"))
    judged = seen.join(first, "id").select(
        *own, F.when(F.col("place") > F.col("first"), F.col("pos")).alias("gone"))
    out = written(judged.groupBy(*own).agg(
        F.count(F.lit(1)).alias("n_lines"), (F.count(F.lit(1)) - F.count("gone")).alias("n_kept"),
        F.sort_array(F.collect_list("gone")).alias("dropped")), "judged")
    dropped(placed, comp, moved)
    return out


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_lines, n_kept, dropped."""
    per_doc = _judged(docs, id_col, text_col, False).withColumnsRenamed({"doc_id": "d", "row": "r"})
    doc_id = F.col(id_col).cast("long")
    empty = docs.select(doc_id.alias("doc_id"), F.when(doc_id.isNull(), text_key(text_col)).alias("row")).distinct()
    out = empty.join(per_doc, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("row").eqNullSafe(F.col("r")), "left")
    return out.select("doc_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
                      F.coalesce("n_kept", F.lit(0)).alias("n_kept"),
                      F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with the dropped lines
    taken out of the texts and ``n_chars``, where there is one, kept true;
    documents that lose their last line go. Rows of one id, or of none, are
    judged each by its own lines; rows of one id and text are alike."""
    judged = _judged(docs, "doc_id", "text", True).where(F.size("dropped") > 0).select(
        F.col("doc_id").alias("_line_doc"), F.col("row").alias("_line_row"), F.col("dropped").alias("_line_gone"),
        (F.col("n_kept") == 0).alias("_line_all"))
    # arrays of positions have no bound in bytes: which side is sent is left to the planner
    rows = docs.join(judged, docs["doc_id"].cast("long").eqNullSafe(judged["_line_doc"])
                     & (text_key() == judged["_line_row"]), "left")
    rows = rows.where(~F.coalesce("_line_all", F.lit(False))).select(*[docs[c] for c in docs.columns], "_line_gone")
    return rows.mapInArrow(_without_lines, docs.schema)


def _without_lines(batches):
    """Take the positions ``_line_gone`` out of the texts."""
    for b in small(batches):
        gone, names = b.column("_line_gone").to_pylist(), b.schema.names[:-1]
        columns = {c: b.column(c) for c in names}
        if any(g is not None for g in gone):
            texts = columns["text"].to_pylist()
            for i, g in enumerate(gone):
                if g is not None:
                    g = set(g)
                    texts[i] = "\n".join(x for k, x in enumerate(texts[i].split("\n")) if k not in g)
            columns["text"] = pa.array(texts, b.schema.field("text").type)
            if "n_chars" in columns:
                sizes = [n if g is None else len(t) for n, g, t in zip(columns["n_chars"].to_pylist(), gone, texts)]
                columns["n_chars"] = pa.array(sizes, b.schema.field("n_chars").type)
        yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"))
