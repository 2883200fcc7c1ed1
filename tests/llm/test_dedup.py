"""Operators 5, 6 and 10 against brute force."""
import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from llm_helpers import AWKWARD, frame, prose
from pyspark.sql import functions as F

from balances.llm import common, components, hyperminhash, line_dedup, quotient_dedup


class Sets:
    def __init__(self):
        self.up = {}

    def top(self, x):
        while self.up.setdefault(x, x) != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    edges = chain + star + [(200, 201), (201, 200), (300, 300)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = Sets()
    for a, b in edges:
        want.join(a, b)
    assert got == {v: want.top(v) for v in got} and {0, 40, 129, 201} <= got.keys()
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- exact ---------------------------------------------------------------------

def test_exact_dedup(spark):
    rng = random.Random(3)
    rows = AWKWARD + [(50 + i, rng.choice(["same", "other", "same ", ""])) for i in range(60)]
    got = quotient_dedup.exact_dedup(frame(spark, rows)).collect()
    size = Counter(t or "" for _, t in rows)
    keep = {}
    for i, t in rows:
        if i is not None:
            keep[t or ""] = max(keep.get(t or "", i), i)
    want = sorted((str(i), str(keep.get(t or "", i)), size[t or ""], i == keep.get(t or "", i),
                   hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in got) == want
    assert quotient_dedup.exact_dedup(frame(spark, [])).collect() == []


def test_filters_merge_losslessly(spark):
    rng = np.random.default_rng(1)
    fp = np.concatenate([rng.integers(-1 << 63, (1 << 63) - 1, 500), np.full(700, 12345), [0, -1, -1, 1 << 62]])
    rng.shuffle(fp)
    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.int64())], names=["fp"]) for x in np.array_split(fp, 7)]
    for bits in (1, 4, 10, 30):
        rows = [r for b in quotient_dedup.build_filters(batches, bits, rows=200) for r in b.to_pylist()]
        assert all(r["remainders"] == sorted(r["remainders"]) for r in rows)
        merged = quotient_dedup.merge_filters(spark.createDataFrame(rows, quotient_dedup.FILTER).repartition(5), bits).collect()
        assert {r.fp: r.n for r in merged} == Counter(fp.tolist()) and len(merged) == len(set(fp.tolist()))
    for n in (0, 1, 10 ** 4, 10 ** 8, 10 ** 12):
        bits = quotient_dedup.quotient_bits_for(n)
        assert n / 2 ** bits <= quotient_dedup.RUN or bits == 30


def test_runs_merge_by_sorted_remainders():
    a = (np.array([1, 4, 9]), np.array([2, 1, 1]))
    rem, n = quotient_dedup.merge_runs(a, (np.array([0, 4, 9, 10]), np.array([1, 5, 1, 1])))
    assert rem.tolist() == [0, 1, 4, 9, 10] and n.tolist() == [1, 2, 6, 2, 1]


# --- near ----------------------------------------------------------------------

def brute_near(rows, percent=85):
    sets = [hyperminhash.shingle_set(t or "") for _, t in rows]
    s = Sets()
    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            if a is not None and b is not None and hyperminhash.linked(sets[i], sets[j], percent):
                s.join(a, b)
    return sets, s


def edited(rng, words, n):
    words = list(words)
    for k in rng.sample(range(len(words)), n):
        words[k] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(words)


def near_rows(seed=1):
    rng = random.Random(seed)
    rows, at = list(AWKWARD), 1000
    for size in (40, 120, 400):
        base = prose(rng, size).split()
        for n in (0, 0, 1, 1, 2, 3, 5):
            rows.append((at, edited(rng, base, min(n, size // 12))))
            at += 1
    chain = prose(rng, 200).split()  # each like its neighbours, the ends unlike
    for k in range(12):
        rows.append((at, " ".join(chain)))
        chain[8 * k:8 * k + 3] = ["c%d" % rng.randrange(10 ** 6) for _ in range(3)]
        at += 1
    base = prose(rng, 150).split()  # copies of one text, each near it but not near each other
    for k in range(14):
        rows.append((at, edited(rng, base, 2)))
        at += 1
    rows.append((at, " ".join(base)))
    rows += [(at + 1, "A b C d E F"), (at + 2, "a B c D e f"), (at + 3, "a b"), (at + 4, "A\tB"), (at + 5, "a b c")]
    rows += [(at + 10 + i, prose(rng, 60)) for i in range(30)]
    return rows


def test_near_duplicates(spark):
    rows = near_rows()
    got = hyperminhash.near_duplicates(frame(spark, rows).repartition(3)).collect()
    sets, want = brute_near(rows)
    assert len(got) == len(rows)
    count = defaultdict(set)
    for (i, _), s in zip(rows, sets):
        count[i].add(len(s))
    for r in got:
        assert r.n_shingles in count[r.doc_id]
        assert r.component_id == (None if r.doc_id is None else want.top(r.doc_id))
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
    assert hyperminhash.near_duplicates(frame(spark, [])).collect() == []


def test_blocks_find_links_a_hub_misses(spark, monkeypatch):
    """Members of one bucket whose only link goes past its hub."""
    rng = random.Random(8)
    base = prose(rng, 300).split()
    rows = [(i, edited(rng, base, 9)) for i in range(40)] + [(99, " ".join(base))]
    monkeypatch.setattr(hyperminhash, "BLOCK", 8)
    got = {r.doc_id: r.component_id for r in hyperminhash.near_duplicates(frame(spark, rows)).collect()}
    _, want = brute_near(rows)
    assert got == {i: want.top(i) for i, _ in rows}


def test_register_estimates():
    rng = random.Random(2)
    base = prose(rng, 900).split()
    texts = [" ".join(base), edited(rng, base, 20), prose(rng, 900)]
    sets = hyperminhash.shingle_hashes(texts)
    reg, n = hyperminhash.registers(sets), np.array([len(s) for s in sets])
    exact = [hyperminhash.shingle_set(t) for t in texts]
    assert n.tolist() == [len(s) for s in exact]
    est, _ = hyperminhash.estimate(reg[[0, 0]], reg[[1, 2]], n[[0, 0]], n[[1, 2]])
    true = len(exact[0] & exact[1]) / len(exact[0] | exact[1])
    assert abs(est[0] - true) < 0.1 and est[1] < 0.05


def mirrored(n: int) -> tuple[str, str]:
    """Two words of 2 ** n letters that every polynomial hash modulo a power of two confuses."""
    a, b = "a", "b"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


def test_words_of_one_pattern_are_told_apart(spark):
    a, b = mirrored(11)
    got = {r.doc_id: r.component_id for r in hyperminhash.near_duplicates(frame(spark, [(1, a), (2, b), (3, a + " "), (4, f"{b}\n")])).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 2}


def test_texts_of_one_id(spark):
    """An id with two texts of equally large sets is linked by either."""
    rng, rows = random.Random(5), []
    for i in range(12):
        for k in (0, 1):
            words = prose(rng, 200).split()
            rows += [(i, " ".join(words)), (100 + 2 * i + k, edited(rng, words, 1))]
    got = hyperminhash.near_duplicates(frame(spark, rows).repartition(3)).collect()
    _, want = brute_near(rows)
    assert len(got) == len(rows) and all(r.component_id == want.top(r.doc_id) for r in got)
    assert all(r.component_id == (r.doc_id if r.doc_id < 12 else (r.doc_id - 100) // 2) for r in got)


def test_equal_sums_are_checked(spark, monkeypatch):
    """Texts that hash sums put into one class are classes of their own."""
    rng = random.Random(6)
    rows = [(i, prose(rng, 60)) for i in range(6)]
    rows += [(10 + i, t.upper()) for i, t in rows] + [(20, rows[0][1]), (21, edited(rng, rows[3][1].split(), 1))]
    signed = hyperminhash.sign

    def clashing(batches):
        for b in signed(batches):
            yield b.set_column(2, "hi", pa.array([7] * b.num_rows, pa.int64())).set_column(3, "lo", pa.array([7] * b.num_rows, pa.int64()))
    monkeypatch.setattr(hyperminhash, "sign", clashing)
    got = {r.doc_id: r.component_id for r in hyperminhash.near_duplicates(frame(spark, rows)).collect()}
    _, want = brute_near(rows)
    assert got == {i: want.top(i) for i, _ in rows}


def test_without_duplicates_judges_rows(spark):
    rng = random.Random(9)
    one, two, three = (prose(rng, 120) for _ in range(3))
    rows = [(5, one), (5, two), (7, edited(rng, one.split(), 2)), (None, edited(rng, two.split(), 2)), (None, three), (None, three), (9, three),
            (11, None), (None, ""), (12, "  "), (3, "alone"), (3, "alone"), (4, "Alone")]
    out = hyperminhash.without_duplicates(frame(spark, rows), 80)
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.text or "") for r in out.collect()))
    assert out.columns == frame(spark, []).columns
    assert got == sorted([(False, 5, one), (False, 5, two), (False, 9, three), (False, 11, ""), (True, 0, ""), (False, 12, "  "), (False, 3, "alone")])
    assert hyperminhash.without_duplicates(frame(spark, [])).collect() == []


def test_hashes_do_not_depend_on_the_batch():
    texts = [t or "" for _, t in AWKWARD]
    alone = [hyperminhash.shingle_hashes([t])[0].tolist() for t in texts]
    assert [s.tolist() for s in hyperminhash.shingle_hashes(texts)] == alone
    assert hyperminhash.shingle_hashes(["A B c d e"])[0].tolist() == hyperminhash.shingle_hashes(["a b\tC  d e "])[0].tolist()


# --- lines ---------------------------------------------------------------------

def grams(line):
    g = {line[i:i + 5] for i in range(len(line) - 4)}
    return g or {line}


def brute_lines(rows):
    lines = sorted(((i is None, i or 0, k, x.strip(" \t\r\f\x0b\x00")) for i, t in rows
                    for k, x in enumerate((t or "").split("\n"))), key=lambda r: r[:3])
    lines = [x for x in lines if x[3]]
    texts = sorted({x[3] for x in lines})
    sets, s = [grams(t) for t in texts], Sets()
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                s.join(texts[i], texts[j])
    first, out = {}, defaultdict(list)
    for null, i, k, t in lines:
        key, place = s.top(t), (null, i, k)
        out[None if null else i].append((k, place > first.setdefault(key, place)))
    return out


def line_rows(seed=4):
    rng = random.Random(seed)
    rows, pool = [], []
    for n in (3, 6, 10, 14, 20, 40, 90):
        for _ in range(4):
            pool.append("".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(n * 6)).strip())
    for i in range(60):
        lines = []
        for _ in range(rng.randint(1, 5)):
            x = list(rng.choice(pool))
            if rng.random() < 0.6 and len(x) > 60:
                x[rng.randrange(len(x))] = rng.choice("XYZ")
            if rng.random() < 0.3:
                x += list(" end")
            lines.append("".join(x))
        rows.append((100 + i, "\n".join(lines)))
    return rows


def test_line_dedup(spark):
    rows = [r for r in AWKWARD if r[0] is not None] + line_rows() + [(900, "same\n\nsame\n same "), (901, "\n\n")]
    rows = list({i: (i, t) for i, t in rows}.values())
    got = line_dedup.line_dedup(frame(spark, rows).repartition(3)).collect()
    want = brute_lines(rows)
    assert len(got) == len(rows)
    wrong = 0
    for r in got:
        mine = want[r.doc_id]
        assert r.n_lines == len(mine) and r.n_kept == r.n_lines - len(r.dropped)
        wrong += r.dropped != [k for k, gone in sorted(mine) if gone]
    assert wrong <= 1  # banding is of high, not full, recall
    assert line_dedup.line_dedup(frame(spark, [])).collect() == []


def test_line_dedup_without_broadcasts(spark, monkeypatch):
    """Beyond the broadcast bound, with a line that a third of all rows hold."""
    hot = "a line that very many of all the rows hold"
    rows = line_rows(5) + [(500 + i, hot if i % 2 else hot + "!") for i in range(30)]
    want = line_dedup.line_dedup(frame(spark, rows).repartition(3)).collect()
    monkeypatch.setattr(line_dedup, "BROADCAST_KEYS", 0)
    monkeypatch.setattr(line_dedup, "MEMO_LINES", 8)
    got = line_dedup.line_dedup(frame(spark, rows).repartition(3)).collect()
    assert sorted(got) == sorted(want)
    assert [r.doc_id for r in got if 500 <= r.doc_id and not r.dropped] == [500]


def test_lines_met_lately_pass_once(monkeypatch):
    monkeypatch.setattr(line_dedup, "MEMO_LINES", 2)
    batch = pa.RecordBatch.from_arrays([pa.array([b"a", b"a", b"b", b"a", b"c", b"a"]), pa.array(list("aabaca"))], names=["id", "line"])
    met = [x for b in line_dedup.first_met([batch, batch.slice(0, 0)]) for x in b.column("line").to_pylist()]
    assert met == list("abca")  # forgotten once the memo is full, never lost


def test_line_dedup_awkward(spark):
    rows = AWKWARD + [(70, "a repeated line of text\nkept"), (70, "a repeated line of text\nkept"), (71, "a repeated line of text")]
    got = line_dedup.line_dedup(frame(spark, rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter({i for i, _ in rows}) + Counter([None])  # two texts without an id
    by = {r.doc_id: r for r in got}
    assert by[71].dropped == [0] and by[70].dropped == [] and by[1].n_lines == 0 and by[5].dropped == [0]


def test_linked_is_exact(monkeypatch):
    """The sort over all pairs and, where hashes may clash, the sets."""
    rng = random.Random(2)
    pool = ["".join(rng.choice("ab ") for _ in range(rng.randint(1, 30))) for _ in range(60)] + ["日本語テスト" * 3, "x", "x" * 500]
    la, lb = zip(*[(a, b) for a in pool for b in pool])
    want = [5 * len(grams(a) & grams(b)) >= 4 * len(grams(a) | grams(b)) for a, b in zip(la, lb)]
    assert line_dedup.linked(list(la), list(lb)).tolist() == want
    assert line_dedup.signatures(pool)[0].tolist() == [len(grams(x)) for x in pool]
    exact = line_dedup.gram_hashes
    monkeypatch.setattr(line_dedup, "gram_hashes", lambda lines: (exact(lines)[0] // np.uint64(1 << 58) * np.uint64(1 << 58), exact(lines)[1]))
    monkeypatch.setattr(line_dedup, "SLACK", 1000)
    assert line_dedup.linked(list(la), list(lb)).tolist() == want


def test_rows_without_an_id(spark):
    """One row per text, after all others."""
    rows = [(None, "same line of text\nown a"), (None, "own b line\nsame line of text"), (3, "same line of text")]
    got = sorted((r.doc_id is None, r.n_lines, r.dropped) for r in line_dedup.line_dedup(frame(spark, rows)).collect())
    assert got == [(False, 1, []), (True, 2, [0]), (True, 2, [1])]


def test_deduplicated_texts(spark):
    rows = [(1, "first line of text here\nsecond line of text"), (2, "first line of text here\nother"),
            (3, "first line of text here"), (4, None), (5, "")]
    got = {r.doc_id: r for r in line_dedup.deduplicated(frame(spark, rows)).collect()}
    assert got.keys() == {1, 2, 4, 5} and got[2].text == "other" and got[2].n_chars == 5
    assert got[1].text == rows[0][1] and got[4].text is None and got[2].key == "k"


@pytest.mark.parametrize("n", [30])
def test_crowded_bucket_is_exact(spark, n, monkeypatch):
    """Many lines of one bucket that do not link with its first hub."""
    monkeypatch.setattr(line_dedup, "ROWS", 1)
    rng = random.Random(6)
    base = "".join(rng.choice("abcdefghij ") for _ in range(200))
    rows = []
    for i in range(n):
        x = list(base)
        for k in rng.sample(range(200), 3 if i % 3 else 8):
            x[k] = rng.choice("XYZVW")
        rows.append((i, "".join(x)))
    got = {r.doc_id: r.dropped for r in line_dedup.line_dedup(frame(spark, rows)).collect()}
    want = brute_lines(rows)
    assert got == {i: [k for k, gone in want[i] if gone] for i, _ in rows}


def test_lines_at_the_threshold_meet(spark):
    """Pairs of every length with a Jaccard index just above 0.8 by scattered edits."""
    rng = random.Random(12)
    rows = []
    for size in (40, 80, 160, 400):
        for _ in range(40):
            base = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz  ") for _ in range(size)).strip()
            near, places = base, list(range(len(base)))
            rng.shuffle(places)
            for k in places:
                x = near[:k] + rng.choice("XYZVW") + near[k + 1:]
                both = len(grams(base) & grams(x))
                if 5 * both >= 4 * len(grams(base) | grams(x)):
                    near = x
            rows.append((len(rows), base + "\n" + near))
    got = {r.doc_id: r.dropped for r in line_dedup.line_dedup(frame(spark, rows)).collect()}
    assert sum(got[i] != [1] for i, _ in rows) <= 2  # of 160: banding is of high, not full, recall
    assert 1 - (1 - 0.8 ** line_dedup.ROWS) ** line_dedup.BANDS >= 0.99


def test_lines_of_every_kind_are_signed(spark):
    """Long lines without white space that differ in their first characters;
    repetitive text, whose lines differ in length but not in their 5-grams."""
    rng = random.Random(3)
    rows = []
    for alphabet in ("日本語中文字化漢仮名交文章例", "abcdefghijklmnopqrstuvwxyz0123456789,/"):
        base = "".join(rng.choice(alphabet) for _ in range(300))
        rows.append((len(rows), base + "\n" + "#" + base[1:]))
    for phrase, few, many in (("ab", 3, 4), ("a", 5, 200), ("buy now ", 7, 15), ("buy now ", 7, 90)):
        rows.append((len(rows), (phrase * few).strip() + "\n" + (phrase * many).strip() + "\nother " + "xyz"[len(rows) % 3] * 2))
    got = {r.doc_id: r.dropped for r in line_dedup.line_dedup(frame(spark, rows)).collect()}
    want = brute_lines(rows)
    assert got == {i: [k for k, gone in sorted(want[i]) if gone] for i, _ in rows}
    assert all(1 in gone for gone in got.values())


def test_deduplicated_rows_without_an_id_of_their_own(spark):
    rows = [(None, "a\nb"), (None, "c\nd"), (1, "x\nb"), (2, "e\nx"), (2, "f\ng"), (None, "h\nb")]
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.text) for r in line_dedup.deduplicated(frame(spark, rows)).collect()))
    assert got == [(False, 1, "x\nb"), (False, 2, "e"), (False, 2, "f\ng"), (True, 0, "a"), (True, 0, "c\nd"), (True, 0, "h")]


def test_written_leaves_no_shuffle_files(spark):
    """The shuffle files of a scratch table go as it is written, while its plan is still referred to."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: set(re.findall(r"shuffle_\d+_\d+_\d+\.data", files.getAllFiles().mkString(" ")))
    before, own = shuffles(), spark.conf.get(common.SHUFFLE_CLEANUP)
    df = spark.range(5000).repartition(3, "id").groupBy((F.col("id") % 100).alias("k")).count()
    out = common.written(df, "test")
    for _ in range(100):
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before
    assert spark.conf.get(common.SHUFFLE_CLEANUP) == own and out.count() == df.count() == df.count() == 100


@pytest.mark.parametrize("pairs", [7, 100_000])
def test_only_members_that_may_link_get_their_texts(pairs, monkeypatch):
    """Runs of one block and of two, against all pairs of rows."""
    monkeypatch.setattr(line_dedup, "PAIRS", pairs)
    rng = np.random.default_rng(4)
    rows, sketches = [], rng.integers(0, 256, (6, 40), np.uint8)
    for key, i, j in ((1, 0, 0), (1, 0, 1), (2, 0, 0), (3, 0, 1), (4, 1, 1)):
        for nid in range(14):
            sketch = sketches[rng.integers(6)].copy()
            sketch[rng.choice(40, rng.integers(0, 12), replace=False)] = 7
            side = int(i != j and key != 3 and nid > 6)  # 3: all of one block, which meet nobody there
            rows.append((key, 100 * key + nid, int(rng.integers(5)), i, j, side, int(rng.choice([90, 100, 200])), sketch.tobytes()))
    names = ["key", "nid", "component", "i", "j", "side", "n", "sketch"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
    want = set()
    for x in rows:
        for y in rows:
            if x[0] == y[0] and x[3:5] == y[3:5] and x[1] != y[1] and x[2] != y[2] and (x[3] == x[4] or x[5] != y[5]):
                equal = sum(a == b for a, b in zip(x[7], y[7]))
                if min(x[6], y[6]) * 5 >= max(x[6], y[6]) * 4 and equal >= 32 - 5 * (40 * 0.16) ** 0.5:
                    want.add(x[:3])
    got = [tuple(r.values()) for b in line_dedup.block_members([batch.slice(0, 9), batch.slice(9)]) for r in b.to_pylist()]
    assert set(got) == want and 0 < len(want) < len({r[:3] for r in rows})


def test_crowded_bucket_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 8)
    test_crowded_bucket_is_exact(spark, 40, monkeypatch)


def test_texts_are_read_for_pairs_that_may_link_only(spark, monkeypatch):
    """No scratch table holds the texts of lines whose sketches rule out a link."""
    rng = random.Random(8)
    near = " ".join(rng.choice(["salt", "rope", "lamp", "tide"]) + str(i) for i in range(30))
    half = [near[:90] + "".join(rng.choice("bcdfghjk") for _ in range(120)) for _ in range(30)]
    tables = []
    plain = line_dedup.written

    def written(df, kind):
        out = plain(df, kind)
        tables.append((kind, out.count() if kind in ("texts", "keys", "members") else 0))
        return out

    monkeypatch.setattr(line_dedup, "written", written)
    monkeypatch.setattr(line_dedup, "ROWS", 1)  # lines that share a few grams meet
    docs = frame(spark, [(1, near), (2, near + "x"), *[(10 + i, x) for i, x in enumerate(half)]])
    got = {r.doc_id: r.dropped for r in line_dedup.line_dedup(docs).collect()}
    assert got[2] == [0] and not any(v for k, v in got.items() if k != 2)
    assert sum(n for kind, n in tables if kind == "members") > 20
    assert 2 <= sum(n for kind, n in tables if kind == "texts") <= 6
    assert len([kind for kind, _ in tables if kind == "keys"]) > 1


def test_lines_are_trimmed_as_by_btrim(spark):
    texts = ["a", " a", "a ", "\ta b\x00", "\x0b\x0c\r", "", " 　a　 ", "a\x85", "é ", None]
    rows = spark.createDataFrame([(t,) for t in texts], "line string")
    got = rows.select(line_dedup.trimmed(F.col("line")).alias("x"), F.btrim("line", F.lit(line_dedup.BLANKS)).alias("y")).collect()
    assert [r.x for r in got] == [r.y for r in got]
