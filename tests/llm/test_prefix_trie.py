"""Operator 12: the trie against a brute-force one over every prefix."""
import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from balances.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, conv long, key string, pos long, size long, sid long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", 2, 3, 4) for r in rows], SCHEMA)


def turn_key(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16] + len(text).to_bytes(8, "big")


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append(((turn is not None, turn or 0), turn_key(role, text), (role, text)))
    own = {c: [t[2] for t in sorted(ts)] for c, ts in turns.items()}
    convs = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        convs[c] = tuple(own.get(c - c % 100, [])[:h] + ts[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
            if d:
                children[ts[:d - 1]].add(ts[:d])
    out = []
    for p, ms in members.items():
        under, stack = [], [p]
        while stack:
            under.append(stack.pop())
            stack.extend(children[under[-1]])
        ends = sorted(c for c in ms if len(convs[c]) == len(p))
        out.append((min(ms), len(p), min(members[p[:-1]]) if p else None, len(ms), len(children[p]),
                    sum(not children[v] for v in under),
                    sum((len(members[v]) - 1) * len(v[-1][1]) for v in under if v),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def got(spark, rows, segment=prefix_trie.SEGMENT):
    out = prefix_trie.trie(frame(spark, rows).repartition(3), segment)
    assert out.columns == [c.split()[0] for c in prefix_trie.NODE.split(", ")]
    return sorted((tuple(r) for r in out.collect()), key=lambda r: r[:2])


def corpus(seed, n=160, words=3, longest=9):
    """Few different turns, so that prefixes, whole copies and proper prefixes abound."""
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(700), n):
        for t in range(rng.randrange(longest)):
            rows.append((c, t, rng.choice(["user", "assistant"])[:4 + t % 2], "x" * rng.randrange(words)))
    return rows


@pytest.mark.parametrize("seed, segment, least", [(1, 64, 256), (2, 2, 5), (5, 64, 1)])
def test_brute_force(spark, monkeypatch, seed, segment, least):
    monkeypatch.setattr(prefix_trie, "LEAST_ROWS", least)
    rows = corpus(seed)
    assert got(spark, rows, segment) == brute(rows)


def test_hot_conversation_and_long_ones(spark, monkeypatch):
    """A third of the conversations alike, two long ones alike but for the last turn."""
    monkeypatch.setattr(prefix_trie, "LEAST_ROWS", 8)
    rows = [(c, t, "user", f"t{t}") for c in range(100, 220) for t in range(7)] + corpus(9, 60)
    rows += [(c, t, "user", f"long {t if t < 149 else c}") for c in (1300, 1301) for t in range(150)]
    assert got(spark, rows, 16) == brute(rows)


def test_awkward_rows(spark):
    rows = [(None, 1, "user", "no id"), (1, None, None, None), (1, None, "user", "null turn"), (1, 0, "", ""), (2, 5, "user", "a"),
            (2, 5, "user", "a"), (2, 5, "assistant", "a"), (-3, 1, "user", "neg"), (300, 1, "user", "日本😀" * 3000), (301, 1, None, "x"),
            (301, 2, "user", None), (10 ** 12, 0, "system", "s"), (7, 0, "user:1", "2"), (7, 0, "user", ":12")]
    assert got(spark, rows) == brute(rows)
    turnless = [(c, 0, "user", "x") for c in range(1, 30)]  # h turns are taken from an absent first conversation
    assert got(spark, turnless) == brute(turnless) and any(r[1] == 0 and r[3] == 29 for r in got(spark, turnless))


def test_no_conversations(spark):
    assert got(spark, []) == [] and got(spark, [(None, 0, "user", "x")]) == []


def test_ids_of_a_hot_node_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    ends = spark.range(500).selectExpr("id % 2 AS sid", "id - 250 AS conv").repartition(5)
    want = {s: hashlib.sha256(",".join(str(i - 250) for i in range(500) if i % 2 == s).encode()).hexdigest() for s in (0, 1)}
    assert {r.sid: r.ends for r in prefix_trie.digests(ends).collect()} == want
