"""Operator 12: the prefix trie of conversations, by union-find over the LCP
edges of sorted neighbours.

A conversation is a sequence of turns (role, text). Sequences are sorted;
neighbours are joined by an edge as long as their common prefix. Taking the
edges from the longest down, each merge of two components makes, or extends, the
branching node at that depth; the stretch above a component up to the next
merge is a chain of nodes with one child each.

* A turn is a key of ``WIDTH`` bytes: 16 of the SHA-256 of role and text, and
  the text's length. Equal sequences are one row with a count, so a
  conversation that a third of all rows repeat is a single row in the sort.
* Sequences are cut into segments of ``SEGMENT`` turns. A round sorts one
  segment; only conversations that share all of it with another go on, grouped
  by the node they share. What a conversation has to itself below is a chain
  that needs no sort. So no task holds a whole conversation, however long.
* A task grows the forest of its range of the sort. What touches the first or
  last sequence of the range is open: it is contracted to one entry a depth
  (at most ``2 * SEGMENT`` a range), and one task merges these contracted
  forests across the boundaries with the same union-find. Rounds are grown from
  the last one up, each handing its sums to the nodes it hangs from.

Defined results: turns are ordered by turn, null first, equal ones by the
turn's key; a null role or text is empty; rows without a conv_id take no part;
a conversation may be left without turns; repeated rows are turns of their own;
an empty table gives an empty result; extra columns are ignored; texts are
whole, however long.
"""
from __future__ import annotations

import hashlib

import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balances.llm.common import dropped, new_path, table, written
from balances.operators.rank import distributed_row_number
from balances.session import cut_lineage

SEGMENT = 64
DIGEST, WIDTH = 16, 24
#: The contract's rebuilding: turns come from the hundred's first conversation.
HUNDRED, HEADS = 100, 6
#: Rows that may go to every task at once.
BROADCAST_ROWS = 500_000
#: Sequences that one task sorts and joins.
RANGE_ROWS = 50_000
#: Fewer are not dealt out further.
LEAST_ROWS = 256
#: Ids joined to one string before they are hashed.
PIECE = 4096
NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string")
_ROWS = ("kind int, pid int, rep int, at int, conv long, depth long, parent long, n_convs long, kids long, "
         "leaves long, saved long, sid long, g long, keys binary")
#: Kinds of rows between the steps.
_NODE, _OPEN, _GROUP, _SEQUENCE, _NAMED = range(5)
_NO_ENDS = hashlib.sha256(b"").hexdigest()


# --- one forest ------------------------------------------------------------------

def _plus(a, b):
    """Two parts of one node: members, smallest member, children, their leaves,
    their saved tokens, the sequence that ends here, rows below it."""
    if a is None or b is None:
        return a or b
    return (a[0] + b[0], min(a[1], b[1]), a[2] + b[2], a[3] + b[3], a[4] + b[4],
            b[5] if a[5] is None else a[5], a[6] + b[6])


def shared_turns(a: bytes, b: bytes) -> int:
    n, k = min(len(a), len(b)), 0
    while k < n and a[k:k + WIDTH] == b[k:k + WIDTH]:
        k += WIDTH
    return k // WIDTH


def _text_length(keys: bytes, depth: int) -> int:
    return int.from_bytes(keys[depth * WIDTH - WIDTH + DIGEST:depth * WIDTH], "big")


class _Rows:
    """Rows of a forest; a node's parent is set once the parent is complete."""

    def __init__(self, base: int):
        self.base, self.rows = base, []

    def add(self, **values) -> int:
        self.rows.append(values)
        return len(self.rows) - 1

    def node(self, conv, depth, n, kids, leaves, saved, sid) -> int:
        return self.add(kind=_NODE, conv=conv, depth=self.base + depth, n_convs=n, kids=kids,
                        leaves=leaves, saved=saved, sid=sid)

    def named(self, below: list, conv: int) -> None:
        """The parent of the rows ``below`` has ``conv`` as its smallest member."""
        for row in below:
            if isinstance(row, tuple):  # an open node of a range
                pid, rep, at = row
                self.add(kind=_NAMED, pid=pid, rep=rep, at=at, conv=conv)
            else:
                self.rows[row]["parent"] = conv

    def batches(self):
        names = [c.split()[0] for c in _ROWS.split(", ")]
        kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
        types = [kinds[c.split()[1]] for c in _ROWS.split(", ")]
        for at in range(0, len(self.rows), 20_000):
            part = self.rows[at:at + 20_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.get(n) for r in part], t) for n, t in zip(names, types)], names=names)


class _Component:
    """Neighbouring sequences from a depth on: the parts of the node at ``top``,
    parts that join on the way up, and a sequence to read text lengths from.
    ``open`` names the end of the range it touches."""

    def __init__(self, keys, parts: dict, open_):
        self.keys, self.parts, self.open = keys, parts, open_
        self.top = max(parts)
        self.node = None if open_ is not None else parts.pop(self.top)

    def climb(self, depth: int, rows: _Rows) -> None:
        """Complete the nodes below ``depth``; the node there is then at hand."""
        while self.top > depth:
            n, conv, kids, leaves, saved, sid, below = self.node
            leaves = leaves if kids else 1
            saved += (n - 1) * _text_length(self.keys, self.top)
            row = rows.node(conv, self.top, n, kids, leaves, saved, sid)
            rows.named(below, conv)
            self.top -= 1
            self.node = _plus((n, conv, 1, leaves, saved, None, [row]), self.parts.pop(self.top, None))


def grow(keys: list, groups: list, parts: list, open_ends: dict, rows: _Rows) -> list:
    """Union-find over the edges between sorted neighbours, the deepest first.
    ``parts``: per sequence the parts of nodes by depth; ``open_ends``: position
    -> the end of the range it is. Returns (group, component) of what is left,
    closed ones at depth 0."""
    up = list(range(len(keys)))
    comps = [_Component(k, p, open_ends.get(i)) for i, (k, p) in enumerate(zip(keys, parts))]
    ends = {c.open: c for c in comps if c.open is not None}

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    edges = [(shared_turns(keys[i], keys[i + 1]), i) for i in range(len(keys) - 1) if groups[i] == groups[i + 1]]
    for depth, i in sorted(edges, reverse=True):
        a, b = find(i), find(i + 1)
        left, right = comps[a], comps[b]
        for c in (left, right):
            if c.open is None:
                c.climb(depth, rows)
        if left.open is None and right.open is None:
            left.node = _plus(left.node, right.node)
            for d, part in right.parts.items():
                left.parts[d] = _plus(left.parts.get(d), part)
            up[b] = a
        elif left.open is None or right.open is None:
            end, closed = (right, left) if left.open is None else (left, right)
            mine = ends[end.open].parts
            mine[depth] = _plus(mine.get(depth), closed.node)
            up[a if end is right else b] = b if end is right else a
        else:  # both ends: from here on the first one takes what joins
            up[b] = a
    left_over = []
    for i, c in enumerate(comps):
        if up[i] == i and c.open is None:
            c.climb(0, rows)
            left_over.append((groups[i], c))
    return left_over


def _group(rows: _Rows, g: int, node, parent: int) -> None:
    """The sums of a group for the node it hangs from."""
    rows.named(node[6], parent)
    rows.add(kind=_GROUP, g=g, conv=node[1], n_convs=node[0], kids=node[2], leaves=node[3], saved=node[4])


def grow_range(seqs: list[dict], base: int) -> _Rows:
    """The forest of one range of the sort, contracted where it touches the
    range's ends. ``seqs``: sorted rows of sequences."""
    rows, last = _Rows(base), len(seqs) - 1
    parts = [{len(s["keys"]) // WIDTH: (s["cnt"], s["mc"], s["kids"], s["leaves"], s["saved"], s["sid"], [])} for s in seqs]
    for g, c in grow([s["keys"] for s in seqs], [s["g"] for s in seqs], parts, {0: 0, last: 1} if last else {0: 0}, rows):
        _group(rows, g, c.node, next(s["gm"] for s in seqs if s["g"] == g))
    for i, rep in ((0, 0), (last, 1))[:1 + bool(last)]:
        s = seqs[i]
        where = {"pid": s["pid"], "rep": rep}
        rows.add(kind=_SEQUENCE, g=s["g"], conv=s["gm"], keys=s["keys"], **where)
        for depth, (n, conv, kids, leaves, saved, sid, below) in parts[i].items():
            rows.add(kind=_OPEN, at=depth, conv=conv, n_convs=n, kids=kids, leaves=leaves, saved=saved, sid=sid, **where)
            if depth == 0:
                rows.named(below, s["gm"])
                continue
            for row in below:
                rows.rows[row].update(where, at=depth)
    return rows


def merge_ranges(contracted: list[dict], base: int) -> _Rows:
    """Grow the contracted forests of all ranges together."""
    rows, ends = _Rows(base), {}
    for r in contracted:
        end = ends.setdefault((r["pid"], r["rep"]), {"parts": {}})
        if r["kind"] == _SEQUENCE:
            end.update(keys=r["keys"], g=r["g"], gm=r["conv"])
        else:
            below = [(r["pid"], r["rep"], r["at"])] if r["at"] else []
            end["parts"][r["at"]] = (r["n_convs"], r["conv"], r["kids"], r["leaves"], r["saved"], r["sid"], below)
    order = [ends[k] for k in sorted(ends)]
    gm = {e["g"]: e["gm"] for e in order}
    for g, c in grow([e["keys"] for e in order], [e["g"] for e in order], [e["parts"] for e in order], {}, rows):
        _group(rows, g, c.node, gm[g])
    return rows


# --- the jobs ----------------------------------------------------------------------

def _few(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def turn_keys(rows: DataFrame) -> DataFrame:
    """conv, turn, key of every row with a conv_id."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    framed = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    key = F.concat(F.substring(F.unhex(F.sha2(framed, 256)), 1, DIGEST),
                   F.unhex(F.lpad(F.hex(F.length(text).cast("long")), 2 * (WIDTH - DIGEST), "0")))
    return rows.select(F.col("conv_id").cast("long").alias("conv"), "turn", key.alias("key")).where("conv IS NOT NULL")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, size) of every conversation, and (conv, size, pos, key) of the
    turns it has after rebuilding."""
    turns = distributed_row_number(turn_keys(rows), ["conv"], ["turn", "key"], rn="pos", n="own")
    turns = written(turns.select("conv", (F.col("pos") - 1).alias("pos"), "key", "own"), "turns")
    convs = turns.groupBy("conv").agg(F.max("own").alias("own"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS
    convs = convs.select("conv", "own", (F.col("conv") - F.col("conv") % HUNDRED).alias("base"), h.alias("h"))
    heads = convs.where(F.col("conv") % HUNDRED == 0).select(F.col("conv").alias("base"), F.col("own").alias("there"))
    given = F.least("h", F.coalesce("there", F.lit(0)))
    convs = convs.join(heads, "base", "left").select("conv", "base", "h", given.alias("given"),
                                                     (given + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("size"))
    convs = written(convs, "convs")
    n = convs.count()
    own = turns.select("conv", "pos", "key").join(_few(convs.select("conv", "h", "given", "size"), n), "conv").where("pos >= h").select(
        "conv", "size", (F.col("given") + F.col("pos") - F.col("h")).alias("pos"), "key")
    first = turns.where((F.col("conv") % HUNDRED == 0) & (F.col("pos") < HEADS)).select(F.col("conv").alias("base"), "pos", "key")
    taken = first.join(_few(convs.select("conv", "base", "h", "size"), n), "base").where("pos < h").select("conv", "size", "pos", "key")
    seq = written(own.union(taken), "sequences")
    out = written(convs.select("conv", "size"), "sizes")
    dropped(turns, convs)
    return out, seq


def digests(ends: DataFrame) -> DataFrame:
    """(sid, conv) -> (sid, ends): the SHA-256 of a node's ids in ascending
    order. A hash is sequential, so a node's ids go through one task, as
    strings of ``PIECE`` ids that are read one by one."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pieces(batches):
        sid, ids, rows = None, [], []
        for b in batches:
            for s, conv in zip(b.column("sid").to_pylist(), b.column("conv").to_pylist()):
                if ids and (s != sid or len(ids) == PIECE):
                    rows.append((sid, ids[0], ",".join(map(str, ids))))
                    ids = []
                sid = s
                ids.append(conv)
            if len(rows) >= 256:
                yield _batch(rows, (("sid", pa.int64()), ("first", pa.int64()), ("ids", pa.string())))
                rows = []
        if ids:
            rows.append((sid, ids[0], ",".join(map(str, ids))))
        if rows:
            yield _batch(rows, (("sid", pa.int64()), ("first", pa.int64()), ("ids", pa.string())))

    def hashed(batches):
        sid, h = None, None
        for b in batches:
            rows = []
            for s, text in zip(b.column("sid").to_pylist(), b.column("ids").to_pylist()):
                if h is not None and s == sid:
                    h.update(b"," + text.encode())
                    continue
                if h is not None:
                    rows.append((sid, h.hexdigest()))
                sid, h = s, hashlib.sha256(text.encode())
            if rows:
                yield _batch(rows, (("sid", pa.int64()), ("ends", pa.string())))
        if h is not None:
            yield _batch([(sid, h.hexdigest())], (("sid", pa.int64()), ("ends", pa.string())))
    parts = ends.repartitionByRange(n, "sid", "conv").sortWithinPartitions("sid", "conv").mapInArrow(
        pieces, "sid long, first long, ids string")
    return parts.repartition(n, "sid").sortWithinPartitions("sid", "first").mapInArrow(hashed, "sid long, ends string")


def _batch(rows, fields):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def _grown(seqs: DataFrame, base: int, rows: int) -> DataFrame:
    """Sort the sequences of a round, grow each range, merge the ranges.
    Returns the rows of both steps (``_ROWS``)."""
    spark = seqs.sparkSession
    n = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // LEAST_ROWS), rows // RANGE_ROWS)
    ranges = cut_lineage(seqs.repartitionByRange(n, "g", "keys").sortWithinPartitions("g", "keys")
                         .withColumn("pid", F.spark_partition_id()))

    def one(batches):
        seqs = [row for b in batches for row in b.to_pylist()]
        if seqs:
            yield from grow_range(seqs, base).batches()

    def all_(batches):
        yield from merge_ranges([row for b in batches for row in b.to_pylist()], base).batches()
    grown = written(ranges.mapInArrow(one, _ROWS), "ranges")
    # at most 2 * SEGMENT + 2 rows a range
    met = grown.where(F.col("kind").isin(_OPEN, _SEQUENCE)).coalesce(1).mapInArrow(all_, _ROWS)
    met = written(met, "merged")
    named = met.where(F.col("kind") == _NAMED).select("pid", "rep", "at", F.col("conv").alias("above"))
    nodes = grown.where((F.col("kind") == _NODE) & F.col("pid").isNotNull()).drop("parent").join(
        F.broadcast(named), ["pid", "rep", "at"]).withColumnRenamed("above", "parent")  # as many rows as ``met``
    rest = grown.where((F.col("kind") == _GROUP) | ((F.col("kind") == _NODE) & F.col("pid").isNull()))
    out = written(nodes.unionByName(rest).unionByName(met.where(F.col("kind").isin(_NODE, _GROUP))), "forest")
    dropped(grown, met)
    return out


def trie(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``NODE`` rows of the trie of the rebuilt conversations."""
    spark = rows.sparkSession
    convs, seq = rebuilt(rows)
    total = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("least")).first()
    if not total["n"]:
        return spark.createDataFrame([], NODE)
    path = new_path(spark, "trie")

    def add(nodes: DataFrame) -> None:
        nodes.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in NODE.split(", ")]).write.mode("append").parquet(path)

    packed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "key"))), lambda x: F.hex(x["key"])), "")
    segs = written(seq.groupBy("conv", "size", F.floor(F.col("pos") / segment).alias("seg")).agg(
        F.unhex(packed).alias("keys")), "segments")

    # down: the sequences of each round, and who goes on
    rounds, cur = [], segs.where("seg = 0").select(
        F.lit(0).cast("long").alias("g"), F.lit(total["least"]).alias("gm"), "conv", "size", "keys")
    while True:
        r = len(rounds)
        here = (F.lit(r * segment) + F.length("keys") / WIDTH).cast("long")
        stops = F.col("size") == here
        seqs = cur.groupBy("g", "gm", "keys").agg(
            F.count(F.lit(1)).alias("cnt"), F.min("conv").alias("mc"), F.count(F.when(stops, 1)).alias("n_end"),
            F.min(F.when(stops, F.col("conv"))).alias("end"))
        seqs = written(seqs.withColumn("sid", F.monotonically_increasing_id()), "round")
        several = seqs.where("n_end > 1").select("g", "keys", "sid")
        ends = cur.where(stops).select("g", "keys", "conv").join(several, ["g", "keys"]).select("sid", "conv")
        if r == 0:
            ends = ends.union(convs.where("size = 0").select(F.lit(-1).cast("long"), "conv"))
        ends = written(digests(ends), "ends")
        single = seqs.where("n_end = 1").select("sid", F.sha2(F.col("end").cast("string"), 256).alias("ends"))
        rounds.append((seqs, written(single.union(ends), "digests")))
        dropped(ends)
        alone = seqs.where("cnt = 1 AND n_end = 0").select(F.col("mc").alias("conv"))
        alone = _few(alone, alone.count())
        add(seq.where(F.col("pos") >= (r + 1) * segment).join(alone, "conv").select(
            F.col("conv").alias("conv_id"), (F.col("pos") + 1).alias("depth"), F.col("conv").alias("parent_conv_id"),
            F.lit(1).alias("n_convs"), (F.col("pos") + 1 < F.col("size")).cast("long").alias("n_children"),
            F.lit(1).alias("n_leaves"), F.lit(0).alias("saved_tokens"),
            F.when(F.col("pos") + 1 == F.col("size"), F.sha2(F.col("conv").cast("string"), 256)).otherwise(_NO_ENDS).alias("ends_sha256")))
        on = seqs.where("cnt > 1 AND cnt > n_end")
        if on.isEmpty():
            break
        on = cur.where(~stops).select("g", "keys", "conv", "size").join(
            on.select("g", "keys", "sid", "mc"), ["g", "keys"]).select(
            F.col("sid").alias("g"), F.col("mc").alias("gm"), "conv", "size")
        cur = written(on.join(segs.where(F.col("seg") == r + 1).select("conv", "keys"), "conv"), "going-on")

    # up: the nodes of each round, and the sums for the round above
    below = None
    for r in range(len(rounds) - 1, -1, -1):
        seqs, ends = rounds[r]
        tail = F.col("cnt") == 1
        tail = (tail & (F.col("n_end") == 0)).cast("long")  # the chain that was added above
        if below is None:
            sums = seqs.withColumns({"kids": tail, "leaves": tail, "saved": F.lit(0).cast("long")})
        else:
            sums = seqs.join(below, "sid", "left").withColumns({
                "kids": F.coalesce("kids", tail), "leaves": F.coalesce("leaves", tail),
                "saved": F.coalesce("saved", F.lit(0).cast("long"))})
        forest = _grown(sums.select("g", "gm", "keys", "sid", "cnt", "mc", "kids", "leaves", "saved"), r * segment, seqs.count())
        nodes = forest.where(F.col("kind") == _NODE).join(ends, "sid", "left")
        add(nodes.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs",
                         F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                         F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends_sha256")))
        below = forest.where(F.col("kind") == _GROUP).select(F.col("g").alias("sid"), "kids", "leaves", "saved")
    top = below.first()  # the root's only row
    here = rounds[0][1].where("sid = -1").first()
    add(spark.createDataFrame([(
        total["least"], 0, None, total["n"], top["kids"] if top else 0, top["leaves"] if top else 1,
        top["saved"] if top else 0, here["ends"] if here else _NO_ENDS)], NODE))
    dropped(convs, seq, segs, *[df for both in rounds for df in both])
    return spark.read.schema(NODE).parquet(path)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


#: The checksum of a decimal number, bit by bit (DuckDB has no such function).
_BIT = "CASE WHEN {c} % 2 = 1 THEN xor({c} // 2, 3988292384) ELSE {c} // 2 END"
_CRC = ("xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), "
        "lambda s: CAST(ascii(s) AS BIGINT))), lambda c, s: list_reduce(list_prepend(xor(c, s), [CAST(i AS BIGINT) FOR i IN range(8)]), "
        "lambda b, i: " + _BIT.format(c="b") + ")), 4294967295)")

SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
keyed AS (
  SELECT conv_id, length(text) AS len, sha256(length(role) || ':' || role || text) AS k,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) - 1 AS pos
  FROM turns),
convs AS (
  SELECT conv_id, count(*) AS own, conv_id - conv_id % {HUNDRED} AS base, {_CRC} % {HEADS} AS h FROM keyed GROUP BY conv_id),
given AS (
  SELECT c.*, least(c.h, coalesce(b.own, 0)) AS given FROM convs c LEFT JOIN convs b ON b.conv_id = c.base),
seq AS (
  SELECT g.conv_id, k.pos, k.k, k.len FROM given g JOIN keyed k ON k.conv_id = g.base WHERE k.pos < g.h
  UNION ALL
  SELECT g.conv_id, g.given + k.pos - g.h, k.k, k.len FROM given g JOIN keyed k ON k.conv_id = g.conv_id WHERE k.pos >= g.h),
sizes AS (SELECT c.conv_id, count(s.pos) AS size FROM convs c LEFT JOIN seq s ON s.conv_id = c.conv_id GROUP BY c.conv_id),
prefixes AS (
  SELECT conv_id, pos + 1 AS depth, string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY pos) AS prefix, len FROM seq
  UNION ALL
  SELECT conv_id, 0, '', 0 FROM convs),
nodes AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, max(len) AS len FROM prefixes GROUP BY depth, prefix),
placed AS (
  SELECT p.conv_id AS member, p.depth, n.conv_id, p.depth = z.size AS is_end
  FROM prefixes p JOIN nodes n ON n.depth = p.depth AND n.prefix = p.prefix JOIN sizes z ON z.conv_id = p.conv_id),
ends AS (
  SELECT depth, conv_id, sha256(string_agg(CAST(member AS VARCHAR), ',' ORDER BY member)) AS ends FROM placed WHERE is_end GROUP BY depth, conv_id),
children AS (
  SELECT n.depth - 1 AS depth, p.conv_id, count(*) AS n_children
  FROM nodes n JOIN placed p ON p.member = n.conv_id AND p.depth = n.depth - 1 GROUP BY 1, 2),
full_nodes AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children, p.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.conv_id = n.conv_id
  LEFT JOIN placed p ON p.member = n.conv_id AND p.depth = n.depth - 1),
sums AS (
  SELECT p.depth, p.conv_id, CAST(sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
         CAST(sum((v.n_convs - 1) * v.len) AS BIGINT) AS saved_tokens
  FROM full_nodes v JOIN placed p ON p.member = v.conv_id AND p.depth <= v.depth GROUP BY p.depth, p.conv_id)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, n.parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens,
       coalesce(e.ends, sha256('')) AS ends_sha256
FROM full_nodes n JOIN sums s ON s.depth = n.depth AND s.conv_id = n.conv_id
LEFT JOIN ends e ON e.depth = n.depth AND e.conv_id = n.conv_id
"""
