"""Operator 9: benchmark decontamination by spaced-seed hashing, in DataFrame
functions only.

Texts become lower-cased runs of letters and digits; in scripts that are
written without spaces every letter is a word. A seed is a fixed mask
over eight successive words: it hashes the words at its set positions and
ignores the others, so a substituted word spoils only the masks that look at
it. The two masks below find, in any ``WINDOW`` aligned words, every overlap
with at most two substitutions (tested exhaustively). Items of fewer words are
sought by masks of four words as well, chosen by their length so that every
pattern of substitutions that the verification accepts leaves one seed whole
(tested exhaustively). Items of fewer than ``FEW`` words tolerate no substitution: their
seed is the whole sequence. Hits of a document and a
benchmark item on the same alignment are then verified once: the aligned
words are compared, and the best window must agree in ``SHARE`` of its words.

The seeds of the benchmark go to every task only while their number is proven
small; beyond ``BROADCAST_SEEDS`` the join shuffles both sides by seed, the
documents' side without their words, which are fetched for the hits.

Result: one row per document and item with a verified overlap: doc_id,
item_id, matched (words of the best window that agree), window (its length:
``WINDOW``, or the whole item where that is shorter).

Defined results: null or empty texts, and texts without letters or digits,
overlap with nothing; repeated documents, items or ids give one row per pair of ids with
the best overlap; null ids are carried like others; empty tables give an empty
result; extra columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balances.llm.common import table, text_key, written

#: Word positions that a seed hashes.
MASKS = ((0, 1, 3, 6, 7), (0, 1, 4, 6, 7))
SPAN = 8
FEW = 5
WINDOW, SHARE = 13, 0.8
BROADCAST_SEEDS = 1_000_000


#: Scripts written without spaces (fixed values).
SCRIPTS = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")


def words(col: str):
    """Lower-cased runs of letters and digits, and letters of ``SCRIPTS``, as an array."""
    text = F.lower(F.coalesce(F.col(col), F.lit("")))
    apart = F.regexp_replace(text, "([" + "".join(rf"\p{{Is{s}}}" for s in SCRIPTS) + "])", " $1 ")
    return F.filter(F.split(apart, r"[^\p{L}\p{N}]+"), lambda w: w != "")


#: Masks for short items only; a seed's kind is its mask's place in ``ALL_MASKS``.
SHORT_MASKS = ((0, 1, 2, 3), (0, 1, 3, 4), (0, 1, 2, 4), (0, 2, 3, 4))
ALL_MASKS = (*MASKS, *SHORT_MASKS)


def kinds_of(n: int) -> tuple[int, ...]:
    """Kinds of seeds that an item of ``n`` words is sought by."""
    if n >= 12:
        return (0, 1)
    if n >= 10:
        return (0, 1, 2, 3)
    return (2, 3) if n > FEW else (2, 3, 4, 5)


def _seeds(hashes, n, mask, kind: int):
    """One seed per position of a text of ``n`` words (an array of longs)."""
    span = mask[-1] + 1
    return F.when(n >= span, F.transform(
        F.sequence(F.lit(1), n - (span - 1)),
        lambda i: F.xxhash64(F.lit(kind), *[F.element_at(hashes, i + p) for p in mask])
    )).otherwise(F.array().cast("array<bigint>"))


def benchmark_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, key (of the words), item (words), n."""
    rows = items.select(F.col(id_col).alias("item_id"), words(text_col).alias("item"))
    rows = rows.select("item_id", F.md5(F.concat_ws(" ", "item")).alias("key"), "item", F.size("item").alias("n"))
    return written(rows.where("n > 0").distinct(), "items")


def benchmark_seeds(items: DataFrame) -> DataFrame:
    """seed, item_id, key, n, place (word position of the seed)."""
    rows = items.withColumn("hashes", F.transform("item", lambda w: F.xxhash64(w)))
    n, out = F.col("n"), None
    for kind, mask in enumerate(ALL_MASKS):
        lengths = [k for k in range(FEW, WINDOW + 1) if kind in kinds_of(k)]
        seeds = F.when(F.least(n, F.lit(WINDOW)).isin(lengths), _seeds(F.col("hashes"), n, mask, kind))
        seeds = seeds.otherwise(F.array().cast("array<bigint>"))
        part = rows.withColumn("seeds", seeds).select(
            "item_id", "key", "n", F.posexplode("seeds").alias("place", "seed"))
        out = part if out is None else out.union(part)
    return out


def overlaps(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, matched, window) of every verified overlap."""
    bench_items = benchmark_items(items, item_id, item_text)
    lengths = {r["n"] for r in bench_items.select(F.least("n", F.lit(WINDOW)).alias("n")).distinct().collect()}  # at most WINDOW
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(text_col).alias("text_key"), words(text_col).alias("words"))
    found = _long_items(rows, bench_items.where(F.col("n") >= FEW), lengths)
    if min(lengths, default=FEW) < FEW:
        found = found.union(_short_items(rows, bench_items.where(F.col("n") < FEW), lengths))
    return found.groupBy("doc_id", "item_id").agg(
        F.max("matched").cast("long").alias("matched"), F.max("window").cast("long").alias("window"))


def _sequences(n: int):
    """Every sequence of ``n`` words, joined."""
    return F.when(F.size("words") >= n, F.transform(
        F.sequence(F.lit(1), F.size("words") - (n - 1)),
        lambda i: F.concat_ws(" ", *[F.element_at("words", i + k) for k in range(n)])
    )).otherwise(F.array().cast("array<string>"))


def _short_items(rows: DataFrame, items: DataFrame, lengths: set) -> DataFrame:
    """Items of fewer than ``FEW`` words, found as whole sequences: the distinct
    sequences of a document meet those of the benchmark, words and all."""
    sequences = F.array_distinct(F.concat(*[_sequences(n) for n in sorted(lengths) if n < FEW]))
    mine = rows.select("doc_id", F.explode(sequences).alias("sequence"))
    theirs = items.select("item_id", F.concat_ws(" ", "item").alias("sequence"), "n").distinct()
    theirs = F.broadcast(theirs) if theirs.count() <= BROADCAST_SEEDS else theirs
    return mine.join(theirs, "sequence").select("doc_id", "item_id", F.col("n").alias("window"), F.col("n").alias("matched"))


def _long_items(rows: DataFrame, bench_items: DataFrame, lengths: set) -> DataFrame:
    bench = benchmark_seeds(bench_items)
    few = bench.count() <= BROADCAST_SEEDS
    # only the masks that some item needs
    masks = [(kind, ALL_MASKS[kind]) for kind in sorted({k for n in lengths if n >= FEW for k in kinds_of(n)} or {0})]
    n = F.size("words")
    seeded = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    seeded = seeded.select("doc_id", "text_key", "words", n.alias("size"), F.concat(*[
        _seeds(F.col("hashes"), n, mask, kind) for kind, mask in masks]).alias("seeds"))
    # Unnesting a column of plain longs and meeting the benchmark stay inside generated code: a row
    # with its words is only built for a hit. The outer form keeps the optimizer from adding a
    # filter that would compute the seeds twice; its null rows meet nothing.
    spread = seeded.select("doc_id", *(["words"] if few else ["text_key"]), "size", F.posexplode_outer("seeds").alias("at", "seed"))
    if few:
        hits = spread.join(F.broadcast(bench), "seed")
    else:  # (row, position, seed) is shuffled; the words follow the hits
        hits = written(spread.join(bench, "seed"), "seed-hits").withColumnsRenamed({"doc_id": "hit_doc", "text_key": "hit_key"})
        hits = hits.join(rows.distinct(), F.col("hit_doc").eqNullSafe(F.col("doc_id")) & (F.col("hit_key") == F.col("text_key")))
    n = F.col("size")
    at = _position(F.col("at"), n, [mask[-1] + 1 for _, mask in masks])
    # the item's word k stands beside the document's word shift + k (0-based)
    shift = at - F.col("place")
    begin = F.greatest(shift, F.lit(0))
    skipped = begin - shift  # words of the item before the document's first
    aligned = hits.select(
        "doc_id", "item_id", "key", shift.alias("shift"), skipped.alias("skipped"),
        F.slice("words", begin + 1, F.least(n - begin, F.col("n") - skipped)).alias("mine")).distinct()
    # written, so that the comparison is not pushed into the join above
    aligned = written(aligned, "aligned")
    aligned = aligned.join(bench_items.withColumnRenamed("item_id", "_item").withColumnRenamed("key", "_key"),
                           (F.col("key") == F.col("_key")) & F.col("item_id").eqNullSafe(F.col("_item")))
    theirs = F.slice("item", F.col("skipped") + 1, F.size("mine"))
    same = F.zip_with("mine", theirs, lambda a, b: (a == b).cast("int"))
    best = aligned.select("doc_id", "item_id", F.least(F.lit(WINDOW), F.col("n")).alias("window"), same.alias("same"))
    best = best.where(F.size("same") >= F.col("window"))
    sums = F.transform(F.sequence(F.lit(1), F.greatest(F.size("same") - F.col("window") + 1, F.lit(1))),
                       lambda i: F.aggregate(F.slice("same", i, F.col("window")), F.lit(0), lambda x, y: x + y))
    best = best.select("doc_id", "item_id", "window", F.array_max(sums).alias("matched"))
    return best.where(F.col("matched") >= F.ceil(F.col("window") * F.lit(SHARE)))


def _position(at, n, spans):
    """Word position of the ``at``-th seed, where the seeds of several masks
    follow each other, ``n - span + 1`` of each."""
    before, out = F.lit(0), None
    for span in spans:
        count = F.greatest(n - (span - 1), F.lit(0))
        own = at - before
        fits = own < count
        out = F.when(fits, own) if out is None else out.when(fits, own)
        before = before + count
    return out


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _sql_words(col: str) -> str:
    scripts = "".join(rf"\p{{{s}}}" for s in SCRIPTS)
    return rf"regexp_extract_all(regexp_replace(lower(coalesce({col}, '')), '([{scripts}])', ' \1 ', 'g'), '[\p{{L}}\p{{N}}]+')"


#: The same overlaps without seeds: every alignment with an equal word.
SQL = f"""
WITH d AS (SELECT doc_id, {_sql_words("text")} AS w FROM documents),
b AS (SELECT item_id, {_sql_words("text")} AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p, len(w) AS n FROM d),
bw AS (SELECT item_id, unnest(w) AS word, unnest(range(len(w))) AS k, least({WINDOW}, len(w)) AS win, len(w) AS m FROM b),
hit AS (SELECT doc_id, item_id, p - k AS shift, k, win FROM dw JOIN bw USING (word)),
sums AS (SELECT doc_id, item_id, win, count(*) OVER (
           PARTITION BY doc_id, item_id, shift ORDER BY k RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) AS c,
         max(k) OVER (PARTITION BY doc_id, item_id, shift ORDER BY k
                      RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) - k AS reach FROM hit)
SELECT doc_id, item_id, max(c)::BIGINT AS matched, max(win)::BIGINT AS "window"
FROM sums WHERE reach < win AND c >= ceil(win * {SHARE}) GROUP BY doc_id, item_id
"""
