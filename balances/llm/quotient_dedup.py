"""Operator 6: exact dedup with counting quotient filters.

Each partition builds a counting quotient filter of its texts' 64-bit
fingerprints: the high bits (quotient) name a bucket, the low bits (remainder)
are kept sorted in the bucket's run, each with a count. The quotient takes as
many bits as leave a run about ``RUN`` fingerprints, whatever the number of rows.
Filters are merged by a shuffle of the runs by quotient: a task reads the runs of
one quotient one after the other and merges their sorted remainders, adding up
the counts of equal ones; nothing is lost, because quotient and remainder
together are the whole fingerprint, and a text that a third of all rows share is
one entry a run. Fingerprints counted more than once route their documents to
byte verification; all others are unique for certain.

Byte verification groups the routed rows by the text itself, with map-side
partial aggregation, so equal texts, however many, shrink to one row per map
task, and two texts that share a fingerprint are told apart.

Defined results: null counts as the empty text; of equal texts the row with the
largest ``doc_id`` stays; repeated rows each give one output row and count in
``group_size``; a null ``doc_id`` never stays over a known one, and a group
of null ids only keeps all its rows; an empty table gives an empty result;
extra columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balances.llm.common import table, text_or_empty, written

#: Fingerprints of a run, about, when all filters are merged.
RUN = 4096
#: Rows a task gathers before it emits its filter (bounds worker memory).
FILTER_ROWS = 500_000
FILTER = "quotient int, remainders array<long>, counts array<long>"


def quotient_bits_for(rows: int) -> int:
    """Bits that leave a merged run about ``RUN`` of ``rows`` fingerprints."""
    return min(30, max(1, (max(1, rows) // RUN).bit_length()))


def build_filters(batches, quotient_bits: int = 10, rows: int = FILTER_ROWS):
    """Counting quotient filters of a stream of fingerprints: one row per
    non-empty run (quotient, sorted remainders, counts)."""
    held, n = [], 0
    for b in batches:
        held.append(np.asarray(b.column(0)).view(np.uint64))
        n += len(held[-1])
        if n >= rows:
            yield _runs(np.concatenate(held), None, quotient_bits)
            held, n = [], 0
    if n:
        yield _runs(np.concatenate(held), None, quotient_bits)


def _runs(fp, counts, quotient_bits):
    order = np.argsort(fp, kind="stable")
    fp = fp[order]
    first = np.flatnonzero(np.r_[True, fp[1:] != fp[:-1]])
    n = np.diff(np.r_[first, len(fp)]) if counts is None else np.add.reduceat(counts[order], first)
    fp = fp[first]
    low = np.uint64(64 - quotient_bits)
    quo = (fp >> low).astype(np.int32)
    rem = (fp & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    runs = np.flatnonzero(np.r_[True, quo[1:] != quo[:-1]])
    offsets = pa.array(np.r_[runs, len(quo)].astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(quo[runs], pa.int32()),
         pa.ListArray.from_arrays(offsets, pa.array(rem, pa.int64())),
         pa.ListArray.from_arrays(offsets, pa.array(n.astype(np.int64), pa.int64()))],
        names=["quotient", "remainders", "counts"])


def merge_runs(a, b):
    """Two sorted runs (remainders, counts) as one."""
    rem = np.concatenate((a[0], b[0]))
    n = np.concatenate((a[1], b[1]))
    order = np.argsort(rem, kind="stable")  # two sorted runs: the stable sort merges them
    rem, n = rem[order], n[order]
    first = np.flatnonzero(np.r_[True, rem[1:] != rem[:-1]])
    return rem[first], np.add.reduceat(n, first)


def merge_filters(filters: DataFrame, quotient_bits: int = 10) -> DataFrame:
    """Lossless merge of filter rows by sorted remainders -> (fp, n)."""
    parts = int(filters.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        at, held = None, None
        for b in batches:
            fps, counts = [], []
            for q, rem, n in zip(b.column("quotient").to_pylist(), b.column("remainders"), b.column("counts")):
                mine = (rem.values.to_numpy(), n.values.to_numpy())
                if q == at:
                    held = merge_runs(held, mine)
                    continue
                if held is not None:
                    fps.append(_fingerprints(at, held[0], quotient_bits))
                    counts.append(held[1])
                at, held = q, mine
            if fps:
                yield _merged(fps, counts)
        if held is not None:
            yield _merged([_fingerprints(at, held[0], quotient_bits)], [held[1]])
    return filters.repartition(parts, "quotient").sortWithinPartitions("quotient").mapInArrow(run, "fp long, n long")


def _fingerprints(quotient: int, remainders: np.ndarray, quotient_bits: int) -> np.ndarray:
    high = np.uint64(quotient) << np.uint64(64 - quotient_bits)
    return (high | remainders.view(np.uint64)).view(np.int64)


def _merged(fps, counts):
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(fps)), pa.array(np.concatenate(counts))], names=["fp", "n"])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("fp", F.xxhash64("text"))
    bits = quotient_bits_for(rows.count())
    filters = rows.select("fp").mapInArrow(lambda batches: build_filters(batches, bits), FILTER)
    repeated = written(merge_filters(filters, bits).where("n > 1").select("fp"), "repeated")
    routed = rows.join(repeated, "fp", "left_semi")
    # byte verification: the text is the grouping key; the sha256 is its name in the join below
    groups = routed.groupBy("text").agg(F.max("doc_id").alias("keep_id"),
                                        F.count(F.lit(1)).alias("group_size"))
    groups = groups.select(F.sha2("text", 256).alias("sha"), "keep_id", "group_size").where("group_size > 1")
    named = rows.select("doc_id", F.sha2("text", 256).alias("text_sha256"))
    out = named.join(groups, named.text_sha256 == groups.sha, "left")
    return out.select(
        "doc_id",
        F.coalesce("keep_id", "doc_id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("keep_id").isNull(), True).otherwise(
            F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""
