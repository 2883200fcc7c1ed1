"""Ranking at scale (W1-W4, W6-W8, L2, L4) and exact quantiles.

``row_number().over(Window.partitionBy(g).orderBy(v))`` puts each group in one
task; with two populations that is half the data per task. The distributed
rank below keeps every task bounded:

1. ``repartitionByRange(g, v, tiebreak)`` + ``sortWithinPartitions`` — a
   group may span many partitions, rows of a group are contiguous and ordered
   inside each partition;
2. reliable checkpoint, so the partition assignment is frozen (a recomputed
   range sample could otherwise move rows between partitions);
3. per (partition, group): row count and first ``monotonically_increasing_id``
   — at most #partitions + #groups rows;
4. prefix sums of those counts give each partition's offset inside its group;
5. rank = offset + position inside the partition slice.

The order must be total (callers pass a unique tie-break column), so the rank
is deterministic — unlike the reference, which breaks ties by row order.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from balances.functions.columns import level_from_rank
from balances.session import cut_lineage

# Offsets table rows above which it is joined by shuffle instead of broadcast.
OFFSETS_BROADCAST_MAX_ROWS = 200_000


def _ordering(order_cols, descending: bool):
    cols = []
    for c in order_cols:
        cc = F.col(c)
        cols.append(cc.desc() if descending else cc.asc())
    return cols


def distributed_row_number(df: DataFrame, group_cols, order_cols, descending: bool = False,
                           rn: str = "rn", n: str = "n",
                           num_partitions: int | None = None) -> DataFrame:
    """Adds ``rn`` (1-based position by ``order_cols`` inside ``group_cols``)
    and ``n`` (group size). ``order_cols`` must make the order total."""
    group_cols, order_cols = list(group_cols), list(order_cols)
    spark = df.sparkSession
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(g).asc_nulls_first() for g in group_cols] + _ordering(order_cols, descending)
    frozen = cut_lineage(
        df.repartitionByRange(num_partitions, *keys).sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id()))
    counts = (frozen.groupBy("_pid", *group_cols)
              .agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_base")))
    wg = Window.partitionBy(*group_cols)
    offsets = (counts
               .withColumn("_off", F.coalesce(F.sum("_cnt").over(
                   wg.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .withColumn(n, F.sum("_cnt").over(wg))
               .drop("_cnt"))
    # the offsets table has at most #partitions + #groups rows; its size is
    # checked before it is broadcast (many small groups -> shuffle join)
    if offsets.count() <= OFFSETS_BROADCAST_MAX_ROWS:
        offsets = F.broadcast(offsets)
    # null-safe on the group keys: a NULL population is a group of its own
    offsets = offsets.select("_pid", *[F.col(g).alias(f"_o_{g}") for g in group_cols],
                             "_base", "_off", n)
    cond = frozen["_pid"] == offsets["_pid"]
    for g in group_cols:
        cond = cond & frozen[g].eqNullSafe(offsets[f"_o_{g}"])
    joined = frozen.join(offsets, cond, "inner").drop(offsets["_pid"]).drop(
        *[f"_o_{g}" for g in group_cols])
    return (joined
            .withColumn(rn, (F.col("_off") + F.col("_mid") - F.col("_base") + 1).cast("long"))
            .withColumn(n, F.col(n).cast("long"))
            .drop("_pid", "_mid", "_base", "_off"))


def window_row_number(df: DataFrame, group_cols, order_cols, descending: bool = False,
                      rn: str = "rn", n: str = "n") -> DataFrame:
    """Small-group path (many groups, each bounded): plain window."""
    w = Window.partitionBy(*group_cols).orderBy(*_ordering(order_cols, descending))
    return (df.withColumn(rn, F.row_number().over(w).cast("long"))
            .withColumn(n, F.count(F.lit(1)).over(Window.partitionBy(*group_cols)).cast("long")))


def priority_levels(df: DataFrame, value_col: str, group_cols=("population",),
                    id_col: str = "customer_id", out: str = "level",
                    distributed: bool = True) -> DataFrame:
    """Quartile levels D..A of the percentile rank rn/n over non-null
    values inside each group (a NULL group is its own group); NULL value ->
    NULL level. Ties broken by ``id_col``. Not ntile(4)."""
    valid = df.where(F.col(value_col).isNotNull())
    rankf = distributed_row_number if distributed else window_row_number
    ranked = rankf(valid, group_cols, [value_col, id_col])
    ranked = ranked.withColumn(out, level_from_rank("rn", "n")).withColumn(
        "pct_rank", F.col("rn") / F.col("n"))
    nulls = (df.where(F.col(value_col).isNull())
             .withColumn("rn", F.lit(None).cast("long")).withColumn("n", F.lit(None).cast("long"))
             .withColumn(out, F.lit(None).cast("string"))
             .withColumn("pct_rank", F.lit(None).cast("double")))
    return ranked.unionByName(nulls)


def exact_quantiles(df: DataFrame, group_cols, value_col: str, probs, id_col: str | None = None,
                    distributed: bool = True) -> DataFrame:
    """Exact linear-interpolation quantiles (numpy 'linear' / quantile_cont)
    per group without collecting a group: rank, then pick the two order
    statistics around (n-1)p. One row per (group, p): group cols, p, value."""
    group_cols = list(group_cols)
    valid = df.where(F.col(value_col).isNotNull())
    order = [value_col] + ([id_col] if id_col else [])
    if not id_col:
        valid = valid.withColumn("_uid", F.monotonically_increasing_id())
        order = [value_col, "_uid"]
    rankf = distributed_row_number if distributed else window_row_number
    ranked = rankf(valid.select(*group_cols, *order), group_cols, order)
    # keep only the rows that are one of the wanted order statistics (at most
    # 2 x len(probs) per group) BEFORE expanding per probability: no blow-up
    # of the full input
    nn = F.col("n") - 1
    targets = F.array(*[x for p in probs for x in (F.floor(nn * float(p)) + 1, F.ceil(nn * float(p)) + 1)])
    few = ranked.where(F.array_contains(targets, F.col("rn")))
    ps = F.array(*[F.lit(float(p)) for p in probs])
    with_p = few.select(*group_cols, value_col, "rn", "n", F.explode(ps).alias("p"))
    h = (F.col("n") - 1) * F.col("p")
    lo, hi = F.floor(h) + 1, F.ceil(h) + 1
    picked = with_p.where((F.col("rn") == lo) | (F.col("rn") == hi))
    agg = picked.groupBy(*group_cols, "p").agg(
        F.min(value_col).alias("_vlo"), F.max(value_col).alias("_vhi"),
        F.first("n").alias("_n"))
    frac = (F.col("_n") - 1) * F.col("p") - F.floor((F.col("_n") - 1) * F.col("p"))
    return agg.select(*group_cols, "p",
                      (F.col("_vlo") + frac * (F.col("_vhi") - F.col("_vlo"))).alias(value_col))




def dense_keys(df: DataFrame, order_col: str, key: str) -> DataFrame:
    """Surrogate keys 1..n over the sorted distinct values of a small
    dimension (products, months): the distinct set is calendar/catalogue
    bounded."""
    d = df.select(order_col).where(F.col(order_col).isNotNull()).distinct()
    return d.withColumn(key, F.row_number().over(Window.orderBy(order_col)).cast("int"))
