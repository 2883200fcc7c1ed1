"""Exact order statistics from ranked *values* (W7, ST1, ST4, ST12, A15).

Rows are counted per (group, value) first, so a value that a third of all rows
share is one row from there on; prefix sums over the distinct values then give
``before``, the rows with a smaller value. That one table answers quantiles,
medians of either label, mid-ranks (U, AUC, Spearman) and binning: nothing
ranks rows.

A group with many distinct values is cut into blocks of about ``BLOCK_VALUES``
at its own approximate quantiles; prefix sums run inside a block, and the sums
of the blocks below (one row a block) are added.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from balances.session import materialise

#: Distinct values of a group that one task orders.
BLOCK_VALUES = 1_000_000
#: Rows of per-block sums that may go to every task.
BROADCAST_ROWS = 200_000


def value_counts(long: DataFrame, group_cols=("variable",)) -> DataFrame:
    """(group, value): t rows and, where there is a label y, its events."""
    y = F.sum("y") if "y" in long.columns else F.lit(0)
    return long.groupBy(*group_cols, "value").agg(F.count(F.lit(1)).alias("t"), y.cast("long").alias("events"))


def ranked_values(counts: DataFrame, group_cols=("variable",)) -> DataFrame:
    """``counts`` with ``before``, ``events_before`` (rows and events below the
    value), ``n`` and ``n_events`` (of the group, nulls left out). Null values
    keep one row a group with nothing before them."""
    g = list(group_cols)
    counts = materialise(counts, "value-counts")
    valid = counts.where(F.col("value").isNotNull())
    most = valid.groupBy(*g).agg(F.count(F.lit(1)).alias("k")).agg(F.max("k").alias("k")).first()["k"] or 0
    blocks = max(1, math.ceil(most / BLOCK_VALUES))
    if blocks == 1:
        parted = valid.withColumn("_b", F.lit(0))
    else:
        cuts = valid.groupBy(*g).agg(F.percentile_approx("value", [i / blocks for i in range(1, blocks)], 10 * blocks).alias("_cuts"))
        parted = _beside(valid, cuts, g).withColumn("_b", F.size(F.filter("_cuts", lambda c: c < F.col("value")))).drop("_cuts")
    below = Window.partitionBy(*g, "_b").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    inside = parted.withColumn("before", F.coalesce(F.sum("t").over(below), F.lit(0))).withColumn(
        "events_before", F.coalesce(F.sum("events").over(below), F.lit(0)))
    sums = parted.groupBy(*g, "_b").agg(F.sum("t").alias("_t"), F.sum("events").alias("_e"))
    all_ = Window.partitionBy(*g)  # one row a block
    lower = all_.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*g, "_b", F.coalesce(F.sum("_t").over(lower), F.lit(0)).alias("_t0"),
                       F.coalesce(F.sum("_e").over(lower), F.lit(0)).alias("_e0"),
                       F.sum("_t").over(all_).alias("n"), F.sum("_e").over(all_).alias("n_events"))
    out = _beside(inside, sums, [*g, "_b"]).select(
        *g, "value", "t", "events", (F.col("before") + F.col("_t0")).alias("before"),
        (F.col("events_before") + F.col("_e0")).alias("events_before"), "n", "n_events")
    none = F.lit(None).cast("long")
    nulls = counts.where(F.col("value").isNull()).select(
        *g, "value", "t", "events", *[none.alias(c) for c in ("before", "events_before", "n", "n_events")])
    return out.unionByName(nulls)


def _beside(rows: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Join a table of one row a group, null-safe, by broadcast while its
    counted size allows."""
    small = small.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in small.columns if c not in keys])
    small = F.broadcast(small) if small.count() <= BROADCAST_ROWS else small
    cond = F.lit(True)
    for k in keys:
        cond = cond & rows[k].eqNullSafe(small[f"_k_{k}"])
    return rows.join(small, cond).drop(*[f"_k_{k}" for k in keys])


def value_table(long: DataFrame, group_cols=("variable",)) -> DataFrame:
    return ranked_values(value_counts(long, group_cols), group_cols)


def of_label(table: DataFrame, label: int) -> DataFrame:
    """The same table over the rows with y = 1, or y = 0, alone."""
    own = {1: ("events", "events_before", "n_events")}.get(label)
    if own:
        t, before, n = map(F.col, own)
    else:
        t, before, n = F.col("t") - F.col("events"), F.col("before") - F.col("events_before"), F.col("n") - F.col("n_events")
    # read the old columns in one projection, so that none sees another's new value
    rest = [c for c in table.columns if c not in ("t", "before", "n")]
    return table.select(*rest, t.alias("t"), before.alias("before"), n.alias("n")).where("t > 0")


def without_value(table: DataFrame, value_col: str) -> DataFrame:
    """The same table without the rows of one value a group (in ``value_col``)."""
    w = Window.partitionBy("variable")  # a sum over the distinct values of the few variables that need it
    gone = F.sum(F.when(F.col("value") == F.col(value_col), F.col("t"))).over(w)
    rest = [c for c in table.columns if c not in ("before", "n")]
    out = table.select(*rest, (F.col("before") - F.when(F.col("value") > F.col(value_col), gone).otherwise(0)).alias("before"),
                       (F.col("n") - gone).alias("n"))
    return out.where(F.col("value") != F.col(value_col))


def mid_rank() -> F.Column:
    """The average rank of the rows that share a value."""
    return F.col("before") + (F.col("t") + 1) / 2.0


def quantiles(table: DataFrame, group_cols, probs) -> DataFrame:
    """Linear-interpolation quantiles: group columns, p, value."""
    g = list(group_cols)
    valid = table.where(F.col("value").isNotNull() & (F.col("n") > 0))

    def places(p):
        h = (F.col("n") - 1) * p
        return F.floor(h) + 1, F.ceil(h) + 1

    def here(k):
        return (F.col("before") < k) & (k <= F.col("before") + F.col("t"))
    wanted = F.lit(False)
    for p in probs:
        lo, hi = places(F.lit(float(p)))
        wanted = wanted | here(lo) | here(hi)
    few = valid.where(wanted)  # at most two values a probability
    each = few.select(*g, "value", "before", "t", "n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"))
    lo, hi = places(F.col("p"))
    agg = each.groupBy(*g, "p").agg(F.max(F.when(here(lo), F.col("value"))).alias("_lo"),
                                    F.max(F.when(here(hi), F.col("value"))).alias("_hi"), F.max("n").alias("_n"))
    h = (F.col("_n") - 1) * F.col("p")
    return agg.select(*g, "p", (F.col("_lo") + (h - F.floor(h)) * (F.col("_hi") - F.col("_lo"))).alias("value"))


def modes(table: DataFrame, group_cols=("variable",)) -> DataFrame:
    """Per group the most frequent value (the smallest of several) and the
    number of distinct values."""
    g = list(group_cols)
    valid = table.where(F.col("value").isNotNull())
    top = valid.groupBy(*g).agg(F.max("t").alias("_top"), F.count(F.lit(1)).alias("nunique"))
    return _beside(valid, top, g).where(F.col("t") == F.col("_top")).groupBy(*g).agg(
        F.min("value").alias("mode"), F.max("nunique").alias("nunique"))


def rank_correlation(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """ST12: the correlation of the mid-ranks of two columns, and n. ``pairs``
    is counted per (a, b); a rank is fetched per pair, for values that hold more
    than a thousandth of the rows (a thousand values at most) by broadcast, so
    that a tied value is no hot key."""
    both = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(
        F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b")).agg(F.count(F.lit(1)).alias("c"))
    both = materialise(both, "pair-counts")
    sides = both.select("c", F.explode(F.array(*[
        F.struct(F.lit(k).alias("variable"), F.col(k).alias("value")) for k in "ab"])).alias("s")).select("s.*", "c")
    counts = sides.groupBy("variable", "value").agg(F.sum("c").alias("t"), F.lit(0).cast("long").alias("events"))
    ranks = materialise(ranked_values(counts), "ranks").withColumn("r", mid_rank() - (F.col("n") + 1) / 2.0)
    out = both
    for k in "ab":
        mine = ranks.where(F.col("variable") == k)
        hot = F.broadcast(mine.where(F.col("t") * 1000 > F.col("n")).select(F.col("value").alias(k), F.col("r").alias(f"r_{k}")))
        cold = mine.where(F.col("t") * 1000 <= F.col("n")).select(F.col("value").alias(k), F.col("r").alias(f"r_{k}"))
        out = out.join(hot, k).unionByName(out.join(hot.select(k), k, "left_anti").join(cold, k))
    c, x, y = F.col("c"), F.col("r_a"), F.col("r_b")
    sums = out.agg(F.sum(c * x * y).alias("xy"), F.sum(c * x * x).alias("xx"), F.sum(c * y * y).alias("yy"), F.sum("c").alias("n"))
    return sums.select(F.when((F.col("xx") > 0) & (F.col("yy") > 0), F.col("xy") / F.sqrt(F.col("xx") * F.col("yy"))).alias("spearman"),
                       F.coalesce("n", F.lit(0)).cast("long").alias("n"))
