"""Statistical battery over many variables at once (ST1-ST16, W6, W7, M6, ST12).

Variables are unpivoted to long form ``(id, variable, value, y)`` and counted per
(variable, value) in one shuffle; ``order_stats`` ranks those values, and every
statistic of this module reads that table. P-values are column expressions with
closed forms, which SQL can repeat.
"""
from __future__ import annotations

import math
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from balances.config import SETTINGS
from balances.functions.columns import iv_class
from balances.operators import order_stats
from balances.operators.rank import distributed_row_number, exact_quantiles
from balances.session import cut_lineage, materialise

S = SETTINGS
#: What is left of a column's variance, as a share, that counts as none.
VIF_TINY = 1e-10
DECILES = [i / S.n_bins for i in range(S.n_bins + 1)]


# ---------------------------------------------------------------- long form
def to_long(df: DataFrame, id_col: str, value_cols, label_col: str | None = None,
            as_string: bool = False) -> DataFrame:
    """Unpivot value columns to (id, [y,] variable, value)."""
    t = "string" if as_string else "double"
    ids = [id_col] + ([label_col] if label_col else [])
    sel = df.select(*ids, *[F.col(c).cast(t).alias(c) for c in value_cols])
    long = sel.unpivot(ids, list(value_cols), "variable", "value")
    return long.withColumnRenamed(label_col, "y") if label_col else long


# ---------------------------------------------------------------- ST1 binning
def numeric_bin_edges(table: DataFrame, n_bins: int = S.n_bins) -> DataFrame:
    """Per variable of a value table: kind ('value' when <= n_bins distinct, else
    'quantile' or 'mode'), decile edges (duplicates dropped), and the mode
    fallback edges (deciles of what is not the mode). One row per variable."""
    def edges(t, name):
        return order_stats.quantiles(t, ["variable"], DECILES).groupBy("variable").agg(
            F.array_sort(F.array_distinct(F.collect_list("value"))).alias(name))
    # one row per variable: materialise it, then run the mode fallback only
    # for the variables whose deciles collapsed to a single bin
    info = cut_lineage(order_stats.modes(table).join(edges(table, "edges"), "variable", "left"))
    need_mode = info.where((F.col("nunique") > n_bins) & (F.size("edges") < 3)).select("variable", "mode")
    if need_mode.isEmpty():
        info = info.withColumn("edges_rest", F.lit(None).cast("array<double>"))
    else:
        rest = order_stats.without_value(
            table.where(F.col("value").isNotNull()).join(F.broadcast(need_mode), "variable"), "mode")
        info = info.join(edges(rest, "edges_rest"), "variable", "left")
    kind = (F.when(F.col("nunique") <= n_bins, F.lit("value"))
            .when(F.size("edges") >= 3, F.lit("quantile")).otherwise(F.lit("mode")))
    return info.select("variable", kind.alias("kind"), "mode",
                       F.when(kind == "quantile", F.col("edges"))
                        .when(kind == "mode", F.col("edges_rest")).alias("edges"))


def assign_numeric_bins(long: DataFrame, edges: DataFrame) -> DataFrame:
    """Bin of every row (of a long table or a value table): (bin_kind, bin_lo,
    bin_hi). Right-closed intervals, lowest included; bin index = number of
    inner edges below the value."""
    j = long.join(F.broadcast(edges), "variable", "left")
    e = F.col("edges")
    inner = F.slice(e, 2, F.greatest(F.size(e) - 2, F.lit(0)))
    idx = F.size(F.filter(inner, lambda x: x < F.col("value")))
    lo, hi = F.element_at(e, idx + 1), F.element_at(e, idx + 2)
    v = F.col("value")
    is_null = v.isNull()
    is_mode = (F.col("kind") == "mode") & (v == F.col("mode"))
    by_value = (F.col("kind") == "value") | ((F.col("kind") == "mode") & (F.size(e) < 2))
    kind = (F.when(is_null, F.lit("missing")).when(is_mode, F.lit("mode"))
            .when(by_value, F.lit("value")).otherwise(F.lit("quantile")))
    return j.select(
        *[c for c in long.columns],
        kind.alias("bin_kind"),
        F.when(is_null, None).when(is_mode | by_value, v).otherwise(lo).alias("bin_lo"),
        F.when(is_null, None).when(is_mode | by_value, v).otherwise(hi).alias("bin_hi"))


def woe_table(binned: DataFrame, bin_cols) -> DataFrame:
    """ST2: per (variable, bin) of counted values (t, events): n, events, WoE =
    ln(%non-events / %events) with the +0.5 correction, and the IV contribution."""
    eps = S.woe_eps
    g = binned.groupBy("variable", *bin_cols).agg(F.sum("t").alias("n"), F.sum("events").cast("long").alias("events"))
    w = Window.partitionBy("variable")  # bins per variable: bounded (<= ~n_bins + 2)
    g = (g.withColumn("non_events", F.col("n") - F.col("events"))
         .withColumn("_E", F.sum("events").over(w))
         .withColumn("_NE", F.sum("non_events").over(w))
         .withColumn("_k", F.count(F.lit(1)).over(w)))
    pe = (F.col("events") + eps) / (F.col("_E") + eps * F.col("_k"))
    pne = (F.col("non_events") + eps) / (F.col("_NE") + eps * F.col("_k"))
    woe = F.log(pne / pe)
    return g.select("variable", *bin_cols, F.col("n").cast("long"), "events",
                    woe.alias("woe"), ((pne - pe) * woe).alias("iv_bin"))


def iv_summary(woe: DataFrame) -> DataFrame:
    """IV per variable and its class (ST3)."""
    return woe.groupBy("variable").agg(F.sum("iv_bin").alias("iv")).withColumn(
        "iv_class", iv_class("iv"))


BIN_COLS = ["bin_kind", "bin_lo", "bin_hi"]


def woe_numeric(table: DataFrame) -> DataFrame:
    """WoE of every variable of a value table: values are binned, not rows."""
    return woe_table(assign_numeric_bins(table, numeric_bin_edges(table)), BIN_COLS)


def woe_categorical(df: DataFrame, id_col: str, cols, label_col: str) -> DataFrame:
    """Categorical variables: the value is the bin, NULL is 'Sin dato'."""
    counts = order_stats.value_counts(to_long(df, id_col, cols, label_col, as_string=True))
    binned = counts.withColumn("bin", F.coalesce(F.col("value"), F.lit(S.missing_label)))
    return woe_table(binned, ["bin"])


# ---------------------------------------------------------------- ranks
def values_of(df: DataFrame, id_col: str, cols, label_col: str | None = None) -> DataFrame:
    """The value table of several columns."""
    return order_stats.value_table(to_long(df, id_col, cols, label_col))


def _z(u, n1, n0, tie_term):
    """Normal approximation of U with tie and continuity correction."""
    n = n1 + n0
    sigma = F.sqrt(n1 * n0 / 12.0 * ((n + 1) - tie_term / (n * (n - 1))))
    return F.when((n1 > 0) & (n0 > 0) & (sigma > 0), (F.greatest(u, n1 * n0 - u) - n1 * n0 / 2.0 - 0.5) / sigma)


def mann_whitney(table: DataFrame) -> DataFrame:
    """ST4: two-sided U for y=1 vs y=0 per variable of a value table, with tie
    correction and continuity correction. U = R1 - n1(n1+1)/2."""
    g = table.where(F.col("value").isNotNull()).groupBy("variable").agg(
        F.sum(order_stats.mid_rank() * F.col("events")).alias("r1"),
        F.max("n_events").alias("n1"), F.max("n").alias("n"),
        F.sum(F.pow(F.col("t"), 3) - F.col("t")).alias("tie_term"))
    n1, n0 = F.col("n1"), F.col("n") - F.col("n1")
    u = F.col("r1") - n1 * (n1 + 1) / 2.0
    return g.select("variable", n1.cast("long").alias("n_event"), n0.cast("long").alias("n_non_event"),
                    F.when((n1 > 0) & (n0 > 0), u).alias("u"), _z(u, n1, n0, F.col("tie_term")).alias("z"))


def group_medians(table: DataFrame) -> DataFrame:
    """Exact medians of each variable for y=1 and y=0."""
    one, zero = (order_stats.quantiles(order_stats.of_label(table, y), ["variable"], [0.5]) for y in (1, 0))
    return one.select("variable", F.col("value").alias("median_event")).join(
        zero.select("variable", F.col("value").alias("median_non_event")), "variable", "full")


def one_vs_rest(df: DataFrame, id_col: str, attrs, score_col: str) -> DataFrame:
    """ST5: each group of each attribute against all others: n, mean, median, U,
    z and p of the score. One value table of the score serves all attributes:
    R_g = sum over values of mid-rank times the group's rows with that value."""
    x = df.select(id_col, F.col(score_col).cast("double").alias("value"),
                  *[F.coalesce(F.col(a).cast("string"), F.lit(S.missing_label)).alias(a) for a in attrs]).where(F.col("value").isNotNull())
    scores = materialise(order_stats.value_table(x.select(F.lit(score_col).alias("variable"), "value")), "score-values")
    cells = x.unpivot(["value"], list(attrs), "attribute", "group")
    by_group = materialise(order_stats.value_table(cells, ["attribute", "group"]), "group-values")
    # both sides have a tied score value once (a group), so it is no hot key
    ranked = by_group.select("attribute", "group", "value", F.col("t").alias("c")).join(
        scores.select("value", order_stats.mid_rank().alias("mid_rank")), "value")
    g = ranked.groupBy("attribute", "group").agg(
        # exact decimals: the mean of amounts must not depend on the order of a sum
        F.sum("c").alias("n"), (F.sum(F.col("value").cast("decimal(24,6)") * F.col("c").cast("decimal(12)")).cast("double") / F.sum("c")).alias("mean"),
        F.sum(F.col("mid_rank") * F.col("c")).alias("r_g"))
    tie = scores.agg(F.sum(F.pow(F.col("t"), 3) - F.col("t")).alias("tie_term"), F.max("n").alias("n_all"))
    median = order_stats.quantiles(by_group, ["attribute", "group"], [0.5]).select("attribute", "group", F.col("value").alias("median"))
    row = tie.first()  # one scalar pair
    g = g.join(median, ["attribute", "group"], "left")
    ng, nr = F.col("n"), F.lit(row["n_all"]).cast("long") - F.col("n")
    u = F.col("r_g") - ng * (ng + 1) / 2.0
    z = _z(u, ng, nr, F.lit(row["tie_term"]).cast("double"))
    return g.select("attribute", "group", ng.cast("long").alias("n"), "mean", "median",
                    F.when(nr > 0, u).alias("u"), z.alias("z"), p_from_z(z).alias("p_value"))


def auc_exact(df: DataFrame, id_col: str, score_col: str, label_col: str,
              group_cols=()) -> DataFrame:
    """M6: exact AUC = U1 / (n1 n0) from mid-ranks (ties count one half)."""
    gc = list(group_cols) or ["variable"]
    long = df.select(*(group_cols or [F.lit(score_col).alias("variable")]), F.col(label_col).alias("y"),
                     F.col(score_col).cast("double").alias("value"))
    table = order_stats.value_table(long, gc).where(F.col("value").isNotNull())
    g = table.groupBy(*gc).agg(F.sum(order_stats.mid_rank() * F.col("events")).alias("r1"),
                               F.max("n_events").alias("n1"), F.max("n").alias("n"))
    n1, n0 = F.col("n1"), F.col("n") - F.col("n1")
    auc = F.when((n1 > 0) & (n0 > 0), (F.col("r1") - n1 * (n1 + 1) / 2.0) / (n1 * n0))
    return g.select(*gc, n1.cast("long").alias("n_pos"), n0.cast("long").alias("n_neg"),
                    auc.alias("auc"))


def auc_of_counts(counts: DataFrame, group_cols, cuts) -> DataFrame:
    """M6 of counted scores (group, value, t rows, events), a value in any number of
    rows, for groups that are many and large: blocks of values between ``cuts`` are
    shuffled once and ranked each by itself, and the rows of the blocks below are
    added. Columns: group, auc."""
    g = list(group_cols)
    # without cuts no literal either: grouping drops those, and would then shuffle again
    block = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c < F.col("value"))) if cuts else F.isnull("value").cast("int")
    per = counts.withColumn("_b", block).repartition(*g, "_b").groupBy(*g, "_b", "value").agg(
        F.sum("t").alias("t"), F.sum("events").alias("events"))
    below = Window.partitionBy(*g, "_b").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("before", F.coalesce(F.sum("t").over(below), F.lit(0)))
    blocks = per.groupBy(*g, "_b").agg(F.sum(order_stats.mid_rank() * F.col("events")).alias("r"),
                                       F.sum("t").alias("n"), F.sum("events").alias("n1"))
    lower = Window.partitionBy(*g).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # one row a block
    blocks = blocks.withColumn("r", F.col("r") + F.coalesce(F.sum("n").over(lower), F.lit(0)) * F.col("n1"))
    whole = blocks.groupBy(*g).agg(F.sum("r").alias("r1"), F.sum("n").alias("n"), F.sum("n1").alias("n1"))
    n1, n0 = F.col("n1"), F.col("n") - F.col("n1")
    return whole.select(*g, F.when((n1 > 0) & (n0 > 0), (F.col("r1") - n1 * (n1 + 1) / 2.0) / (n1 * n0)).alias("auc"))


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """ST12: Pearson correlation of the mid-ranks of two columns (rows where
    both are non-null)."""
    return order_stats.rank_correlation(df.select(a, b), a, b)


# ---------------------------------------------------------------- chi-square
def chi2_cramer(df: DataFrame, cols, label_col: str) -> DataFrame:
    """ST6: chi-square of independence (category incl. 'Sin dato') x binary
    label, Yates-corrected when dof = 1, and Cramér's V. Each category row
    carries both label cells, so zero cells are present without a grid."""
    long = df.select(F.col(label_col).alias("y"),
                     *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        ["y"], list(cols), "variable", "value")
    cat = long.withColumn("category", F.coalesce("value", F.lit(S.missing_label)))
    per = cat.groupBy("variable", "category").agg(
        F.count(F.lit(1)).alias("n_i"), F.sum("y").alias("e_i"))
    w = Window.partitionBy("variable")  # categories per variable: bounded
    per = (per.withColumn("N", F.sum("n_i").over(w)).withColumn("E", F.sum("e_i").over(w))
           .withColumn("r", F.count(F.lit(1)).over(w)))
    c_cols = (F.when(F.col("E") > 0, 1).otherwise(0) + F.when(F.col("N") - F.col("E") > 0, 1)
              .otherwise(0))
    per = per.withColumn("c", c_cols)
    dof = (F.col("r") - 1) * (F.col("c") - 1)
    exp1 = F.col("n_i") * F.col("E") / F.col("N")
    exp0 = F.col("n_i") * (F.col("N") - F.col("E")) / F.col("N")
    o1, o0 = F.col("e_i"), F.col("n_i") - F.col("e_i")
    yates = F.when(dof == 1, 0.5).otherwise(0.0)

    def term(o, e):
        return F.when(e > 0, F.pow(F.greatest(F.abs(o - e) - yates, F.lit(0.0)), 2) / e).otherwise(0.0)

    per = per.withColumn("cell", term(o1, exp1) + term(o0, exp0)).withColumn("dof", dof)
    g = per.groupBy("variable").agg(
        F.sum("cell").alias("chi2"), F.first("dof").alias("dof"), F.first("N").alias("n"),
        F.first("r").alias("r"), F.first("c").alias("c"))
    k = F.least(F.col("r"), F.col("c")) - 1
    ok = (F.col("r") >= 2) & (F.col("c") >= 2)
    return g.select("variable", F.when(ok, F.col("chi2")).alias("chi2"),
                    F.when(ok, F.col("dof")).otherwise(0).cast("int").alias("dof"),
                    F.when(ok & (k > 0), F.sqrt(F.col("chi2") / (F.col("n") * k))).alias("cramers_v"),
                    F.col("n").cast("long").alias("n"))


# ---------------------------------------------------------------- BH / FDR
def benjamini_hochberg(df: DataFrame, p_col: str, id_col: str, alpha: float = 0.05,
                       group_cols=()) -> DataFrame:
    """ST7/W6: q_i = min_{j >= i} p_(j) n / j, clipped at 1; reject q <= alpha.
    A NULL p fails the job. Distributed: rank by p, per-partition suffix
    minimum, then a suffix minimum over partitions (one row per partition)."""
    checked = df.withColumn(p_col, F.when(F.col(p_col).isNull(), F.raise_error(
        F.lit("benjamini_hochberg: NULL p-value"))).otherwise(F.col(p_col)).cast("double"))
    gc = list(group_cols)
    ranked = distributed_row_number(checked, gc, [p_col, id_col])
    ranked = ranked.withColumn("_adj", F.col(p_col) * F.col("n") / F.col("rn"))
    # block = ceil(rn / B): suffix min inside blocks, then across blocks
    blk = F.floor((F.col("rn") - 1) / F.lit(1 << 16))
    ranked = ranked.withColumn("_blk", blk)
    wb = Window.partitionBy(*gc, "_blk").orderBy(F.col("rn").desc()).rowsBetween(
        Window.unboundedPreceding, 0)
    ranked = ranked.withColumn("_smin_in", F.min("_adj").over(wb))
    blocks = ranked.groupBy(*gc, "_blk").agg(F.min("_adj").alias("_bmin"))
    wa = Window.partitionBy(*gc).orderBy(F.col("_blk").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_after", F.min("_bmin").over(wa)).drop("_bmin")
    out = ranked.join(blocks, [*gc, "_blk"], "left")
    q = F.least(F.least(F.col("_smin_in"), F.coalesce(F.col("_after"), F.col("_smin_in"))), F.lit(1.0))
    return (out.withColumn("q_value", q).withColumn("reject", (q <= alpha).cast("int"))
            .drop("_adj", "_blk", "_smin_in", "_after"))


# ---------------------------------------------------------------- VIF
def correlation_3(df: DataFrame, a: str, b: str, c: str) -> DataFrame:
    """ST8 closed form for three variables: VIF_j = 1 / (1 - R^2_j) with R^2
    from the pairwise correlations; rows with any NULL dropped."""
    x = df.where(F.col(a).isNotNull() & F.col(b).isNotNull() & F.col(c).isNotNull())
    r = x.agg(F.corr(a, b).alias("rab"), F.corr(a, c).alias("rac"), F.corr(b, c).alias("rbc"),
              F.count(F.lit(1)).alias("n"))

    def vif(r1, r2, r3):  # variable correlated r1, r2 with the others, r3 between others
        r2j = (F.pow(r1, 2) + F.pow(r2, 2) - 2 * r1 * r2 * r3) / (1 - F.pow(r3, 2))
        return F.when(r2j >= 1 - 1e-12, F.lit(float("inf"))).otherwise(1 / (1 - r2j))

    rab, rac, rbc = F.col("rab"), F.col("rac"), F.col("rbc")
    parts = [r.select(F.lit(a).alias("variable"), vif(rab, rac, rbc).alias("vif")),
             r.select(F.lit(b).alias("variable"), vif(rab, rbc, rac).alias("vif")),
             r.select(F.lit(c).alias("variable"), vif(rac, rbc, rab).alias("vif"))]
    return reduce(DataFrame.unionByName, parts)


def cross_products(x: DataFrame, cols) -> DataFrame:
    """(i, j, s): for i <= j the sum over all rows of column i times column j. Each
    task multiplies its rows as a matrix and leaves one row a pair, which are
    summed by pair: k(k+1)/2 sums of one projection would be too long a method for
    the JVM to compile."""
    k = len(cols)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        total = np.zeros((k, k))
        for b in batches:
            a = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(k)])
            with np.errstate(all="ignore"):
                total += a.T @ a
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i.astype(np.int32)), "j": pa.array(j.astype(np.int32)), "s": pa.array(total[i, j])})
    return x.select(*cols).mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))


def vif_general(df: DataFrame, cols) -> pd.DataFrame:
    """ST8 for k columns: one aggregation gives the centred cross products
    (k(k+1)/2 sums, computed around the column means for precision). On the
    driver, where k is the variable count, the correlation matrix is swept of all
    other columns: what is left of a column's 1 is 1 - R^2, and VIF its inverse.
    A pivot below ``VIF_TINY`` is a column that the swept ones explain, and is
    skipped. A constant column is inf and leaves the others as they are; a column
    that others explain exactly is inf; n <= k -> NaN."""
    import numpy as np
    x = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    means = x.agg(*[F.avg(c).alias(c) for c in cols], F.count(F.lit(1)).alias("_n")).first()
    n = means["_n"]
    k = len(cols)
    if n is None or n <= k:
        return pd.DataFrame({"variable": cols, "vif": [float("nan")] * k})
    cen = x.select(*[(F.col(c) - F.lit(means[c])).alias(c) for c in cols])
    m = np.zeros((k, k))
    for r in cross_products(cen, cols).collect():  # a row a pair of variables
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["s"]
    d = np.sqrt(np.diag(m))
    live = d > 1e-9 * np.sqrt(n) * np.maximum(1.0, np.abs([means[c] for c in cols]))
    scale = np.where(live, d, 1.0)
    corr = np.where(np.outer(live, live), m / np.outer(scale, scale), 0.0)
    vifs = []
    for at in range(k):
        left = corr.copy()
        for pivot in range(k):
            if pivot != at and left[pivot, pivot] > VIF_TINY:
                left = left - np.outer(left[:, pivot], left[pivot]) / left[pivot, pivot]
        vifs.append(1.0 / left[at, at] if left[at, at] > VIF_TINY else np.inf)
    return pd.DataFrame({"variable": list(cols), "vif": [float(v) for v in vifs]})


# ---------------------------------------------------------------- lift, errors
def conditional_lift(df: DataFrame, a: str, b: str) -> DataFrame:
    """ST13: P(B|A) / P(B|not A); empty A or not-A -> NULL; zero denominator
    -> 0 when the numerator is 0, else +inf."""
    g = df.agg(F.count_if(F.col(a) == 1).alias("n_a"),
               F.count_if((F.col(a) == 1) & (F.col(b) == 1)).alias("n_ab"),
               F.count_if(F.col(a) != 1).alias("n_not_a"),
               F.count_if((F.col(a) != 1) & (F.col(b) == 1)).alias("n_not_a_b"))
    pba = F.col("n_ab") / F.col("n_a")
    pbn = F.col("n_not_a_b") / F.col("n_not_a")
    lift = (F.when((F.col("n_a") == 0) | (F.col("n_not_a") == 0), F.lit(None).cast("double"))
            .when(F.col("n_not_a_b") == 0, F.when(F.col("n_ab") == 0, F.lit(0.0))
                  .otherwise(F.lit(float("inf"))))
            .otherwise(pba / pbn))
    return g.select(*[F.col(c).cast("long") for c in ("n_a", "n_ab", "n_not_a", "n_not_a_b")],
                    lift.alias("lift"))


def mae_mape(df: DataFrame, real: str, pred: str, eps: float = 1.0, group_cols=()) -> DataFrame:
    """ST14: MAE over finite pairs; APE over |real| > eps: mean and median as
    ratios (not percentages); n and n_ape. Per group when ``group_cols`` is
    given (all groups in one job; the medians join back on the group key)."""
    gc = list(group_cols) or ["_g"]
    ok = df.where(F.col(real).isNotNull() & F.col(pred).isNotNull()
                  & ~F.isnan(real) & ~F.isnan(pred))
    if not group_cols:
        ok = ok.withColumn("_g", F.lit(1))
    ape = F.abs((F.col(real) - F.col(pred)) / F.abs(F.col(real)))
    valid = F.abs(F.col(real)) > eps
    g = ok.withColumn("_ape", F.when(valid, ape)).withColumn("_id", F.monotonically_increasing_id())
    base = g.groupBy(*gc).agg(F.avg(F.abs(F.col(real) - F.col(pred))).alias("mae"),
                              F.avg("_ape").alias("ape_mean"),
                              F.count(F.lit(1)).cast("long").alias("n"),
                              F.count("_ape").cast("long").alias("n_ape"))
    med = exact_quantiles(g.select(*gc, F.col("_ape").alias("value"), "_id"),
                          gc, "value", [0.5], id_col="_id")
    out = base.join(med.select(*gc, F.col("value").alias("ape_median_ratio")), gc, "left")
    return out.drop("_g") if not group_cols else out


def error_scenarios(errors: DataFrame, err_col: str, id_col: str,
                    p_lo: float = 10, p_hi: float = 90, group_cols=()) -> DataFrame:
    """ST15: (p_lo, median, p_hi) linear percentiles of the backtest error;
    one row (per group when ``group_cols``). Empty -> zeros. Applied to
    predictions by a keyed broadcast join (one row per group)."""
    gc = list(group_cols) or ["_g"]
    finite = errors.where(F.col(err_col).isNotNull() & ~F.isnan(err_col))
    if not group_cols:
        finite = finite.withColumn("_g", F.lit(1))
    finite = finite.select(*gc, F.col(err_col).alias("value"), id_col)
    q = exact_quantiles(finite, gc, "value", [p_lo / 100, 0.5, p_hi / 100], id_col=id_col)
    row = q.groupBy(*gc).agg(
        F.max(F.when(F.col("p") == p_lo / 100, F.col("value"))).alias("err_lo"),
        F.max(F.when(F.col("p") == 0.5, F.col("value"))).alias("err_median"),
        F.max(F.when(F.col("p") == p_hi / 100, F.col("value"))).alias("err_hi"))
    if not group_cols:
        # a one-row answer even when there is no error at all
        row = errors.sparkSession.range(1).select(F.lit(1).alias("_g")).join(row, "_g", "left").drop("_g")
    return row.select(*list(group_cols), *[F.coalesce(F.col(c), F.lit(0.0)).alias(c)
                                           for c in ("err_lo", "err_median", "err_hi")])


# ---------------------------------------------------------------- p-values
#: Step and number of terms of the trapezoidal sum below (fixed values).
ERFC_STEP, ERFC_TERMS = 0.5, 13


def erfc(x: F.Column) -> F.Column:
    """Complementary error function of x >= 0 to about 1e-14: the trapezoidal sum
    of its integral, whose error has the closed form that is taken off."""
    h = ERFC_STEP
    terms = 1.0 / (2.0 * x * x)
    for k in range(1, ERFC_TERMS + 1):
        terms = terms + math.exp(-k * k * h * h) / (k * k * h * h + x * x)
    value = 2.0 * h * x * F.exp(-x * x) / math.pi * terms - F.when(x < 6.0, 2.0 / (F.exp(2.0 * math.pi * x / h) - 1.0)).otherwise(0.0)
    return F.when(x < 1e-5, 1.0 - 2.0 * x / math.sqrt(math.pi)).otherwise(F.greatest(value, F.lit(0.0)))


def p_from_z(z) -> F.Column:
    """Two-sided normal p-value."""
    z = F.col(z) if isinstance(z, str) else z
    return F.when(z.isNotNull() & ~F.isnan(z), erfc(F.abs(z) / math.sqrt(2.0)))


def p_from_chi2(chi2, dof) -> F.Column:
    """Upper tail of the chi-square distribution: for even degrees of freedom a
    finite sum, for odd ones that sum beside erfc."""
    x = F.col(chi2) if isinstance(chi2, str) else chi2
    k = F.col(dof) if isinstance(dof, str) else dof
    half = x / 2.0
    odd = (k % 2) == 1
    # terms exp(-h) h^a / gamma(a + 1), a = 0, 1, .. or 1/2, 3/2, ..
    first = F.when(odd, F.exp(-half) * F.sqrt(half) * (2.0 / math.sqrt(math.pi))).otherwise(F.exp(-half))
    step = F.when(odd, F.lit(0.5)).otherwise(F.lit(0.0))
    n = F.floor(F.when(odd, (k - 1) / 2).otherwise(k / 2)).cast("int")
    start = F.struct(F.lit(0.0).alias("sum"), first.alias("term"))
    total = F.aggregate(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), start, lambda acc, i: F.struct(
        (acc["sum"] + acc["term"]).alias("sum"), (acc["term"] * half / (i + step)).alias("term")), lambda acc: acc["sum"])
    tail = F.when(odd, erfc(F.sqrt(half))).otherwise(F.lit(0.0)) + total
    return F.when(x.isNotNull() & (k > 0), F.when(x <= 0, F.lit(1.0)).otherwise(tail))
