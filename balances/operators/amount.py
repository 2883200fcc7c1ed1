"""12-month amount: component panel, temporal backtest, error scenarios
(A11, J7, J8, J10, J13, M14, M16, T15-T19, ST14-ST16).

Every step is a groupBy on ``customer_id`` (or on month for the split):
``min_by``/``max_by`` with a date ordering pick the balance at the first /
last month of a customer's window in one hash aggregation, instead of
joining the window back to the panel twice.
"""
from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from balances.config import SETTINGS
from balances.functions.columns import annualised_growth, month_index
from balances.operators import stats

S = SETTINGS
COMPONENTS = {"app": list(S.label_products), "conservative": list(S.invest_non_label_products)}
SCENARIOS = ("conservative", "base", "optimistic")
#: The backtest's name for the sum of all components.
TOTAL = "total"


def component_runs(panel: DataFrame, components=COMPONENTS, last=None) -> DataFrame:
    """The component panel before its months are listed: (customer, month, _until)
    x balances that hold from month to _until, plus the invested total. A product
    changes only in its observed months and is carried up to the panel's last
    month (T7-T9), so only observed rows are shuffled, once, by customer; the
    months between them are no rows here. A panel of its observed rows alone
    (``panel.observed_months``) comes with its last month."""
    products = [p for ps in components.values() for p in ps]
    if last is None:
        last = panel.agg(F.max("month").alias("m")).first()["m"]  # one scalar
    seen = panel.where(F.col("product").isin(products) & (F.col("observed") == 1)).select(
        "customer_id", "product", "month", "balance_month").repartition("customer_id")
    wide = seen.groupBy("customer_id", "month").agg(
        *[F.sum(F.when(F.col("product") == p, F.col("balance_month"))).alias(f"_p_{p}") for p in products])
    w = Window.partitionBy("customer_id").orderBy("month")  # a customer's months: calendar-bounded
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    held = {p: F.coalesce(F.last(f"_p_{p}", ignorenulls=True).over(so_far), F.lit(0.0)) for p in products}
    runs = wide.select(
        "customer_id", "month",
        F.coalesce(F.add_months(F.lead("month").over(w), -1), F.lit(last).cast("date")).alias("_until"),
        *[reduce(add, [held[p] for p in ps]).alias(c) for c, ps in components.items()])
    return runs.withColumn("invested", reduce(add, [F.col(c) for c in components]))


def months_of(runs: DataFrame) -> DataFrame:
    """Every month of every run, in the order of the runs."""
    rest = [c for c in runs.columns if c not in ("customer_id", "month", "_until")]
    return runs.select("customer_id", F.explode(F.sequence("month", "_until", F.expr("INTERVAL 1 MONTH"))).alias("month"), *rest)


def component_panel(panel: DataFrame, components=COMPONENTS) -> DataFrame:
    """(customer, month) x component balances, missing component -> 0.0,
    plus the invested total, of a monthly panel (``panel.monthly_panel``). A panel
    that does not tell its observed months is summed row by row."""
    if "observed" in panel.columns:
        return months_of(component_runs(panel, components))
    inv = panel.where(F.col("product").isin([p for ps in components.values() for p in ps]))
    wide = inv.groupBy("customer_id", "month").agg(
        *[F.coalesce(F.sum(F.when(F.col("product").isin(ps), F.col("balance_month"))), F.lit(0.0)).alias(c) for c, ps in components.items()])
    return wide.withColumn("invested", reduce(add, [F.col(c) for c in components]))


def history_ids(comp: DataFrame) -> DataFrame:
    """Customers with an invested total > 0 in some month (of a component
    panel or its runs)."""
    return comp.groupBy("customer_id").agg(F.max("invested").alias("_m")).where(
        F.col("_m") > 0).select("customer_id")


def with_history(comp: DataFrame) -> DataFrame:
    """Restrict the component panel, or its runs, to the history population.
    The rows of a customer meet (calendar-bounded); those of ``component_runs``
    already do."""
    most = F.max("invested").over(Window.partitionBy("customer_id"))
    return comp.where(F.col("customer_id").isNotNull()).withColumn("_m", most).where(F.col("_m") > 0).drop("_m")


def split_month(comp: DataFrame, k: int = S.backtest_months) -> DataFrame:
    """First validation month (k-th latest distinct month); one row."""
    from balances.operators.panel import temporal_split_month
    return temporal_split_month(comp, k)


def window_targets(comp: DataFrame, components=COMPONENTS) -> DataFrame:
    """T15 + J10 + T16: per customer, shared window [first, last month] of the
    total, balance of each component at both ends (absent -> 0.0) and its
    annualised growth."""
    aggs = [F.min("month").alias("month_first"), F.max("month").alias("month_last")]
    for c in components:
        aggs += [F.min_by(c, "month").alias(f"{c}_start"), F.max_by(c, "month").alias(f"{c}_end")]
    w = comp.groupBy("customer_id").agg(*aggs)
    months = (month_index(F.col("month_last")) - month_index(F.col("month_first"))).cast("int")
    w = w.withColumn("months", months)
    for c in components:
        w = (w.withColumn(f"{c}_start", F.coalesce(f"{c}_start", F.lit(0.0)))
             .withColumn(f"{c}_end", F.coalesce(f"{c}_end", F.lit(0.0)))
             .withColumn(f"{c}_growth", annualised_growth(f"{c}_start", f"{c}_end", "months")))
    return w


def trend_feature(start, end, months) -> F.Column:
    """(end - start) / months, 0 months -> NULL."""
    return F.try_divide(F.col(end) - F.col(start), F.col(months).cast("double"))


def backtest(comp: DataFrame, valid_start, components=COMPONENTS) -> DataFrame:
    """T18 + persistence forecast: real = annualised growth over the
    validation months (first -> last, scaled by n_valid_months - 1, at least
    1); prediction = annualised growth over the training window. One row per
    (customer, component) with both present, and per customer with every
    component one for the total (J13)."""
    vs = F.lit(valid_start).cast("date")
    train = window_targets(comp.where(F.col("month") < vs), components)
    valid = comp.where(F.col("month") >= vs)
    n_valid = valid.select("month").distinct().count()  # calendar-bounded scalar
    denom = max(n_valid - 1, 1)
    aggs = []
    for c in components:
        aggs += [F.min_by(c, "month").alias(f"{c}_first"), F.max_by(c, "month").alias(f"{c}_last")]
    v = valid.groupBy("customer_id").agg(*aggs)
    j = train.join(v, "customer_id", "inner")  # present in both windows
    parts = []
    for c in components:
        parts.append(j.select(
            "customer_id", F.lit(c).alias("component"),
            annualised_growth(f"{c}_first", f"{c}_last", F.lit(denom)).alias("real"),
            F.col(f"{c}_growth").alias("pred")).where(F.col("pred").isNotNull()))
    return with_total(reduce(DataFrame.unionByName, parts))


def with_total(bt: DataFrame, components=COMPONENTS) -> DataFrame:
    """The backtest (customer_id, component, real, pred) with the total of
    all components, over the customers who have every one, and the errors. One
    hash aggregation by customer; nothing is forecast for the total itself."""
    both = bt.groupBy("customer_id").agg(
        F.sum("real").alias("real"), F.sum("pred").alias("pred"),
        F.count(F.when(F.col("real").isNotNull() & F.col("pred").isNotNull(), 1)).alias("_n"))
    total = both.where(F.col("_n") == len(components)).select(
        "customer_id", F.lit(TOTAL).alias("component"), "real", "pred")
    return bt.unionByName(total).withColumn("error", F.col("real") - F.col("pred"))


def error_evidence(bt: DataFrame) -> DataFrame:
    """ST16: per component, share of negative errors, modal error, its mass."""
    e = bt.where(F.col("error").isNotNull())
    counts = e.groupBy("component", "error").agg(F.count(F.lit(1)).alias("_c"))
    modal = counts.groupBy("component").agg(
        F.max_by("error", F.struct(F.col("_c"), -F.col("error"))).alias("modal_error"),
        (F.max("_c") / F.sum("_c")).alias("modal_mass"))
    neg = e.groupBy("component").agg(F.avg((F.col("error") < 0).cast("double")).alias("pct_negative"))
    return neg.join(modal, "component")


def scenarios_by_component(bt: DataFrame, p_lo: float = 10, p_hi: float = 90) -> DataFrame:
    """ST15 for every component in one job: one row per component present,
    zeros for a component without errors."""
    q = stats.error_scenarios(bt, "error", "customer_id", p_lo, p_hi, group_cols=["component"])
    comps = bt.sparkSession.createDataFrame([(c,) for c in (*COMPONENTS, TOTAL)], "component string")
    return comps.join(q, "component", "left").fillna(0.0, subset=["err_lo", "err_median", "err_hi"])


def amount_scenarios(full_targets: DataFrame, scen: DataFrame,
                     components=COMPONENTS) -> DataFrame:
    """Per customer and component pred + {lo, median, hi} error, then
    totals scenario by scenario. A component without a row for the customer is
    0.0; a growth that cannot be known (one month of history) stays NULL, and
    so does the total. ``scen`` has one row per component, so it is broadcast
    (bounded by the component count); scenarios out of order are refused."""
    rows = None
    scen = scen.withColumn("err_lo", F.when(
        F.col("err_lo") <= F.col("err_hi"), F.col("err_lo")).otherwise(
        F.raise_error(F.lit("scenario errors out of order")).cast("double")))
    sc = F.broadcast(scen)  # one row per component
    for c in components:
        part = (full_targets.select("customer_id", F.lit(c).alias("component"),
                                    F.col(f"{c}_growth").alias("_pred"))
                .join(sc, "component", "left"))
        part = part.select(
            "customer_id", F.lit(True).alias(f"_has_{c}"),
            (F.col("_pred") + F.col("err_lo")).alias(f"amount_{c}_12m_conservative"),
            (F.col("_pred") + F.col("err_median")).alias(f"amount_{c}_12m_base"),
            (F.col("_pred") + F.col("err_hi")).alias(f"amount_{c}_12m_optimistic"))
        rows = part if rows is None else rows.join(part, "customer_id", "full")
    for c in components:  # absent component -> 0, unknown growth -> NULL
        for s in SCENARIOS:
            name = f"amount_{c}_12m_{s}"
            rows = rows.withColumn(name, F.when(F.col(f"_has_{c}").isNull(), F.lit(0.0)).otherwise(F.col(name)))
    rows = rows.drop(*[f"_has_{c}" for c in components])
    for s in SCENARIOS:
        rows = rows.withColumn(f"amount_{s}_12m",
                               reduce(add, [F.col(f"amount_{c}_12m_{s}") for c in components]))
    return rows
