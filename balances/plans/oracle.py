"""DuckDB oracle SQL for every registered query (run by the driver on the
same parquet files, tables pre-registered as views).

The CTEs below restate the adapter rules of ``balances.sources.tables`` and
the operator semantics in plain SQL; they are independent of the Spark code.
"""
from __future__ import annotations

import math

from balances.config import SETTINGS

S = SETTINGS

_PRODUCT_CASE = "CASE o_orderpriority " + " ".join(
    f"WHEN '{raw}' THEN '{slug}'" for raw, slug in S.products) + " END"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


BAL = f"""bal AS (
  SELECT CAST(o_custkey AS BIGINT) AS customer_id, o_orderstatus AS source,
         {_PRODUCT_CASE} AS product, CAST(o_orderdate AS DATE) AS obs_date,
         o_totalprice - {S.balance_center} AS balance, CAST(o_orderkey AS BIGINT) AS row_key
  FROM orders)"""

CUT = """cut AS (
  SELECT min(mx) AS cut_date FROM (SELECT source, max(obs_date) AS mx FROM bal GROUP BY source) s),
params AS (
  SELECT cut_date,
         CAST(cut_date - INTERVAL 6 MONTH AS DATE) AS win_start,
         CAST(cut_date - INTERVAL 3 MONTH AS DATE) AS mid,
         CAST(date_trunc('month', cut_date) AS DATE) AS cut_month
  FROM cut)"""

SNAP = """snap AS (
  SELECT customer_id, product,
         arg_max(balance, {'d': obs_date, 'k': row_key}) FILTER (WHERE balance IS NOT NULL) AS balance_snapshot,
         max(obs_date) AS snapshot_date,
         avg(balance) FILTER (WHERE obs_date >= win_start) AS balance_mean_6m,
         count(balance) FILTER (WHERE obs_date >= win_start) AS n_obs_window,
         avg(balance) FILTER (WHERE obs_date >= mid)
           - avg(balance) FILTER (WHERE obs_date >= win_start AND obs_date < mid) AS trend_6m,
         1 AS holding
  FROM bal, params WHERE obs_date <= cut_date
  GROUP BY customer_id, product)"""

MONTHLY = """monthly AS (
  SELECT customer_id, product, CAST(date_trunc('month', obs_date) AS DATE) AS month,
         arg_max(balance, {'d': obs_date, 'k': row_key}) FILTER (WHERE balance IS NOT NULL) AS balance_month,
         1 AS observed
  FROM bal, params WHERE obs_date <= cut_date
  GROUP BY customer_id, product, CAST(date_trunc('month', obs_date) AS DATE))"""

PANEL = """grid AS (
  SELECT g.customer_id, g.product, CAST(m.month AS DATE) AS month
  FROM (SELECT customer_id, product, min(month) AS first_m FROM monthly GROUP BY 1, 2) g,
       params,
       LATERAL (SELECT unnest(generate_series(g.first_m, params.cut_month, INTERVAL 1 MONTH)) AS month) m
  WHERE g.first_m <= params.cut_month),
panel AS (
  SELECT grid.customer_id, grid.product, grid.month,
         last_value(monthly.balance_month IGNORE NULLS) OVER (
           PARTITION BY grid.customer_id, grid.product ORDER BY grid.month
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS balance_month,
         CAST(coalesce(monthly.observed, 0) AS INTEGER) AS observed
  FROM grid LEFT JOIN monthly USING (customer_id, product, month))"""

CV = f"""cvm AS (
  SELECT customer_id, month, sum(balance_month) AS liquid_month, max(observed) AS observed
  FROM panel, params
  WHERE product IN {_in(S.liquid_products)}
    AND month >= CAST(cut_month - INTERVAL {S.window_months - 1} MONTH AS DATE) AND month <= cut_date
  GROUP BY customer_id, month),
cv AS (
  SELECT customer_id,
         CASE WHEN sum(observed) >= {S.cv_min_observed_months} AND avg(liquid_month) > 0
              THEN stddev_pop(liquid_month) / avg(liquid_month) END AS liquid_cv,
         CAST(CASE WHEN sum(observed) < {S.cv_min_observed_months} THEN 1 ELSE 0 END AS INTEGER)
           AS liquid_cv_insufficient
  FROM cvm GROUP BY customer_id)"""

FIRST = f"""first_rec AS (
  SELECT customer_id, CAST(date_trunc('month', min(obs_date)) AS DATE) AS first_month
  FROM bal WHERE product NOT IN {_in(S.label_products)} GROUP BY customer_id)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def r(expr: str, alias: str, digits: int = 6) -> str:
    # "+ 0.0" turns a rounded negative zero into 0.0 (Spark's round never yields -0.0)
    return f"round(CAST({expr} AS DOUBLE), {digits}) + 0.0 AS {alias}"


SQL: dict[str, str] = {}

SQL["global_cut"] = with_(BAL, CUT) + "SELECT cut_date FROM cut"

SQL["cut_report"] = with_(BAL, CUT) + """,
g AS (SELECT source, customer_id, product, count(*) AS n,
             count(*) FILTER (WHERE obs_date > (SELECT cut_date FROM cut)) AS n_after,
             min(obs_date) AS min_date, max(obs_date) AS max_date
      FROM bal GROUP BY source, customer_id, product)
SELECT source, CAST(sum(n) AS BIGINT) AS rows_total, CAST(sum(n_after) AS BIGINT) AS rows_after_cut,
       CAST(count(*) AS BIGINT) AS groups_total,
       CAST(count(*) FILTER (WHERE min_date > (SELECT cut_date FROM cut)) AS BIGINT) AS groups_dropped,
       max(max_date) AS max_date,
       CAST(date_diff('day', (SELECT cut_date FROM cut), max(max_date)) AS BIGINT) AS lag_days
FROM g GROUP BY source"""

SQL["balance_snapshot"] = with_(BAL, CUT, SNAP) + f"""
SELECT customer_id, product, {r('balance_snapshot', 'balance_snapshot')}, snapshot_date,
       {r('balance_mean_6m', 'balance_mean_6m')}, CAST(n_obs_window AS BIGINT) AS n_obs_window,
       {r('trend_6m', 'trend_6m')}, holding
FROM snap"""

SQL["relative_trend"] = with_(BAL, CUT, SNAP) + f"""
SELECT customer_id, product,
       {r('CASE WHEN balance_mean_6m > 0 THEN trend_6m / balance_mean_6m END', 'relative_trend_6m')}
FROM snap"""

SQL["month_last"] = with_(BAL, CUT, MONTHLY) + f"""
SELECT customer_id, product, month, {r('balance_month', 'balance_month')}, observed FROM monthly"""

SQL["monthly_panel"] = with_(BAL, CUT, MONTHLY, PANEL) + f"""
SELECT customer_id, product, month, {r('balance_month', 'balance_month')}, observed FROM panel"""

SQL["first_month"] = with_(BAL, FIRST) + "SELECT customer_id, first_month FROM first_rec"

SQL["tenure_months"] = with_(BAL, CUT, FIRST) + """
SELECT customer_id, first_month,
       CAST((year(cut_date) * 12 + month(cut_date)) - (year(first_month) * 12 + month(first_month)) AS INTEGER)
         AS tenure_months
FROM first_rec, params"""

SQL["liquid_cv"] = with_(BAL, CUT, MONTHLY, PANEL, CV) + f"""
SELECT customer_id, {r('liquid_cv', 'liquid_cv')}, liquid_cv_insufficient FROM cv"""


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# --------------------------------------------------------------------------
# customers, estimator and the gold feature mart
# --------------------------------------------------------------------------
CUST = """party AS (
  SELECT CAST(c_custkey AS BIGINT) AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS bal,
         c_mktsegment AS segment FROM customer
  UNION ALL
  SELECT CAST(-s_suppkey AS BIGINT), s_name, s_nationkey,
         CASE WHEN s_acctbal >= 0 THEN floor(s_acctbal / 2500) * CAST(2500 AS DOUBLE) ELSE s_acctbal END, 'PARTNER'
  FROM supplier),
cust_raw AS (
  SELECT c.id AS customer_id, c.name, r.r_name AS age_group,
         CASE WHEN c.bal < -900 THEN NULL WHEN c.nation % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         c.segment,
         CASE WHEN c.bal < 6500 THEN NULL WHEN c.bal < 8200 THEN 'RENTED' ELSE 'OWNED' END AS housing,
         CASE WHEN c.bal >= 0 THEN c.bal END AS income,
         CASE WHEN c.bal >= 0 THEN c.bal * (c.nation + 1) / CAST(20 AS DOUBLE) END AS expenses,
         CASE WHEN c.bal >= 500 THEN c.bal * CAST(10 AS DOUBLE) END AS assets,
         CASE WHEN c.bal >= 500 THEN c.bal * (c.nation % 7) END AS liabilities
  FROM party c
  LEFT JOIN (SELECT n.n_nationkey, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) r
    ON c.nation = r.n_nationkey),
cust AS (
  SELECT customer_id, name, age_group, gender, segment, housing, income, expenses, assets, liabilities,
         assets - liabilities AS equity,
         (income IS NULL OR expenses IS NULL OR assets IS NULL OR liabilities IS NULL
          OR assets - liabilities IS NULL) AS no_financial_any,
         (income IS NULL AND expenses IS NULL AND assets IS NULL AND liabilities IS NULL
          AND assets - liabilities IS NULL) AS no_financial_all,
         income - expenses AS savings_capacity
  FROM cust_raw
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY name) = 1)"""

EST = """est AS (
  SELECT CAST(user_id AS BIGINT) AS customer_id, sum(value) AS income_estimate
  FROM events GROUP BY 1)"""


def _pivot_cte() -> str:
    cols = []
    for p in S.product_slugs:
        for c in ("balance_snapshot", "snapshot_date", "balance_mean_6m", "n_obs_window",
                  "trend_6m", "holding"):
            cols.append(f"max({c}) FILTER (WHERE product = '{p}') AS {p}_{c}")
    return "piv AS (SELECT customer_id,\n  " + ",\n  ".join(cols) + "\n  FROM snap GROUP BY customer_id)"


def _sum0(cols):
    return "(" + " + ".join(f"coalesce({c}, 0.0)" for c in cols) + ")"


def _cnt_pos(cols):
    return "(" + " + ".join(f"CAST(coalesce({c}, 0.0) > 0 AS INTEGER)" for c in cols) + ")"


def _sdiv(n, d, pos=False):
    cond = f"({d}) > 0" if pos else f"({d}) <> 0"
    return f"CASE WHEN {cond} THEN CAST({n} AS DOUBLE) / ({d}) END"


def _feat_cte() -> str:
    P = S.product_slugs
    prod_cols = []
    for p in P:
        prod_cols += [
            f"coalesce(piv.{p}_balance_snapshot, 0.0) AS {p}_balance_snapshot",
            f"piv.{p}_snapshot_date AS {p}_snapshot_date",
            f"CASE WHEN piv.{p}_holding IS NULL THEN 0.0 ELSE piv.{p}_balance_mean_6m END AS {p}_balance_mean_6m",
            f"CASE WHEN piv.{p}_holding IS NULL THEN 0.0 ELSE piv.{p}_trend_6m END AS {p}_trend_6m",
            f"CAST(coalesce(piv.{p}_n_obs_window, 0) AS INTEGER) AS {p}_n_obs_window",
            f"CAST(coalesce(piv.{p}_holding, 0) AS INTEGER) AS {p}_holding",
        ]
    wide = ("wide AS (SELECT cust.*, " + ", ".join(prod_cols) +
            ", est.income_estimate, (est.customer_id IS NOT NULL) AS has_income_estimate,"
            " cv.liquid_cv, cv.liquid_cv_insufficient AS cv_insuff, first_rec.first_month"
            " FROM cust LEFT JOIN piv USING (customer_id) LEFT JOIN est USING (customer_id)"
            " LEFT JOIN cv USING (customer_id) LEFT JOIN first_rec USING (customer_id))")
    label = " OR ".join(f"{p}_balance_snapshot > 0" for p in S.label_products)
    recent = " OR ".join(
        f"coalesce({p}_balance_snapshot > 0 AND date_diff('day', {p}_snapshot_date, cut_date) <= "
        f"{S.recent_label_days}, false)" for p in S.label_products)
    nl_dates = ", ".join(f"{p}_snapshot_date" for p in S.non_label_products)
    snaps = lambda ps: [f"{p}_balance_snapshot" for p in ps]
    liquid = _sum0(snaps(S.liquid_products))
    hist = "(" + " + ".join(f"{p}_holding" for p in P) + ") > 0"
    fin_all_null = " AND ".join(f"{c} IS NULL" for c in S.financial_cols)
    rel = ",\n    ".join(
        f"{_sdiv(f'{p}_trend_6m', f'{p}_balance_mean_6m', True)} AS {p}_relative_trend_6m" for p in P)
    no_signal = f"CAST(NOT ({hist}) AND NOT has_income_estimate AND coalesce(no_financial_all, false) AS INTEGER)"
    feat = f"""feat AS (SELECT customer_id, name, age_group, gender, segment,
    income, expenses, assets, liabilities, equity, savings_capacity,
    CAST(no_financial_any AS INTEGER) AS no_financial_any, CAST(no_financial_all AS INTEGER) AS no_financial_all,
    {", ".join(c for p in P for c in (f"{p}_balance_snapshot", f"{p}_snapshot_date", f"{p}_balance_mean_6m",
                                        f"{p}_trend_6m", f"{p}_n_obs_window", f"{p}_holding"))},
    income_estimate, liquid_cv,
    CAST(has_income_estimate AS INTEGER) AS has_income_estimate,
    CAST({label} AS INTEGER) AS adoption_label,
    CAST(date_diff('day', greatest({nl_dates}), cut_date) AS INTEGER) AS days_since_last_data,
    CAST(greatest({nl_dates}) IS NULL AS INTEGER) AS no_recent_data,
    CAST({recent} AS INTEGER) AS adoption_label_recent,
    {_sum0(snaps(S.invest_non_label_products))} AS invested_non_label_balance,
    {_cnt_pos(snaps(S.invest_non_label_products))} AS n_invest_non_label,
    CAST({hist} AS INTEGER) AS has_product_history,
    {no_signal} AS no_signal,
    1 - {no_signal} AS trainable,
    {_sdiv('expenses', 'income')} AS expense_income_ratio,
    {_sdiv('savings_capacity', 'income')} AS savings_income_pct,
    {_sdiv('liabilities', 'assets')} AS liability_asset_ratio,
    {_sdiv('equity', 'income * 12')} AS equity_per_income,
    income - income_estimate AS income_gap,
    {_sdiv('income - income_estimate', 'income')} AS income_gap_pct,
    {liquid} AS liquid_balance_total,
    {_cnt_pos(snaps(P))} AS n_products_total,
    {_cnt_pos(snaps(S.non_label_products))} AS n_products_non_label,
    {_sdiv(liquid, 'equity')} AS liquidity_equity_ratio,
    {rel},
    CAST(housing IS NOT NULL AS INTEGER) AS has_housing_data,
    coalesce(housing, '{S.missing_label}') AS housing,
    CAST({fin_all_null} AS INTEGER) AS missing_financial,
    CAST(income_estimate IS NULL AS INTEGER) AS missing_estimator,
    CAST(housing IS NULL AS INTEGER) AS missing_housing,
    CAST(coalesce(cv_insuff, 1) AS INTEGER) AS liquid_cv_insufficient,
    CAST((year(cut_date) * 12 + month(cut_date)) - (year(first_month) * 12 + month(first_month)) AS INTEGER)
      AS tenure_months
  FROM wide, params)"""
    return _pivot_cte() + ",\n" + wide + ",\n" + feat


FEAT_CTES = (BAL, CUT, SNAP, MONTHLY, PANEL, CV, FIRST, CUST, EST, _feat_cte())


def feat_with(*extra: str) -> str:
    return with_(*FEAT_CTES, *extra)


def select_rounded(table: str, columns: list[tuple[str, str]]) -> str:
    """SELECT with round() on the double columns: columns = [(name, kind)]."""
    parts = [r(n, n) if k == "d" else n for n, k in columns]
    return f"SELECT {', '.join(parts)} FROM {table}"


FEAT_DOUBLES = (["income", "expenses", "assets", "liabilities", "equity", "savings_capacity",
                 "income_estimate", "liquid_cv", "invested_non_label_balance",
                 "expense_income_ratio", "savings_income_pct", "liability_asset_ratio",
                 "equity_per_income", "income_gap", "income_gap_pct", "liquid_balance_total",
                 "liquidity_equity_ratio"]
                + [f"{p}_{c}" for p in S.product_slugs
                   for c in ("balance_snapshot", "balance_mean_6m", "trend_6m", "relative_trend_6m")])

SQL["customer_features"] = feat_with() + "SELECT * REPLACE (" + ", ".join(
    f"round({c}, 6) AS {c}" for c in FEAT_DOUBLES) + ") FROM feat"


# --------------------------------------------------------------------------
# gold-layer profiles, levels, star schema, data quality
# --------------------------------------------------------------------------
POP = "CASE WHEN has_product_history = 1 THEN 'with_history' ELSE 'without_history' END"

SQL["missing_flags"] = feat_with() + """
SELECT customer_id, housing, has_housing_data, missing_financial, missing_estimator, missing_housing
FROM feat"""

SQL["segment_rates"] = feat_with() + """,
long AS (
  SELECT 'age_group' AS variable, CAST(age_group AS VARCHAR) AS category, adoption_label FROM feat
  UNION ALL SELECT 'gender', CAST(gender AS VARCHAR), adoption_label FROM feat
  UNION ALL SELECT 'segment', CAST(segment AS VARCHAR), adoption_label FROM feat
  UNION ALL SELECT 'housing', CAST(housing AS VARCHAR), adoption_label FROM feat)
SELECT variable, category, CAST(count(*) AS BIGINT) AS n, round(avg(adoption_label), 6) AS rate
FROM long GROUP BY variable, category"""

SQL["label_means"] = feat_with() + "SELECT adoption_label, " + ", ".join(
    f"round(avg({c}), 6) AS mean_{c}" for c in
    [f"{p}_balance_snapshot" for p in S.product_slugs] + ["savings_capacity"]) + \
    " FROM feat GROUP BY adoption_label"

_RAW_CUST_COLS = ["customer_id", "name", "age_group", "gender", "segment", "housing",
                  "income", "expenses", "assets", "liabilities", "equity"]
SQL["null_profile"] = with_(CUST) + ",\nc AS (SELECT *, assets - liabilities AS equity FROM cust_raw)\n" + \
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null, "
        f"CAST(count(*) AS BIGINT) AS n_rows FROM c" for c in _RAW_CUST_COLS)



LEVELS = f"""lv AS (
  SELECT customer_id, {POP} AS population, liquid_balance_total AS value FROM feat),
lvr AS (
  SELECT customer_id, population, value,
         CAST(row_number() OVER (PARTITION BY population ORDER BY value, customer_id) AS BIGINT) AS rn,
         CAST(count(*) OVER (PARTITION BY population) AS BIGINT) AS n
  FROM lv WHERE value IS NOT NULL),
levels AS (
  SELECT *, CASE WHEN rn * 4 <= n THEN 'D' WHEN rn * 4 <= n * 2 THEN 'C'
                 WHEN rn * 4 <= n * 3 THEN 'B' ELSE 'A' END AS level,
         CAST(rn AS DOUBLE) / n AS pct_rank
  FROM lvr)"""

SQL["priority_levels"] = feat_with(LEVELS) + """
SELECT customer_id, population, round(value, 6) AS value, level, rn, n FROM levels"""

SQL["percentile_in_group"] = feat_with(LEVELS) + """
SELECT customer_id, population, round(pct_rank, 6) AS pct_rank FROM levels"""

_LI_COLS = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_LI_ORDER = ["l_shipdate"] + [c for c in _LI_COLS if c != "l_shipdate"]
SQL["dedupe_first"] = "SELECT l_orderkey, l_linenumber, " + ", ".join(_LI_COLS) + \
    " FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY " + \
    ", ".join(f"{c} NULLS FIRST" for c in _LI_ORDER) + ") = 1"

SQL["duplicates"] = with_(CUST) + """
SELECT 'lineitem' AS table_name, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS n_keys,
       CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS n_duplicates,
       CASE WHEN count(*) = count(DISTINCT (l_orderkey, l_linenumber)) THEN 'OK' ELSE 'FAIL' END AS status
FROM lineitem
UNION ALL
SELECT 'customers', CAST(count(*) AS BIGINT), CAST(count(DISTINCT customer_id) AS BIGINT),
       CAST(count(*) - count(DISTINCT customer_id) AS BIGINT),
       CASE WHEN count(*) = count(DISTINCT customer_id) THEN 'OK' ELSE 'FAIL' END
FROM cust_raw"""

SQL["grain_check"] = with_(BAL) + """
SELECT 'balances' AS table_name, 'customer_id,product,obs_date' AS grain,
       CAST(count(*) - count(DISTINCT (customer_id, product, obs_date)) AS BIGINT) AS n_duplicates,
       CASE WHEN count(*) = count(DISTINCT (customer_id, product, obs_date)) THEN 'OK' ELSE 'FAIL' END AS status
FROM bal
UNION ALL
SELECT 'balances', 'customer_id,product,row_key',
       CAST(count(*) - count(DISTINCT (customer_id, product, row_key)) AS BIGINT),
       CASE WHEN count(*) = count(DISTINCT (customer_id, product, row_key)) THEN 'OK' ELSE 'FAIL' END
FROM bal
UNION ALL
SELECT 'balances', 'customer_id,product,valuation_date', CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR)"""

SQL["orphans"] = with_(BAL, CUST) + """
SELECT CAST(count(*) AS BIGINT) AS n_orphans FROM (
  SELECT DISTINCT customer_id FROM bal
  EXCEPT SELECT DISTINCT customer_id FROM cust_raw) t"""

SQL["non_ascii"] = " UNION ALL ".join(
    f"SELECT 'documents' AS table_name, '{c}' AS \"column\", CAST(count(*) AS BIGINT) AS n_rows, "
    f"CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct FROM documents "
    f"WHERE regexp_matches({c}, '[^\\x00-\\x7F]')" for c in ("text", "lang", "source"))

STAR = """dim_product AS (
  SELECT product, CAST(row_number() OVER (ORDER BY product) AS INTEGER) AS product_id
  FROM (SELECT DISTINCT product FROM panel WHERE product IS NOT NULL) t),
dim_time AS (
  SELECT date, CAST(row_number() OVER (ORDER BY date) AS INTEGER) AS date_id,
         year(date) AS year, month(date) AS month, quarter(date) AS quarter
  FROM (SELECT DISTINCT month AS date FROM panel WHERE month IS NOT NULL) t),
fact AS (
  SELECT p.customer_id, dp.product_id, dt.date_id, p.month, p.balance_month
  FROM panel p LEFT JOIN dim_product dp USING (product) LEFT JOIN dim_time dt ON p.month = dt.date)"""

PANEL_CTES = (BAL, CUT, MONTHLY, PANEL)
SQL["dim_product"] = with_(*PANEL_CTES, STAR) + "SELECT product, product_id FROM dim_product"
SQL["dim_time"] = with_(*PANEL_CTES, STAR) + \
    "SELECT date, date_id, CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month, " \
    "CAST(quarter AS INTEGER) AS quarter FROM dim_time"
SQL["star_fact"] = with_(*PANEL_CTES, STAR) + """
SELECT customer_id, product_id, date_id, month, round(balance_month, 6) AS balance_month FROM fact"""

SQL["constraint_report"] = feat_with(STAR) + """
SELECT 'dim_customer' AS table_name, 'primary_key' AS "constraint", 'customer_id' AS columns,
       CAST(count(*) - count(DISTINCT customer_id) AS BIGINT) AS violations FROM feat
UNION ALL SELECT 'dim_customer', 'pk_not_null', 'customer_id', CAST(count(*) FILTER (WHERE customer_id IS NULL) AS BIGINT) FROM feat
UNION ALL SELECT 'dim_product', 'primary_key', 'product_id', CAST(count(*) - count(DISTINCT product_id) AS BIGINT) FROM dim_product
UNION ALL SELECT 'dim_product', 'pk_not_null', 'product_id', CAST(count(*) FILTER (WHERE product_id IS NULL) AS BIGINT) FROM dim_product
UNION ALL SELECT 'dim_time', 'primary_key', 'date_id', CAST(count(*) - count(DISTINCT date_id) AS BIGINT) FROM dim_time
UNION ALL SELECT 'dim_time', 'pk_not_null', 'date_id', CAST(count(*) FILTER (WHERE date_id IS NULL) AS BIGINT) FROM dim_time
UNION ALL SELECT 'fact_monthly', 'primary_key', 'customer_id,product_id,date_id',
       CAST(count(*) - count(DISTINCT (customer_id, product_id, date_id)) AS BIGINT) FROM fact
UNION ALL SELECT 'fact_monthly', 'pk_not_null', 'customer_id,product_id,date_id',
       CAST(count(*) FILTER (WHERE customer_id IS NULL OR product_id IS NULL OR date_id IS NULL) AS BIGINT) FROM fact
UNION ALL SELECT 'fact_monthly', 'not_null', 'month', CAST(count(*) FILTER (WHERE month IS NULL) AS BIGINT) FROM fact
UNION ALL SELECT 'fact_monthly', 'foreign_key:dim_customer', 'customer_id', CAST(count(*) AS BIGINT) FROM (
  SELECT DISTINCT customer_id FROM fact WHERE customer_id IS NOT NULL EXCEPT SELECT customer_id FROM feat) a
UNION ALL SELECT 'fact_monthly', 'foreign_key:dim_product', 'product_id', CAST(count(*) AS BIGINT) FROM (
  SELECT DISTINCT product_id FROM fact WHERE product_id IS NOT NULL EXCEPT SELECT product_id FROM dim_product) b
UNION ALL SELECT 'fact_monthly', 'foreign_key:dim_time', 'date_id', CAST(count(*) AS BIGINT) FROM (
  SELECT DISTINCT date_id FROM fact WHERE date_id IS NOT NULL EXCEPT SELECT date_id FROM dim_time) c"""


# --------------------------------------------------------------------------
# statistics battery
# --------------------------------------------------------------------------
FEATURE_COLUMNS = (
    ["customer_id", "name", "age_group", "gender", "segment", "income", "expenses", "assets",
     "liabilities", "equity", "savings_capacity"]
    + [f"{p}_{c}" for p in S.product_slugs for c in ("balance_snapshot", "snapshot_date", "balance_mean_6m",
                                                      "trend_6m", "n_obs_window", "holding")]
    + ["income_estimate", "liquid_cv", "no_financial_any", "no_financial_all", "has_income_estimate",
       "adoption_label", "days_since_last_data", "no_recent_data", "adoption_label_recent",
       "invested_non_label_balance", "n_invest_non_label", "has_product_history", "no_signal", "trainable",
       "expense_income_ratio", "savings_income_pct", "liability_asset_ratio", "equity_per_income",
       "income_gap", "income_gap_pct", "liquid_balance_total", "n_products_total", "n_products_non_label",
       "liquidity_equity_ratio"]
    + [f"{p}_relative_trend_6m" for p in S.product_slugs]
    + ["has_housing_data", "housing", "missing_financial", "missing_estimator", "missing_housing",
       "liquid_cv_insufficient", "tenure_months"])


#: Roles restated here, apart from the library: what each column may be used for.
_ROLE_OF = {"customer_id": "id", "name": "id", "adoption_label": "leak", "adoption_label_recent": "leak",
            "n_products_total": "leak", "gender": "excluded", "has_product_history": "flag", "no_signal": "flag",
            "trainable": "flag", "no_recent_data": "flag"}
_CAPACITY = {"income", "expenses", "assets", "liabilities", "equity", "savings_capacity", "income_estimate",
             "has_income_estimate", "missing_estimator", "expense_income_ratio", "savings_income_pct",
             "liability_asset_ratio", "equity_per_income", "income_gap", "income_gap_pct", "no_financial_any",
             "age_group", "housing", "has_housing_data", "segment"}


def _role(c):
    if c in _ROLE_OF:
        return _ROLE_OF[c]
    if c.startswith("robo_advisor_"):
        return "leak"
    if c.endswith("_snapshot_date"):
        return "intermediate"
    return "A+B" if c in _CAPACITY else "A"


def _roles_values():
    return ", ".join(f"('{c}', '{_role(c)}')" for c in FEATURE_COLUMNS)


#: Every numeric predictor of model A.
NUM_VARS = [c for c in FEATURE_COLUMNS
            if _role(c) in ("A", "A+B") and c not in ("age_group", "housing", "segment")]
CAT_VARS = ["age_group", "gender", "segment", "housing"]

_MEDIAN_COLS = NUM_VARS
SQL["label_medians"] = feat_with() + ",\nlong AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, adoption_label, CAST({c} AS DOUBLE) AS value FROM feat"
    for c in _MEDIAN_COLS) + """)
SELECT variable, adoption_label, round(quantile_cont(value, 0.5), 6) AS median
FROM long WHERE value IS NOT NULL GROUP BY variable, adoption_label"""

_DESCRIBE_COLS = NUM_VARS
SQL["describe_profile"] = feat_with() + ",\nlong AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, CAST({c} AS DOUBLE) AS value FROM feat" for c in _DESCRIBE_COLS) + """)
SELECT variable, CAST(count(value) AS BIGINT) AS count, round(avg(value), 6) AS mean,
       round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min, round(max(value), 6) AS max,
       round(quantile_cont(value, 0.01), 6) AS q01, round(quantile_cont(value, 0.25), 6) AS q25,
       round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75,
       round(quantile_cont(value, 0.99), 6) AS q99
FROM long GROUP BY variable"""

DEC = "[" + ", ".join(repr(i / S.n_bins) for i in range(S.n_bins + 1)) + "]"

NUM_LONG = "nl AS (" + " UNION ALL ".join(
    f"SELECT customer_id, adoption_label AS y, '{c}' AS variable, CAST({c} AS DOUBLE) AS value FROM feat"
    for c in NUM_VARS) + ")"

NUM_BINS = f"""pv AS (SELECT variable, value, count(*) AS c FROM nl WHERE value IS NOT NULL GROUP BY 1, 2),
vstats AS (SELECT variable, count(*) AS nunique, arg_max(value, {{'c': c, 'v': -value}}) AS mode
           FROM pv GROUP BY variable),
vedges AS (SELECT variable, list_sort(list_distinct(quantile_cont(value, {DEC}))) AS edges
           FROM nl WHERE value IS NOT NULL GROUP BY variable),
vinfo0 AS (SELECT s.variable, s.nunique, s.mode, e.edges FROM vstats s LEFT JOIN vedges e USING (variable)),
vrest AS (SELECT nl.variable, list_sort(list_distinct(quantile_cont(nl.value, {DEC}))) AS edges_rest
          FROM nl JOIN vinfo0 i USING (variable)
          WHERE nl.value IS NOT NULL AND i.nunique > {S.n_bins} AND len(i.edges) < 3 AND nl.value <> i.mode
          GROUP BY nl.variable),
vinfo AS (SELECT i.variable, i.mode,
                 CASE WHEN i.nunique <= {S.n_bins} THEN 'value' WHEN len(i.edges) >= 3 THEN 'quantile'
                      ELSE 'mode' END AS kind,
                 CASE WHEN i.nunique <= {S.n_bins} THEN NULL WHEN len(i.edges) >= 3 THEN i.edges
                      ELSE r.edges_rest END AS e
          FROM vinfo0 i LEFT JOIN vrest r USING (variable)),
nb0 AS (SELECT nl.*, vinfo.kind, vinfo.mode, vinfo.e,
               len(list_filter(vinfo.e[2:len(vinfo.e) - 1], lambda x: x < nl.value)) AS idx
        FROM nl LEFT JOIN vinfo USING (variable)),
nbin AS (SELECT customer_id, y, variable, value,
           CASE WHEN value IS NULL THEN 'missing'
                WHEN kind = 'mode' AND value = mode THEN 'mode'
                WHEN kind = 'value' OR (kind = 'mode' AND len(e) < 2) THEN 'value'
                ELSE 'quantile' END AS bin_kind,
           CASE WHEN value IS NULL THEN NULL
                WHEN (kind = 'mode' AND value = mode) OR kind = 'value' OR (kind = 'mode' AND len(e) < 2) THEN value
                ELSE e[idx + 1] END AS bin_lo,
           CASE WHEN value IS NULL THEN NULL
                WHEN (kind = 'mode' AND value = mode) OR kind = 'value' OR (kind = 'mode' AND len(e) < 2) THEN value
                ELSE e[idx + 2] END AS bin_hi
         FROM nb0)"""


def _woe_sql(src: str, bin_cols: str, name: str) -> str:
    return f"""{name}_g AS (SELECT variable, {bin_cols}, count(*) AS n, CAST(sum(y) AS BIGINT) AS events
              FROM {src} GROUP BY variable, {bin_cols}),
{name}_t AS (SELECT *, n - events AS non_events,
                sum(events) OVER (PARTITION BY variable) AS te,
                sum(n - events) OVER (PARTITION BY variable) AS tne,
                count(*) OVER (PARTITION BY variable) AS k FROM {name}_g),
{name} AS (SELECT variable, {bin_cols}, CAST(n AS BIGINT) AS n, events,
              ln(((non_events + {S.woe_eps}) / (tne + {S.woe_eps} * k)) / ((events + {S.woe_eps}) / (te + {S.woe_eps} * k))) AS woe,
              ((non_events + {S.woe_eps}) / (tne + {S.woe_eps} * k) - (events + {S.woe_eps}) / (te + {S.woe_eps} * k))
                * ln(((non_events + {S.woe_eps}) / (tne + {S.woe_eps} * k)) / ((events + {S.woe_eps}) / (te + {S.woe_eps} * k))) AS iv_bin
           FROM {name}_t)"""


CAT_LONG = "cl AS (" + " UNION ALL ".join(
    f"SELECT customer_id, adoption_label AS y, '{c}' AS variable, coalesce(CAST({c} AS VARCHAR), '{S.missing_label}') AS bin FROM feat"
    for c in CAT_VARS) + ")"

WOE_NUM = _woe_sql("nbin", "bin_kind, bin_lo, bin_hi", "woe_num")
WOE_CAT = _woe_sql("cl", "bin", "woe_cat")

SQL["woe_iv_numeric"] = feat_with(NUM_LONG, NUM_BINS, WOE_NUM) + """
SELECT variable, bin_kind, round(bin_lo, 6) AS bin_lo, round(bin_hi, 6) AS bin_hi, n, events,
       round(woe, 6) AS woe, round(iv_bin, 6) AS iv_bin FROM woe_num"""

SQL["woe_iv_categorical"] = feat_with(CAT_LONG, WOE_CAT) + """
SELECT variable, bin, n, events, round(woe, 6) AS woe, round(iv_bin, 6) AS iv_bin FROM woe_cat"""

_IVC = "CASE " + " ".join(f"WHEN iv < {c} THEN '{lab}'" for c, lab in S.iv_cuts) + " ELSE 'strong' END"
SQL["iv_class"] = feat_with(NUM_LONG, NUM_BINS, WOE_NUM, CAT_LONG, WOE_CAT) + f""",
ivs AS (SELECT variable, sum(iv_bin) AS iv FROM (
          SELECT variable, iv_bin FROM woe_num UNION ALL SELECT variable, iv_bin FROM woe_cat) u
        GROUP BY variable)
SELECT variable, round(iv, 6) AS iv, {_IVC} AS iv_class FROM ivs"""

MW = """mwr AS (SELECT variable, value, y,
              (rank() OVER w + (count(*) OVER (PARTITION BY variable, value)) - 1 + rank() OVER w) / 2.0 AS mid_rank
            FROM nl WHERE value IS NOT NULL WINDOW w AS (PARTITION BY variable ORDER BY value)),
ties AS (SELECT variable, sum(power(t, 3) - t) AS tie_term FROM (
           SELECT variable, value, count(*) AS t FROM nl WHERE value IS NOT NULL GROUP BY 1, 2) x GROUP BY 1),
mwg AS (SELECT variable, sum(mid_rank * y) AS r1, CAST(sum(y) AS BIGINT) AS n1, count(*) AS n
        FROM mwr GROUP BY variable),
mw AS (SELECT g.variable, g.n1 AS n_event, CAST(g.n - g.n1 AS BIGINT) AS n_non_event,
              CASE WHEN g.n1 > 0 AND g.n - g.n1 > 0 THEN g.r1 - g.n1 * (g.n1 + 1) / 2.0 END AS u,
              CASE WHEN g.n1 > 0 AND g.n - g.n1 > 0 AND (g.n + 1) - t.tie_term / (g.n * (g.n - 1)) > 0 THEN
                (greatest(g.r1 - g.n1 * (g.n1 + 1) / 2.0, g.n1 * (g.n - g.n1) - (g.r1 - g.n1 * (g.n1 + 1) / 2.0))
                 - g.n1 * (g.n - g.n1) / 2.0 - 0.5)
                / sqrt(g.n1 * (g.n - g.n1) / 12.0 * ((g.n + 1) - t.tie_term / (g.n * (g.n - 1)))) END AS z
       FROM mwg g JOIN ties t USING (variable)),
med AS (SELECT variable,
               quantile_cont(value, 0.5) FILTER (WHERE y = 1) AS median_event,
               quantile_cont(value, 0.5) FILTER (WHERE y = 0) AS median_non_event
        FROM nl WHERE value IS NOT NULL GROUP BY variable)"""

SQL["mann_whitney_u"] = feat_with(NUM_LONG, MW) + """
SELECT variable, n_event, n_non_event, round(u, 6) AS u, round(z, 6) AS z,
       round(median_event, 6) AS median_event, round(median_non_event, 6) AS median_non_event
FROM mw LEFT JOIN med USING (variable)"""

#: Two-sided p of a z, by the closed form of the Spark side.
def _erfc(x):
    h, n = 0.5, 13
    terms = " + ".join([f"1.0 / (2.0 * ({x}) * ({x}))"] + [
        f"{math.exp(-k * k * h * h)!r} / ({k * k * h * h!r} + ({x}) * ({x}))" for k in range(1, n + 1)])
    return (f"(CASE WHEN ({x}) < 1e-5 THEN 1.0 - 2.0 * ({x}) / {math.sqrt(math.pi)!r} ELSE greatest(2.0 * {h} * ({x}) * exp(-({x}) * ({x})) / {math.pi!r} * ({terms})"
            f" - CASE WHEN ({x}) < 6.0 THEN 2.0 / (exp(2.0 * {math.pi!r} * ({x}) / {h}) - 1.0) ELSE 0.0 END, 0.0) END)")


def _p_z(z):
    return f"CASE WHEN {z} IS NOT NULL THEN {_erfc(f'abs({z}) / {math.sqrt(2.0)!r}')} END"


_AUD = ["age_group", "gender", "housing", "segment"]


def _ovr(src, score, name):
    """One group against the rest, for every audited attribute."""
    return f"""{name}_s AS (SELECT *, (2 * rank() OVER (ORDER BY {score}) + count(*) OVER (PARTITION BY {score}) - 1) / 2.0 AS mid_rank
             FROM {src} WHERE {score} IS NOT NULL),
{name}_t AS (SELECT sum(power(t, 3) - t) AS tie_term, sum(t) AS n_all FROM (SELECT count(*) AS t FROM {name}_s GROUP BY {score}) x),
{name}_l AS (""" + " UNION ALL ".join(
        f"SELECT '{a}' AS attribute, coalesce(CAST({a} AS VARCHAR), '{S.missing_label}') AS grp, {score} AS value, mid_rank FROM {name}_s" for a in _AUD) + f"""),
{name}_g AS (SELECT attribute, grp, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(24, 6))) AS DOUBLE) / count(*) AS mean, quantile_cont(value, 0.5) AS median, sum(mid_rank) AS r_g
             FROM {name}_l GROUP BY attribute, grp),
{name}_z AS (SELECT attribute, grp, n, mean, median,
       CASE WHEN n_all - n > 0 THEN r_g - n * (n + 1) / 2.0 END AS u,
       CASE WHEN n_all - n > 0 AND (n_all + 1) - tie_term / (n_all * (n_all - 1)) > 0 THEN
         (greatest(r_g - n * (n + 1) / 2.0, n * (n_all - n) - (r_g - n * (n + 1) / 2.0)) - n * (n_all - n) / 2.0 - 0.5)
         / sqrt(n * (n_all - n) / 12.0 * ((n_all + 1) - tie_term / (n_all * (n_all - 1)))) END AS z
FROM {name}_g, {name}_t)"""


SQL["one_vs_rest_rank"] = feat_with(_ovr("feat", "CAST(liquid_balance_total AS DOUBLE)", "ovr")) + f"""
SELECT attribute, grp AS "group", CAST(n AS BIGINT) AS n, round(mean, 6) AS mean, round(median, 6) AS median, round(u, 6) AS u,
       round(z, 6) AS z, round({_p_z("z")}, 6) AS p_value FROM ovr_z"""

def _chi(variables, src, label, name):
    """Chi-square of independence per variable, with its p-value."""
    return f"{name}_c AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, coalesce(CAST({c} AS VARCHAR), '{S.missing_label}') AS category, {label} AS y FROM {src}"
        for c in variables) + f"""),
{name}_1 AS (SELECT variable, category, count(*) AS n_i, sum(y) AS e_i FROM {name}_c GROUP BY 1, 2),
{name}_2 AS (SELECT *, sum(n_i) OVER (PARTITION BY variable) AS nn, sum(e_i) OVER (PARTITION BY variable) AS ee,
                count(*) OVER (PARTITION BY variable) AS r FROM {name}_1),
{name}_3 AS (SELECT *, (CASE WHEN ee > 0 THEN 1 ELSE 0 END) + (CASE WHEN nn - ee > 0 THEN 1 ELSE 0 END) AS c,
                n_i * ee / nn AS x1, n_i * (nn - ee) / nn AS x0 FROM {name}_2),
{name}_4 AS (SELECT *, (r - 1) * (c - 1) AS dof,
                CASE WHEN (r - 1) * (c - 1) = 1 THEN 0.5 ELSE 0.0 END AS yt FROM {name}_3),
{name}_5 AS (SELECT variable, nn, r, c, dof,
                 (CASE WHEN x1 > 0 THEN power(greatest(abs(e_i - x1) - yt, 0.0), 2) / x1 ELSE 0.0 END)
               + (CASE WHEN x0 > 0 THEN power(greatest(abs((n_i - e_i) - x0) - yt, 0.0), 2) / x0 ELSE 0.0 END) AS cell
          FROM {name}_4),
{name}_6 AS (SELECT variable, sum(cell) AS chi2, first(dof) AS dof, first(nn) AS n, first(r) AS r, first(c) AS c
      FROM {name}_5 GROUP BY variable),
{name} AS (SELECT variable, CASE WHEN r >= 2 AND c >= 2 THEN chi2 END AS chi2,
       CAST(CASE WHEN r >= 2 AND c >= 2 THEN dof ELSE 0 END AS INTEGER) AS dof,
       CASE WHEN r >= 2 AND c >= 2 AND least(r, c) - 1 > 0 THEN sqrt(chi2 / (n * (least(r, c) - 1))) END AS cramers_v,
       CAST(n AS BIGINT) AS n FROM {name}_6)"""


def _p_chi2(x, k):
    h = f"({x} / 2.0)"
    odd = (f"{_erfc(f'sqrt({h})')} + coalesce(list_sum(list_transform(range(1, ({k} - 1) // 2 + 1), "
           f"lambda j: exp(-{h} + (j - 0.5) * ln({h}) - lgamma(j + 0.5)))), 0.0)")
    even = f"coalesce(list_sum(list_transform(range(0, {k} // 2), lambda j: exp(-{h} + j * ln({h}) - lgamma(j + 1.0)))), 0.0)"
    return f"CASE WHEN {x} IS NOT NULL AND {k} > 0 THEN CASE WHEN {x} <= 0 THEN 1.0 WHEN {k} % 2 = 1 THEN {odd} ELSE {even} END END"


_CHI_VARS = CAT_VARS + ["has_housing_data", "missing_estimator"]
SQL["chi2_cramer"] = feat_with(_chi(_CHI_VARS, "feat", "adoption_label", "chi")) + """
SELECT variable, round(chi2, 6) AS chi2, dof, round(cramers_v, 6) AS cramers_v, n FROM chi"""

SQL["bh_fdr"] = """WITH x AS (SELECT l_orderkey, l_linenumber, l_discount * 10 AS p FROM lineitem),
rk AS (SELECT *, row_number() OVER (ORDER BY p, l_orderkey) AS rn, count(*) OVER () AS n FROM x),
q AS (SELECT *, min(p * n / rn) OVER (ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS qq FROM rk)
SELECT l_orderkey, l_linenumber, round(p, 6) AS p, round(least(qq, 1.0), 6) AS q_value,
       CAST(least(qq, 1.0) <= 0.05 AS INTEGER) AS reject FROM q"""

_VA, _VB, _VC = "income", "expense_income_ratio", "liquid_balance_total"


def _vif(r1, r2, r3):
    r2j = f"((power({r1}, 2) + power({r2}, 2) - 2 * {r1} * {r2} * {r3}) / (1 - power({r3}, 2)))"
    return f"round(CASE WHEN {r2j} >= 1 - 1e-12 THEN CAST('inf' AS DOUBLE) ELSE 1 / (1 - {r2j}) END, 6)"


SQL["vif"] = feat_with() + f""",
rr AS (SELECT corr({_VA}, {_VB}) AS rab, corr({_VA}, {_VC}) AS rac, corr({_VB}, {_VC}) AS rbc FROM feat
       WHERE {_VA} IS NOT NULL AND {_VB} IS NOT NULL AND {_VC} IS NOT NULL)
SELECT '{_VA}' AS variable, {_vif('rab', 'rac', 'rbc')} AS vif FROM rr
UNION ALL SELECT '{_VB}', {_vif('rab', 'rbc', 'rac')} FROM rr
UNION ALL SELECT '{_VC}', {_vif('rac', 'rbc', 'rab')} FROM rr"""

SQL["conditional_lift"] = feat_with() + """,
g AS (SELECT count(*) FILTER (WHERE missing_estimator = 1) AS n_a,
             count(*) FILTER (WHERE missing_estimator = 1 AND missing_housing = 1) AS n_ab,
             count(*) FILTER (WHERE missing_estimator <> 1) AS n_not_a,
             count(*) FILTER (WHERE missing_estimator <> 1 AND missing_housing = 1) AS n_not_a_b FROM feat)
SELECT CAST(n_a AS BIGINT) AS n_a, CAST(n_ab AS BIGINT) AS n_ab, CAST(n_not_a AS BIGINT) AS n_not_a,
       CAST(n_not_a_b AS BIGINT) AS n_not_a_b,
       round(CASE WHEN n_a = 0 OR n_not_a = 0 THEN NULL
                  WHEN n_not_a_b = 0 THEN CASE WHEN n_ab = 0 THEN 0.0 ELSE CAST('inf' AS DOUBLE) END
                  ELSE (CAST(n_ab AS DOUBLE) / n_a) / (CAST(n_not_a_b AS DOUBLE) / n_not_a) END, 6) AS lift
FROM g"""

SQL["auc_exact"] = feat_with() + """,
a AS (SELECT segment, adoption_label AS y, CAST(liquid_balance_total AS DOUBLE) AS value FROM feat
      WHERE liquid_balance_total IS NOT NULL),
ar AS (SELECT segment, y, (2 * rank() OVER (PARTITION BY segment ORDER BY value)
                           + count(*) OVER (PARTITION BY segment, value) - 1) / 2.0 AS mid_rank FROM a),
g AS (SELECT segment, sum(mid_rank * y) AS r1, sum(y) AS n1, count(*) AS n FROM ar GROUP BY segment)
SELECT segment, CAST(n1 AS BIGINT) AS n_pos, CAST(n - n1 AS BIGINT) AS n_neg,
       round(CASE WHEN n1 > 0 AND n - n1 > 0 THEN (r1 - n1 * (n1 + 1) / 2.0) / (n1 * (n - n1)) END, 6) AS auc
FROM g"""

SQL["spearman"] = feat_with() + """,
b AS (SELECT customer_id, liquid_balance_total AS a1, invested_non_label_balance AS b1 FROM feat
      WHERE liquid_balance_total IS NOT NULL AND invested_non_label_balance IS NOT NULL),
rr AS (SELECT (2 * rank() OVER (ORDER BY a1) + count(*) OVER (PARTITION BY a1) - 1) / 2.0 AS ra,
              (2 * rank() OVER (ORDER BY b1) + count(*) OVER (PARTITION BY b1) - 1) / 2.0 AS rb FROM b)
SELECT round(corr(ra, rb), 6) AS spearman, CAST(count(*) AS BIGINT) AS n FROM rr"""


# --------------------------------------------------------------------------
# amounts, score fact, sizing, audit
# --------------------------------------------------------------------------
_APP, _CONS = list(S.label_products), list(S.invest_non_label_products)
_COMPS = {"app": _APP, "conservative": _CONS}
_SCEN = ("conservative", "base", "optimistic")
_MI = lambda c: f"(year({c}) * 12 + month({c}))"


def _growth(start, end, months):
    return f"CASE WHEN ({months}) > 0 THEN (({end}) - ({start})) * CAST(12 AS DOUBLE) / CAST({months} AS DOUBLE) END"


COMP = f"""comp0 AS (
  SELECT customer_id, month,
         coalesce(sum(balance_month) FILTER (WHERE product IN {_in(_APP)}), 0.0) AS app,
         coalesce(sum(balance_month) FILTER (WHERE product IN {_in(_CONS)}), 0.0) AS conservative
  FROM panel WHERE product IN {_in(_APP + _CONS)} GROUP BY customer_id, month),
comp AS (SELECT *, app + conservative AS invested FROM comp0),
hist AS (SELECT customer_id FROM comp GROUP BY customer_id HAVING max(invested) > 0),
comp_h AS (SELECT * FROM comp WHERE customer_id IN (SELECT customer_id FROM hist)),
split AS (SELECT CAST(count(*) AS BIGINT) AS n_months,
                 max(month) FILTER (WHERE r = {S.backtest_months}) AS valid_start
          FROM (SELECT month, row_number() OVER (ORDER BY month DESC) AS r
                FROM (SELECT DISTINCT month FROM comp_h) m) x)"""


def _window_cte(name, where):
    cols = ", ".join(f"arg_min({c}, month) AS {c}_start0, arg_max({c}, month) AS {c}_end0" for c in _COMPS)
    growth = ", ".join(
        f"coalesce({c}_start0, 0.0) AS {c}_start, coalesce({c}_end0, 0.0) AS {c}_end, "
        f"{_growth(f'coalesce({c}_start0, 0.0)', f'coalesce({c}_end0, 0.0)', 'months')} AS {c}_growth"
        for c in _COMPS)
    return f"""{name}0 AS (SELECT customer_id, min(month) AS month_first, max(month) AS month_last, {cols}
           FROM comp_h, split WHERE {where} GROUP BY customer_id),
{name} AS (SELECT customer_id, month_first, month_last, months, {growth}
          FROM (SELECT *, CAST({_MI('month_last')} - {_MI('month_first')} AS INTEGER) AS months FROM {name}0) z)"""


BT = _window_cte("tw", "month < valid_start") + ",\n" + _window_cte("fw", "true") + f""",
vw AS (SELECT customer_id, {", ".join(f"arg_min({c}, month) AS {c}_first, arg_max({c}, month) AS {c}_last" for c in _COMPS)}
       FROM comp_h, split WHERE month >= valid_start GROUP BY customer_id),
nv AS (SELECT greatest(count(DISTINCT month) - 1, 1) AS denom FROM comp_h, split WHERE month >= valid_start),
bt0 AS ({" UNION ALL ".join(
    f"SELECT customer_id, '{c}' AS component, {_growth(f'{c}_first', f'{c}_last', 'denom')} AS real, "
    f"tw.{c}_growth AS pred, ({_growth(f'{c}_first', f'{c}_last', 'denom')}) - tw.{c}_growth AS error "
    f"FROM tw JOIN vw USING (customer_id), nv WHERE tw.{c}_growth IS NOT NULL" for c in _COMPS)}),
bt AS (SELECT * FROM bt0 UNION ALL
       SELECT customer_id, 'total', sum(real), sum(pred), sum(real) - sum(pred) FROM bt0
       GROUP BY customer_id HAVING count(CASE WHEN real IS NOT NULL AND pred IS NOT NULL THEN 1 END) = {len(_COMPS)}),
scen AS (SELECT c.component, coalesce(quantile_cont(b.error, 0.1), 0.0) AS err_lo,
                coalesce(quantile_cont(b.error, 0.5), 0.0) AS err_median,
                coalesce(quantile_cont(b.error, 0.9), 0.0) AS err_hi
         FROM (VALUES {", ".join(f"('{c}')" for c in (*_COMPS, "total"))}) c(component)
         LEFT JOIN (SELECT * FROM bt WHERE error IS NOT NULL AND NOT isnan(error)) b ON b.component = c.component
         GROUP BY c.component),
amounts0 AS (SELECT fw.customer_id, {", ".join(
    f"fw.{c}_growth + s_{c}.err_lo AS amount_{c}_12m_conservative, "
    f"fw.{c}_growth + s_{c}.err_median AS amount_{c}_12m_base, "
    f"fw.{c}_growth + s_{c}.err_hi AS amount_{c}_12m_optimistic" for c in _COMPS)}
    FROM fw {" ".join(f"LEFT JOIN (SELECT * FROM scen WHERE component = '{c}') s_{c} ON true" for c in _COMPS)}),
amounts AS (SELECT *, {", ".join(
    f"{' + '.join(f'amount_{c}_12m_{s}' for c in _COMPS)} AS amount_{s}_12m" for s in _SCEN)} FROM amounts0)"""

_AMOUNT_COLS = [f"amount_{c}_12m_{s}" for c in _COMPS for s in _SCEN] + [f"amount_{s}_12m" for s in _SCEN]

FACT = f"""sc AS (SELECT customer_id, pct_rank AS score FROM levels),
f1 AS (SELECT f.customer_id, sc.score,
              CASE WHEN f.has_product_history = 1 THEN 'A' ELSE 'B' END AS model_used,
              f.has_product_history, f.trainable,
              CASE WHEN f.has_product_history = 1 THEN 'with_history' ELSE 'without_history' END AS population,
              f.savings_capacity * 12 AS annual_savings_capacity,
              CASE WHEN f.has_product_history = 1 THEN sc.score
                   WHEN f.savings_capacity * 12 IS NOT NULL THEN f.savings_capacity * 12 * sc.score
                   ELSE sc.score END AS reference_value,
              CASE WHEN f.has_product_history = 1 THEN 'propensity_score'
                   WHEN f.savings_capacity * 12 IS NOT NULL THEN 'proxy_annual_savings_capacity_x_similarity_score'
                   ELSE 'proxy_unavailable_fallback_similarity_score' END AS reference_type,
              f.segment, f.age_group, f.gender, f.housing, f.adoption_label
       FROM feat f LEFT JOIN sc USING (customer_id)),
f2a AS (SELECT f1.*, {", ".join(f"CASE WHEN h.customer_id IS NOT NULL THEN a.{c} END AS {c}" for c in _AMOUNT_COLS)},
               CAST(h.customer_id IS NOT NULL AS INTEGER) AS has_investment_history
        FROM f1 LEFT JOIN amounts a USING (customer_id) LEFT JOIN hist h ON f1.customer_id = h.customer_id),
f2b AS (SELECT * EXCLUDE (reference_value, reference_type),
               score * amount_base_12m AS expected_value_12m,
               CASE WHEN population = 'with_history' THEN coalesce(score * amount_base_12m, score)
                    ELSE reference_value END AS reference_value,
               CASE WHEN population = 'with_history' AND score * amount_base_12m IS NOT NULL
                      THEN 'expected_value_score_x_amount_12m'
                    WHEN population = 'with_history' THEN 'propensity_score'
                    ELSE reference_type END AS reference_type
        FROM f2a),
f2r AS (SELECT *, row_number() OVER (PARTITION BY population ORDER BY reference_value, customer_id) AS rn,
               count(*) OVER (PARTITION BY population) AS nn
        FROM f2b WHERE reference_value IS NOT NULL),
fact AS (SELECT * EXCLUDE (rn, nn),
                CASE WHEN rn * 4 <= nn THEN 'D' WHEN rn * 4 <= nn * 2 THEN 'C'
                     WHEN rn * 4 <= nn * 3 THEN 'B' ELSE 'A' END AS level FROM f2r
         UNION ALL SELECT *, CAST(NULL AS VARCHAR) FROM f2b WHERE reference_value IS NULL)"""

AMT_CTES = (BAL, CUT, MONTHLY, PANEL, COMP, BT)


def fact_with(*extra):
    return feat_with(LEVELS, COMP, BT, FACT, *extra)


def _rsel(cols, doubles, table):
    return "SELECT " + ", ".join(r(c, c) if c in doubles else c for c in cols) + f" FROM {table}"


SQL["component_pivot"] = with_(BAL, CUT, MONTHLY, PANEL, COMP) + \
    "SELECT customer_id, month, round(app, 6) AS app, round(conservative, 6) AS conservative, " \
    "round(invested, 6) AS invested FROM comp"

SQL["semi_history"] = with_(BAL, CUT, MONTHLY, PANEL, COMP, CUST) + """
SELECT c.customer_id, CAST(h.customer_id IS NOT NULL AS INTEGER) AS has_investment_history
FROM cust c LEFT JOIN hist h ON c.customer_id = h.customer_id"""

_WT_COLS = ["customer_id", "month_first", "month_last", "months"] + \
    [f"{c}_{k}" for c in _COMPS for k in ("start", "end", "growth")]
SQL["annualised_growth"] = with_(*AMT_CTES) + _rsel(
    _WT_COLS, {c for c in _WT_COLS if c.endswith(("start", "end", "growth"))}, "fw")

SQL["temporal_split"] = with_(BAL, CUT, MONTHLY, PANEL, COMP) + "SELECT n_months, valid_start FROM split"

SQL["backtest"] = with_(*AMT_CTES) + _rsel(
    ["customer_id", "component", "real", "pred", "error"], {"real", "pred", "error"}, "bt")

SQL["mae_mape"] = with_(*AMT_CTES) + """
SELECT component, round(avg(abs(real - pred)), 6) AS mae,
       round(avg(CASE WHEN abs(real) > 1.0 THEN abs((real - pred) / abs(real)) END), 6) AS ape_mean,
       CAST(count(*) AS BIGINT) AS n,
       CAST(count(*) FILTER (WHERE abs(real) > 1.0) AS BIGINT) AS n_ape,
       round(quantile_cont(CASE WHEN abs(real) > 1.0 THEN abs((real - pred) / abs(real)) END, 0.5), 6) AS ape_median_ratio
FROM bt WHERE real IS NOT NULL AND pred IS NOT NULL AND NOT isnan(real) AND NOT isnan(pred)
GROUP BY component"""

SQL["error_scenarios"] = with_(*AMT_CTES) + """,
ev AS (SELECT component, avg(CAST(error < 0 AS DOUBLE)) AS pct_negative FROM bt WHERE error IS NOT NULL GROUP BY component),
md AS (SELECT component, arg_max(error, {'c': c, 'e': -error}) AS modal_error, max(c) / sum(c) AS modal_mass
       FROM (SELECT component, error, count(*) AS c FROM bt WHERE error IS NOT NULL GROUP BY 1, 2) x GROUP BY component)
SELECT s.component, round(err_lo, 6) AS err_lo, round(err_median, 6) AS err_median, round(err_hi, 6) AS err_hi,
       round(pct_negative, 6) AS pct_negative, round(modal_error, 6) AS modal_error, round(modal_mass, 6) AS modal_mass
FROM scen s LEFT JOIN ev USING (component) LEFT JOIN md USING (component)"""

SQL["amount_scenarios"] = with_(*AMT_CTES) + _rsel(["customer_id"] + _AMOUNT_COLS, set(_AMOUNT_COLS), "amounts")

_SCORE_COLS = ["customer_id", "score", "model_used", "has_product_history", "trainable",
               "population", "annual_savings_capacity", "reference_value", "reference_type",
               "level", "has_investment_history", "expected_value_12m", "amount_base_12m",
               "amount_conservative_12m", "amount_optimistic_12m"]
SQL["score_fact"] = fact_with() + _rsel(
    _SCORE_COLS, {"score", "annual_savings_capacity", "reference_value", "expected_value_12m",
                  "amount_base_12m", "amount_conservative_12m", "amount_optimistic_12m"}, "fact")

SQL["gross_net_flows"] = fact_with() + """
SELECT CAST(count(*) FILTER (WHERE amount_base_12m > 0) AS BIGINT) AS n_inflow,
       round(coalesce(sum(CASE WHEN amount_base_12m IS NOT NULL THEN greatest(amount_base_12m, 0.0) END), 0.0), 6) AS gross_inflow_12m,
       CAST(count(*) FILTER (WHERE amount_base_12m < 0) AS BIGINT) AS n_outflow,
       round(coalesce(sum(CASE WHEN amount_base_12m IS NOT NULL THEN least(amount_base_12m, 0.0) END), 0.0), 6) AS gross_outflow_12m,
       round(coalesce(sum(CASE WHEN amount_base_12m IS NOT NULL THEN greatest(amount_base_12m, 0.0) END), 0.0)
             + coalesce(sum(CASE WHEN amount_base_12m IS NOT NULL THEN least(amount_base_12m, 0.0) END), 0.0), 6) AS net_12m
FROM fact WHERE has_investment_history = 1"""

DISP = """disp AS (SELECT level, CAST(count(amount_base_12m) AS BIGINT) AS n,
                 coalesce(sum(amount_base_12m), 0.0) AS total, avg(amount_base_12m) AS mean,
                 stddev_samp(amount_base_12m) AS std, CAST(count(DISTINCT amount_base_12m) AS BIGINT) AS n_distinct
          FROM fact WHERE has_investment_history = 1 GROUP BY level),
blk AS (SELECT fact.*, CASE WHEN has_investment_history <> 1 THEN 'no_estimable_amount'
                            WHEN disp.std < 1.0 THEN 'no_signal'
                            WHEN disp.mean > 0 THEN 'growth' ELSE 'withdrawal_risk' END AS commercial_block,
               CASE WHEN amount_base_12m IS NOT NULL THEN greatest(amount_base_12m, 0.0) END AS gross_inflow,
               CASE WHEN amount_base_12m IS NOT NULL THEN least(amount_base_12m, 0.0) END AS gross_outflow
        FROM fact LEFT JOIN disp ON fact.level IS NOT DISTINCT FROM disp.level)"""

SQL["level_dispersion"] = fact_with(DISP) + _rsel(
    ["level", "n", "total", "mean", "std", "n_distinct"], {"total", "mean", "std"}, "disp")

SQL["commercial_block"] = fact_with(DISP) + """
SELECT commercial_block, CAST(count(*) AS BIGINT) AS n_customers,
       round(coalesce(sum(amount_base_12m), 0.0), 6) AS amount_base,
       round(coalesce(sum(amount_app_12m_base), 0.0), 6) AS amount_app_base,
       round(coalesce(sum(amount_conservative_12m_base), 0.0), 6) AS amount_conservative_products_base
FROM blk GROUP BY commercial_block"""

SQL["sizing"] = fact_with(DISP) + """
SELECT level, commercial_block, population, segment, CAST(count(*) AS BIGINT) AS n_customers,
       round(coalesce(sum(amount_conservative_12m), 0.0), 6) AS amount_conservative,
       round(coalesce(sum(amount_base_12m), 0.0), 6) AS amount_base,
       round(coalesce(sum(amount_optimistic_12m), 0.0), 6) AS amount_optimistic,
       round(coalesce(sum(gross_inflow), 0.0), 6) AS gross_inflow,
       round(coalesce(sum(gross_outflow), 0.0), 6) AS gross_outflow,
       round(coalesce(sum(amount_app_12m_base), 0.0), 6) AS amount_app_base,
       round(coalesce(sum(amount_conservative_12m_base), 0.0), 6) AS amount_conservative_products_base,
       round(avg(score), 6) AS score_mean
FROM blk GROUP BY level, commercial_block, population, segment"""

SUMMARY = """summ AS (SELECT CAST(count(*) AS BIGINT) AS n_customers,
  CAST(count(*) FILTER (WHERE level IN ('A', 'B')) AS BIGINT) AS n_prioritised_a_b,
  CAST(count(*) FILTER (WHERE level = 'A') AS BIGINT) AS n_level_a,
  CAST(count(*) FILTER (WHERE level = 'A' AND population = 'with_history') AS BIGINT) AS n_level_a_with_history,
  CAST(count(*) FILTER (WHERE level = 'A' AND population = 'without_history') AS BIGINT) AS n_level_a_without_history,
  coalesce(sum(amount_base_12m) FILTER (WHERE has_investment_history = 1 AND amount_base_12m > 0), 0.0) AS gross_inflow_12m,
  CAST(count(*) FILTER (WHERE has_investment_history = 1 AND amount_base_12m > 0) AS BIGINT) AS n_inflow,
  coalesce(sum(amount_base_12m) FILTER (WHERE has_investment_history = 1 AND amount_base_12m < 0), 0.0) AS gross_outflow_12m,
  CAST(count(*) FILTER (WHERE has_investment_history = 1 AND amount_base_12m < 0) AS BIGINT) AS n_outflow,
  coalesce(sum(amount_conservative_12m) FILTER (WHERE has_investment_history = 1), 0.0) AS opportunity_conservative_12m,
  coalesce(sum(amount_base_12m) FILTER (WHERE has_investment_history = 1), 0.0) AS opportunity_base_12m,
  coalesce(sum(amount_optimistic_12m) FILTER (WHERE has_investment_history = 1), 0.0) AS opportunity_optimistic_12m,
  CAST(count(*) FILTER (WHERE has_investment_history = 1 AND amount_base_12m IS NOT NULL) AS BIGINT) AS n_with_amount,
  avg(amount_optimistic_12m - amount_conservative_12m) FILTER (WHERE has_investment_history = 1) AS mean_customer_width
FROM fact)"""

_SUMM_D = ["gross_inflow_12m", "gross_outflow_12m", "opportunity_conservative_12m", "opportunity_base_12m",
           "opportunity_optimistic_12m", "mean_customer_width", "net_12m"]
SQL["executive_summary"] = fact_with(SUMMARY) + ",\nsumm2 AS (SELECT *, gross_inflow_12m + gross_outflow_12m AS net_12m, coalesce((SELECT string_agg(level, ',' ORDER BY level) FROM (SELECT level FROM fact WHERE has_investment_history = 1 AND level IS NOT NULL GROUP BY level HAVING stddev_samp(amount_base_12m) < 1.0) z), '') AS levels_without_signal FROM summ)\n" + _rsel(
    ["n_customers", "n_prioritised_a_b", "n_level_a", "n_level_a_with_history", "n_level_a_without_history",
     "gross_inflow_12m", "n_inflow", "gross_outflow_12m", "n_outflow", "opportunity_conservative_12m",
     "opportunity_base_12m", "opportunity_optimistic_12m", "n_with_amount", "mean_customer_width", "net_12m",
     "levels_without_signal"], set(_SUMM_D), "summ2")

SQL["band_widths"] = fact_with(SUMMARY) + """
SELECT round(opportunity_optimistic_12m - opportunity_conservative_12m, 6) AS aggregate_width,
       round(mean_customer_width, 6) AS mean_customer_width,
       round(CASE WHEN mean_customer_width <> 0 THEN (opportunity_optimistic_12m - opportunity_conservative_12m) / mean_customer_width END, 6) AS width_scale_factor,
       round(sqrt(CAST(n_with_amount AS DOUBLE)), 6) AS sqrt_n,
       round(CASE WHEN opportunity_base_12m <> 0 THEN (opportunity_optimistic_12m - opportunity_conservative_12m) / abs(opportunity_base_12m) END, 6) AS relative_width_perfect_correlation,
       round(CASE WHEN opportunity_base_12m <> 0 THEN (opportunity_optimistic_12m - opportunity_conservative_12m) / abs(opportunity_base_12m) END / sqrt(CAST(n_with_amount AS DOUBLE)), 6) AS relative_width_independence
FROM summ"""

SQL["capture_scenarios"] = fact_with(SUMMARY) + ",\nrates(scenario, capture_rate) AS (VALUES " + ", ".join(
    f"('{n}', CAST({v} AS DOUBLE))" for n, v in S.capture_rates) + """)
SELECT scenario, round(capture_rate, 6) AS capture_rate, round(gross_inflow_12m * capture_rate, 6) AS opportunity_12m
FROM summ, rates"""

SQL["component_split"] = fact_with() + """
SELECT round(coalesce(sum(amount_app_12m_base), 0.0), 6) AS app_base,
       round(coalesce(sum(amount_conservative_12m_base), 0.0), 6) AS conservative_products_base
FROM fact WHERE has_investment_history = 1"""

SEL = "sel AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS attribute, coalesce(CAST({a} AS VARCHAR), '{S.missing_label}') AS \"group\", level FROM fact"
    for a in _AUD) + """),
rates AS (SELECT attribute, "group", CAST(count(*) AS BIGINT) AS n,
                 CAST(count(*) FILTER (WHERE level = 'A') AS BIGINT) AS n_selected,
                 CAST(count(*) FILTER (WHERE level = 'A') AS DOUBLE) / count(*) AS selection_rate
          FROM sel GROUP BY attribute, "group"),
di AS (SELECT attribute, min(selection_rate) AS min_rate, max(selection_rate) AS max_rate,
              CASE WHEN max(selection_rate) > 0 THEN min(selection_rate) / max(selection_rate) END AS impact_ratio
       FROM rates GROUP BY attribute),
di2 AS (SELECT di.*, CAST(coalesce(impact_ratio >= 0.8, false) AS INTEGER) AS passes_80_rule,
               (SELECT min("group") FROM rates r WHERE r.attribute = di.attribute AND r.selection_rate = di.min_rate) AS worst_group,
               (SELECT min("group") FROM rates r WHERE r.attribute = di.attribute AND r.selection_rate = di.max_rate) AS best_group
        FROM di)"""

SQL["selection_rate"] = fact_with(SEL) + """
SELECT attribute, "group", n, n_selected, round(selection_rate, 6) AS selection_rate FROM rates"""

SQL["disparate_impact"] = fact_with(SEL) + """
SELECT attribute, round(min_rate, 6) AS min_rate, round(max_rate, 6) AS max_rate,
       round(impact_ratio, 6) AS impact_ratio, passes_80_rule, worst_group, best_group FROM di2"""

# --------------------------------------------------------------------------
# marts and reports
# --------------------------------------------------------------------------
_PCTS = (0.01, 0.05, 0.10, 0.20)
CURVE = """tc AS (SELECT customer_id, score, adoption_label AS y FROM fact
               WHERE population = 'with_history' AND score IS NOT NULL),
tcr AS (SELECT *, row_number() OVER (ORDER BY score DESC, customer_id DESC) AS rn, count(*) OVER () AS n FROM tc),
pcts(p) AS (VALUES """ + ", ".join(f"(CAST({p} AS DOUBLE))" for p in _PCTS) + """),
curve0 AS (SELECT p AS top_pct, CAST(greatest(1, ceil(n * p)) AS BIGINT) AS n_contacted,
                  CAST(count(*) FILTER (WHERE rn <= greatest(1, ceil(n * p)) AND y = 1) AS BIGINT) AS hits,
                  sum(y) AS positives, n
           FROM tcr, pcts GROUP BY p, n),
curve AS (SELECT top_pct, n_contacted, hits, CAST(hits AS DOUBLE) / n_contacted AS precision,
                 CASE WHEN positives > 0 THEN CAST(hits AS DOUBLE) / positives END AS recall,
                 CASE WHEN positives > 0 THEN (CAST(hits AS DOUBLE) / n_contacted) / (CAST(positives AS DOUBLE) / n) END AS lift
          FROM curve0)"""

SQL["targeting_curve"] = fact_with(CURVE) + """
SELECT round(top_pct, 6) AS top_pct, n_contacted, hits, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(lift, 6) AS lift FROM curve"""

SQL["curve_long"] = fact_with(CURVE) + """
SELECT round(top_pct, 6) AS top_pct, 'precision' AS metric, round(precision, 6) AS value FROM curve
UNION ALL SELECT round(top_pct, 6), 'recall', round(recall, 6) FROM curve"""

SQL["contact_list"] = fact_with() + """,
sel AS (SELECT * FROM fact WHERE level IN ('A') AND reference_value IS NOT NULL),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY population ORDER BY reference_value, customer_id) AS DOUBLE)
                     / count(*) OVER (PARTITION BY population) AS percentile_in_group FROM sel)
SELECT CAST(customer_id AS VARCHAR) AS customer_id, population, level, round(percentile_in_group, 6) AS percentile_in_group,
       segment, age_group, round(score, 6) AS score, model_used, round(amount_base_12m, 6) AS amount_base_12m,
       round(expected_value_12m, 6) AS expected_value_12m
FROM ranked ORDER BY percentile_in_group DESC, customer_id ASC LIMIT 100"""

FACETS = """fc AS (SELECT population, level, segment, CAST(count(*) AS BIGINT) AS n,
                 CAST(sum(has_investment_history) AS BIGINT) AS n_with_investment,
                 coalesce(sum(CASE WHEN amount_base_12m IS NOT NULL THEN greatest(amount_base_12m, 0.0) END), 0.0) AS gross_inflow
          FROM fact GROUP BY population, level, segment)"""

SQL["facet_counts"] = fact_with(FACETS) + """
SELECT population, level, segment, n, n_with_investment, round(gross_inflow, 6) AS gross_inflow FROM fc"""

SQL["facet_total"] = fact_with(FACETS) + """
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS n, round(coalesce(sum(gross_inflow), 0.0), 6) AS gross_inflow
FROM fc WHERE population IN ('with_history') AND level IN ('A', 'B')"""

SQL["facet_values"] = fact_with() + """
SELECT DISTINCT 'population' AS facet, CAST(population AS VARCHAR) AS value FROM fact WHERE population IS NOT NULL
UNION ALL SELECT DISTINCT 'level', CAST(level AS VARCHAR) FROM fact WHERE level IS NOT NULL
UNION ALL SELECT DISTINCT 'segment', CAST(segment AS VARCHAR) FROM fact WHERE segment IS NOT NULL"""

SQL["population_strategies"] = fact_with() + """
SELECT population, CAST(count(*) AS BIGINT) AS n, CAST(sum(has_investment_history) AS BIGINT) AS n_with_investment,
       CAST(CASE WHEN population = 'without_history' THEN count(*) ELSE 0 END AS BIGINT) AS strategy_acquisition,
       CAST(CASE WHEN population = 'with_history' THEN count(*) - sum(has_investment_history) ELSE 0 END AS BIGINT) AS strategy_activation,
       CAST(sum(has_investment_history) AS BIGINT) AS strategy_growth
FROM fact GROUP BY population"""

SQL["tie_mass"] = fact_with() + """,
pv AS (SELECT population, reference_value, count(*) AS c, count(DISTINCT level) AS n_levels,
              max(CAST(level = 'A' AS INTEGER)) AS in_a, max(CAST(level = 'B' AS INTEGER)) AS in_b
       FROM fact WHERE reference_value IS NOT NULL GROUP BY population, reference_value),
g AS (SELECT population, CAST(sum(c) AS BIGINT) AS n_customers,
             arg_max(reference_value, {'c': c, 'v': -reference_value}) AS modal_value,
             CAST(max(c) AS BIGINT) AS n_at_modal,
             CAST(count(*) FILTER (WHERE n_levels > 1) AS BIGINT) AS n_values_multilevel,
             CAST(count(*) FILTER (WHERE in_a = 1 AND in_b = 1) AS BIGINT) AS n_values_border_ab,
             CAST(coalesce(sum(c) FILTER (WHERE in_a = 1 AND in_b = 1), 0) AS BIGINT) AS n_customers_border_ab
      FROM pv GROUP BY population)
SELECT population, n_customers, round(modal_value, 6) AS modal_value, n_at_modal, n_values_multilevel,
       n_values_border_ab, n_customers_border_ab,
       round(CAST(n_at_modal AS DOUBLE) / n_customers, 6) AS pct_at_modal,
       round(CAST(n_customers_border_ab AS DOUBLE) / n_customers, 6) AS pct_customers_border_ab
FROM g"""

_ORD = "CASE {c} WHEN 'D' THEN 0 WHEN 'C' THEN 1 WHEN 'B' THEN 2 WHEN 'A' THEN 3 END"
SQL["level_shift"] = fact_with() + f""",
f1r AS (SELECT customer_id, row_number() OVER (PARTITION BY population ORDER BY reference_value, customer_id) AS rn,
               count(*) OVER (PARTITION BY population) AS nn FROM f1 WHERE reference_value IS NOT NULL),
f1l AS (SELECT customer_id, CASE WHEN rn * 4 <= nn THEN 'D' WHEN rn * 4 <= nn * 2 THEN 'C'
                                 WHEN rn * 4 <= nn * 3 THEN 'B' ELSE 'A' END AS la FROM f1r),
d AS (SELECT abs(({_ORD.format(c='la')}) - ({_ORD.format(c='fact.level')})) AS distance
      FROM f1l JOIN fact USING (customer_id)),
d2 AS (SELECT distance FROM d WHERE distance IS NOT NULL),
bins(distance) AS (VALUES (0), (1), (2), (3)),
h AS (SELECT b.distance, CAST(count(d2.distance) AS BIGINT) AS n FROM bins b LEFT JOIN d2 ON b.distance = d2.distance
      GROUP BY b.distance)
SELECT CAST(distance AS INTEGER) AS distance, n,
       round(CAST(sum(CASE WHEN distance >= 2 THEN n ELSE 0 END) OVER () AS DOUBLE) / sum(n) OVER (), 6)
         AS share_distance_2_plus
FROM h"""

SQL["stratified_rates"] = feat_with() + """,
sblk AS (SELECT 'all' AS stratum, has_income_estimate, CAST(count(*) AS BIGINT) AS n,
               CAST(sum(adoption_label) AS BIGINT) AS positives FROM feat GROUP BY has_income_estimate
        UNION ALL
        SELECT 'has_product_history', has_income_estimate, CAST(count(*) AS BIGINT),
               CAST(sum(adoption_label) AS BIGINT) FROM feat WHERE has_product_history = 1
        GROUP BY has_income_estimate),
srt AS (SELECT *, CAST(positives AS DOUBLE) / n AS rate, sum(n) OVER w AS nn, sum(positives) OVER w AS pp, count(*) OVER w AS k
        FROM sblk WINDOW w AS (PARTITION BY stratum)),
sx AS (SELECT *, n * pp / nn AS x1, n * (nn - pp) / nn AS x0 FROM srt),
sy AS (SELECT *, CASE WHEN k = 2 AND pp > 0 AND pp < nn THEN
              power(abs(positives - x1) - least(0.5, abs(positives - x1)), 2) / x1
              + power(abs((n - positives) - x0) - least(0.5, abs((n - positives) - x0)), 2) / x0 END AS cell FROM sx),
sz AS (SELECT *, sum(cell) OVER (PARTITION BY stratum) AS chi2 FROM sy)
SELECT stratum, has_income_estimate, n, positives, round(rate, 6) AS rate,
       round(max(CASE WHEN has_income_estimate = 1 THEN rate END) OVER (PARTITION BY stratum)
             - max(CASE WHEN has_income_estimate = 0 THEN rate END) OVER (PARTITION BY stratum), 6) AS rate_difference,
       round(chi2, 6) AS chi2, CASE WHEN chi2 IS NOT NULL THEN 1 END AS dof,
       round(""" + _p_chi2("chi2", "1") + """, 6) AS p_value
FROM sz"""

SQL["plausibility"] = feat_with() + """
SELECT 'savings_capacity' AS variable, CAST(count(savings_capacity) AS BIGINT) AS n,
       CAST(count(*) FILTER (WHERE savings_capacity > 10000.0) AS BIGINT) AS n_above,
       round(quantile_cont(savings_capacity, 0.0), 6) AS p000, round(quantile_cont(savings_capacity, 0.01), 6) AS p001,
       round(quantile_cont(savings_capacity, 0.25), 6) AS p025, round(quantile_cont(savings_capacity, 0.5), 6) AS p050,
       round(quantile_cont(savings_capacity, 0.75), 6) AS p075, round(quantile_cont(savings_capacity, 0.99), 6) AS p099,
       round(quantile_cont(savings_capacity, 1.0), 6) AS p100
FROM feat"""

IVS = """ivs AS (SELECT variable, sum(iv_bin) AS iv FROM (
          SELECT variable, iv_bin FROM woe_num UNION ALL SELECT variable, iv_bin FROM woe_cat) u
        GROUP BY variable)"""

_FLAGS = {"missing_estimator", "has_income_estimate", "no_financial_any", "no_financial_all", "missing_financial",
          "no_recent_data", "missing_housing", "has_housing_data", "liquid_cv_insufficient"}
_VIF_CAND = [c for c in NUM_VARS if c not in _FLAGS]
#: VIF by sweeping each column's correlation matrix of all others (needs WITH RECURSIVE).
VIF = f"""velig AS (SELECT list_filter(range(1, {len(_VIF_CAND) + 1}), lambda i: nn[i] * 2 < n) AS idx
          FROM (SELECT [{", ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in _VIF_CAND)}] AS nn, count(*) AS n FROM feat) q),
vsel AS (SELECT list_transform(e.idx, lambda i: r.v[i]) AS x
         FROM (SELECT [{", ".join(f"CAST({c} AS DOUBLE)" for c in _VIF_CAND)}] AS v FROM feat) r, velig e),
vok AS (SELECT x FROM vsel WHERE len(list_filter(x, lambda a: a IS NULL)) = 0),
vidx AS (SELECT unnest(range(1, len(idx) + 1)) AS i FROM velig),
vcorr AS (SELECT a.i, b.i AS j, corr(x[a.i], x[b.i]) AS c FROM vok, vidx a, vidx b GROUP BY a.i, b.i),
vrows AS (SELECT i, list(CASE WHEN c IS NULL OR isnan(c) THEN 0.0 ELSE c END ORDER BY j) AS cs FROM vcorr GROUP BY i),
vmat AS (SELECT list(cs ORDER BY i) AS m FROM vrows),
sweep AS (SELECT vidx.i AS own, CAST(1 AS BIGINT) AS p, m FROM vmat, vidx
          UNION ALL
          SELECT own, p + 1, CASE WHEN p <> own AND m[p][p] > 1e-10 THEN
                   list_transform(m, lambda r: list_transform(range(1, len(m) + 1), lambda j: r[j] - r[p] * m[p][j] / m[p][p])) ELSE m END
          FROM sweep WHERE p <= len(m)),
vif AS (SELECT [{", ".join(f"'{c}'" for c in _VIF_CAND)}][idx[own]] AS variable,
               CASE WHEN m[own][own] > 1e-10 THEN 1.0 / m[own][own] ELSE CAST('inf' AS DOUBLE) END AS vif
        FROM sweep, velig WHERE p = len(m) + 1)"""

DECISIONS = f"""hd AS (SELECT CASE WHEN max(iv) FILTER (WHERE variable = 'housing') >= {S.iv_min} THEN 'keep_category'
                   WHEN max(iv) FILTER (WHERE variable = 'has_housing_data') >= {S.iv_min} THEN 'keep_flag'
                   ELSE 'drop' END AS housing_decision FROM ivs),
dec0 AS (SELECT ivs.variable, ivs.iv, vif.vif, CAST(vif.vif > {S.vif_alert} AS INTEGER) AS vif_alert, housing_decision,
       CASE WHEN ivs.variable = 'gender' THEN 'exclude_protected'
            WHEN ivs.variable = 'housing' THEN CASE housing_decision WHEN 'keep_category' THEN 'include'
              WHEN 'keep_flag' THEN 'exclude_use_flag' ELSE 'exclude_block' END
            WHEN ivs.variable IN ('has_housing_data', 'missing_housing') THEN
              CASE housing_decision WHEN 'keep_flag' THEN 'include' ELSE 'exclude_redundant' END
            WHEN ivs.iv IS NULL THEN 'review'
            WHEN ivs.iv < {S.iv_min} THEN 'exclude_low_iv'
            WHEN vif.vif > {S.vif_alert} THEN 'include_vif_alert' ELSE 'include' END AS decision
FROM ivs LEFT JOIN vif ON vif.variable = ivs.variable, hd),
dec AS (SELECT *, CASE WHEN decision = 'exclude_protected' THEN 'suitability, not predictive power'
                       WHEN variable IN ('housing', 'has_housing_data', 'missing_housing') THEN 'housing rule: ' || housing_decision
                       WHEN decision = 'exclude_low_iv' THEN 'iv below minimum'
                       WHEN decision = 'include_vif_alert' THEN 'collinear, reported' END AS reason,
               {_IVC} AS iv_class FROM dec0)"""
DEC_CTES = (NUM_LONG, NUM_BINS, WOE_NUM, CAT_LONG, WOE_CAT, IVS, VIF, DECISIONS)


def decisions_with(*extra):
    return feat_with(*DEC_CTES, *extra).replace("WITH ", "WITH RECURSIVE ", 1)


SQL["vif_all"] = feat_with(VIF).replace("WITH ", "WITH RECURSIVE ", 1) + "SELECT variable, round(vif, 4) AS vif FROM vif"

SQL["table_profile"] = decisions_with() + f""",
roles(variable, role) AS (VALUES {_roles_values()}),
types AS (SELECT column_name AS variable, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
            WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS type FROM (DESCRIBE SELECT * FROM feat)),
nulls AS ({" UNION ALL ".join(f"SELECT '{c}' AS variable, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null, count(*) AS n FROM feat" for c in FEATURE_COLUMNS)})
SELECT roles.variable, role, type, n_null, round(n_null / n, 6) AS null_share, round(iv, 6) AS iv, iv_class, decision
FROM roles JOIN nulls USING (variable) JOIN types USING (variable) LEFT JOIN dec ON roles.variable = dec.variable"""

SQL["decision_rules"] = decisions_with() + """
SELECT variable, round(iv, 6) AS iv, iv_class, vif_alert, decision, reason FROM dec"""

VALIDATION = f"""vtypes(variable, type) AS (VALUES {", ".join([f"('{c}', 'continuous')" for c in NUM_VARS] + [f"('{c}', 'categorical')" for c in CAT_VARS])}),
vnull AS ({" UNION ALL ".join(f"SELECT '{c}' AS variable, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null FROM feat" for c in NUM_VARS + CAT_VARS)}),
vpmw AS (SELECT variable, {_p_z("z")} AS p_mann_whitney FROM mw),
vpch AS (SELECT variable, chi2, cramers_v, {_p_chi2("chi2", "dof")} AS p_chi2 FROM chi),
vp AS (SELECT variable, coalesce(p_mann_whitney, p_chi2) AS p_value FROM vtypes LEFT JOIN vpmw USING (variable) LEFT JOIN vpch USING (variable)),
vbr AS (SELECT variable, p_value, row_number() OVER (ORDER BY p_value, variable) AS rn, count(*) OVER () AS n FROM vp WHERE p_value IS NOT NULL),
vbh AS (SELECT variable, least(min(p_value * n / rn) OVER (ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 1.0) AS q_value FROM vbr),
validation AS (SELECT t.variable, t.type, u.n_null, d.iv, d.iv_class, m.p_mann_whitney, md.median_event, md.median_non_event, c.chi2, c.p_chi2,
       c.cramers_v, p.p_value, b.q_value, CAST(b.q_value <= 0.05 AS INTEGER) AS significant, round(d.vif, 4) AS vif, d.vif_alert, d.decision, d.reason
FROM vtypes t JOIN vnull u USING (variable) LEFT JOIN vpmw m USING (variable) LEFT JOIN med md USING (variable) LEFT JOIN vpch c USING (variable)
LEFT JOIN vp p USING (variable) LEFT JOIN vbh b USING (variable) LEFT JOIN dec d ON d.variable = t.variable)"""
VAL_CTES = (MW, _chi(CAT_VARS, "feat", "adoption_label", "chi"), VALIDATION)
_VAL_D = ["iv", "p_mann_whitney", "median_event", "median_non_event", "chi2", "p_chi2", "cramers_v", "p_value", "q_value"]
SQL["validation_table"] = decisions_with(*VAL_CTES) + "SELECT variable, type, n_null, iv_class, significant, vif, vif_alert, decision, reason, " + \
    ", ".join(f"round({c}, 6) AS {c}" for c in _VAL_D) + " FROM validation"


def _auc_sql(label_expr, name, known="true"):
    return f"""{name}_a AS (SELECT {label_expr} AS y, CAST(liquid_balance_total AS DOUBLE) AS value FROM feat
                WHERE liquid_balance_total IS NOT NULL AND {known}),
{name}_r AS (SELECT y, (2 * rank() OVER (ORDER BY value) + count(*) OVER (PARTITION BY value) - 1) / 2.0 AS mr FROM {name}_a),
{name} AS (SELECT CASE WHEN sum(y) > 0 AND count(*) - sum(y) > 0
                   THEN (sum(mr * y) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))) END AS auc
           FROM {name}_r)"""


def _band(lo, hi):
    return f"CASE WHEN auc < {lo} THEN 'low' WHEN auc <= {hi} THEN 'moderate' ELSE 'high' END"


SQL["fairness_fact"] = fact_with(SEL, _ovr("fact", "score", "ovs"), _auc_sql("CAST(gender = 'F' AS INTEGER)", "prx", "gender IS NOT NULL")) + f"""
SELECT r.attribute, r."group", r.n, r.n_selected, round(r.selection_rate, 6) AS selection_rate,
       round(z.mean, 6) AS score_mean, round(z.median, 6) AS score_median, round({_p_z("z.z")}, 6) AS p_value,
       round(d.impact_ratio, 6) AS impact_ratio, d.passes_80_rule, round(prx.auc, 6) AS proxy_auc,
       {_band(S.auc_proxy_moderate, S.auc_proxy_substantial)} AS proxy_band
FROM rates r LEFT JOIN di2 d USING (attribute) LEFT JOIN ovs_z z ON z.attribute = r.attribute AND z.grp = r."group", prx"""

AUC_RULES = f"""rules AS (SELECT 'missing_estimator_pattern' AS rule, auc, {_band(S.auc_pattern_weak, S.auc_pattern_informative)} AS band FROM pat
UNION ALL
SELECT 'gender_proxy', auc, {_band(S.auc_proxy_moderate, S.auc_proxy_substantial)} FROM prx),
bands AS (SELECT rule, auc, band, CASE rule WHEN 'gender_proxy'
         THEN CASE band WHEN 'low' THEN 'minimal proxy' WHEN 'moderate' THEN 'moderate proxy' ELSE 'substantial proxy' END
         ELSE CASE band WHEN 'low' THEN 'about random' WHEN 'moderate' THEN 'weak pattern' ELSE 'informative absence' END END AS conclusion,
       CASE rule WHEN 'gender_proxy'
         THEN CASE band WHEN 'low' THEN 'document_and_continue' WHEN 'moderate' THEN 'document_associated_variables' ELSE 'investigate_mitigation' END
         ELSE CASE band WHEN 'high' THEN 'flag_as_predictor_no_global_imputation' ELSE 'keep_flag_without_imputing' END END AS action,
       CASE WHEN rule <> 'gender_proxy' THEN 0 END AS impute,
       CASE WHEN rule <> 'gender_proxy' THEN CAST(band = 'high' AS INTEGER) END AS flag_as_predictor,
       CAST(band <> 'low' AS INTEGER) AS document_variables FROM rules)"""
RULE_CTES = (_auc_sql("missing_estimator", "pat"), _auc_sql("CAST(gender = 'F' AS INTEGER)", "prx", "gender IS NOT NULL"), AUC_RULES)
SQL["auc_bands"] = feat_with(*RULE_CTES) + """
SELECT rule, round(auc, 6) AS auc, band, conclusion, action, impute, flag_as_predictor, document_variables FROM bands"""

SQL["imputation_plan"] = feat_with(*RULE_CTES) + """
SELECT action, 'none' AS kind, CAST(NULL AS VARCHAR) AS segment, CAST(NULL AS DOUBLE) AS value
FROM bands WHERE rule = 'missing_estimator_pattern' AND action = 'keep_flag_without_imputing'
UNION ALL
SELECT action, CASE action WHEN 'keep_flag_impute_segment_median' THEN 'segment_median' ELSE 'offered_segment_median' END, segment, round(m, 6)
FROM bands, (SELECT segment, quantile_cont(income_estimate, 0.5) AS m FROM feat WHERE income_estimate IS NOT NULL GROUP BY segment) x
WHERE rule = 'missing_estimator_pattern' AND action <> 'keep_flag_without_imputing'"""

SQL["importance_iv_join"] = decisions_with(*VAL_CTES) + """
SELECT coalesce(i.variable, v.variable) AS variable, round(abs(i.u / (i.n_event * i.n_non_event) - 0.5), 6) AS importance,
       round(v.iv, 6) AS iv, v.iv_class, v.vif, v.vif_alert, round(v.q_value, 6) AS q_value, v.significant, v.decision
FROM mw i FULL OUTER JOIN validation v ON i.variable = v.variable
ORDER BY abs(i.u / (i.n_event * i.n_non_event) - 0.5) DESC NULLS LAST, 1"""

SQL["evidence_topk"] = feat_with(NUM_LONG, NUM_BINS, WOE_NUM) + f""",
ev AS (SELECT b.customer_id, b.variable, b.value, b.bin_kind, b.bin_lo, b.bin_hi, w.woe, abs(w.woe) AS strength,
              CASE WHEN w.woe IS NULL OR abs(w.woe) < {S.evidence_neutral_woe} THEN 'neutral'
                   WHEN w.woe > 0 THEN 'against' ELSE 'in_favour' END AS direction, w.n AS n_in_bin
       FROM nbin b JOIN woe_num w ON b.variable = w.variable AND b.bin_kind IS NOT DISTINCT FROM w.bin_kind
            AND b.bin_lo IS NOT DISTINCT FROM w.bin_lo AND b.bin_hi IS NOT DISTINCT FROM w.bin_hi),
evr AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY strength DESC, variable) AS rank FROM ev)
SELECT customer_id, CAST(rank AS INTEGER) AS rank, variable, round(value, 6) AS value, bin_kind,
       round(bin_lo, 6) AS bin_lo, round(bin_hi, 6) AS bin_hi, round(woe, 6) AS woe, round(strength, 6) AS strength,
       direction, n_in_bin
FROM evr WHERE rank <= 3"""

SQL["psi_drift"] = with_(BAL, CUT, MONTHLY, PANEL) + f""",
base AS (SELECT product, balance_month AS v FROM panel, params
         WHERE month = CAST(cut_month - INTERVAL 12 MONTH AS DATE) AND balance_month IS NOT NULL),
cur AS (SELECT product, balance_month AS v FROM panel, params WHERE month = cut_month AND balance_month IS NOT NULL),
edges AS (SELECT product, list_sort(list_distinct(quantile_cont(v, {DEC}))) AS e FROM base GROUP BY product),
bb AS (SELECT product, len(list_filter(e[2:len(e) - 1], lambda x: x < v)) AS bin, count(*) AS n_base
       FROM base JOIN edges USING (product) GROUP BY 1, 2),
bc AS (SELECT product, len(list_filter(e[2:len(e) - 1], lambda x: x < v)) AS bin, count(*) AS n_current
       FROM cur JOIN edges USING (product) GROUP BY 1, 2),
j AS (SELECT coalesce(bb.product, bc.product) AS product, coalesce(bb.bin, bc.bin) AS bin,
             coalesce(n_base, 0) AS n_base, coalesce(n_current, 0) AS n_current
      FROM bb FULL OUTER JOIN bc ON bb.product = bc.product AND bb.bin = bc.bin),
t AS (SELECT product, (n_current + 0.5) / (sum(n_current) OVER (PARTITION BY product) + 0.5 * count(*) OVER (PARTITION BY product)) AS p,
             (n_base + 0.5) / (sum(n_base) OVER (PARTITION BY product) + 0.5 * count(*) OVER (PARTITION BY product)) AS q
      FROM j)
SELECT product, round(sum((p - q) * ln(p / q)), 6) AS psi, CAST(count(*) AS BIGINT) AS n_bins FROM t GROUP BY product"""

SQL["training_population"] = feat_with() + "SELECT customer_id FROM feat WHERE trainable = 1"

SQL["customer_lookup"] = feat_with() + "SELECT * REPLACE (" + ", ".join(
    f"round({c}, 6) AS {c}" for c in FEAT_DOUBLES) + ") FROM feat WHERE customer_id = CAST('7' AS BIGINT)"


# --------------------------------------------------------------------------
# further reports
# --------------------------------------------------------------------------
SQL["level_crosstab"] = fact_with() + """
SELECT 'population' AS row_variable, population AS row_value, level, CAST(count(*) AS BIGINT) AS n
FROM fact GROUP BY population, level
UNION ALL
SELECT 'segment', segment, level, CAST(count(*) AS BIGINT) FROM fact GROUP BY segment, level"""

SQL["decision_counts"] = decisions_with() + """
SELECT decision, CAST(count(*) AS BIGINT) AS n FROM dec GROUP BY decision"""

_OV = ["missing_estimator", "missing_housing", "missing_financial"]
SQL["missing_overlap"] = feat_with() + "SELECT CAST(count(*) AS BIGINT) AS n, " + ", ".join(
    [f"CAST(count(*) FILTER (WHERE {a} = 1) AS BIGINT) AS n_{a}" + "".join(
        f", CAST(count(*) FILTER (WHERE {a} = 1 AND {b} = 1) AS BIGINT) AS n_{a}_and_{b}" for b in _OV[i + 1:])
     for i, a in enumerate(_OV)]) + " FROM feat"

SQL["id_check"] = with_(CUST) + """
SELECT CAST(count(*) FILTER (WHERE NOT regexp_matches(CAST(customer_id AS VARCHAR), '^-?\\d{1,20}$')) AS BIGINT) AS n_bad_ids,
       CAST(count(*) AS BIGINT) AS n_ids FROM cust_raw"""

SQL["importance_top"] = feat_with(NUM_LONG, MW) + """
SELECT variable, round(abs(u / (n_event * n_non_event) - 0.5), 6) AS importance FROM mw
ORDER BY abs(u / (n_event * n_non_event) - 0.5) DESC NULLS LAST, variable LIMIT 12"""

SQL["facet_reconciliation"] = fact_with(FACETS) + """,
again AS (SELECT population, level, segment, count(*) AS n2,
                 coalesce(sum(CASE WHEN amount_base_12m IS NOT NULL THEN greatest(amount_base_12m, 0.0) END), 0.0) AS g2
          FROM fact GROUP BY population, level, segment),
j AS (SELECT * FROM fc FULL OUTER JOIN again
        ON fc.population IS NOT DISTINCT FROM again.population AND fc.level IS NOT DISTINCT FROM again.level
       AND fc.segment IS NOT DISTINCT FROM again.segment)
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS n_pre, CAST(coalesce(sum(n2), 0) AS BIGINT) AS n_recomputed,
       CAST(count(*) FILTER (WHERE n IS NULL OR n2 IS NULL OR n <> n2 OR abs(gross_inflow - g2) > 1e-6) AS BIGINT)
         AS n_mismatched_cells
FROM j"""

SQL["woe_retained"] = decisions_with() + """
SELECT variable, bin_kind, round(bin_lo, 6) AS bin_lo, round(bin_hi, 6) AS bin_hi, CAST(NULL AS VARCHAR) AS bin,
       n, events, round(woe, 6) AS woe
FROM woe_num WHERE variable IN (SELECT variable FROM dec WHERE decision IN ('include', 'include_vif_alert'))
UNION ALL
SELECT variable, 'category', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), bin, n, events, round(woe, 6)
FROM woe_cat WHERE variable IN (SELECT variable FROM dec WHERE decision IN ('include', 'include_vif_alert'))"""

SQL["segment_median_impute"] = feat_with() + """,
med AS (SELECT segment, quantile_cont(income, 0.5) AS m FROM feat WHERE income IS NOT NULL GROUP BY segment)
SELECT customer_id, feat.segment, round(coalesce(income, med.m), 6) AS income_imputed,
       CAST(income IS NULL AS INTEGER) AS imputed
FROM feat LEFT JOIN med ON feat.segment IS NOT DISTINCT FROM med.segment"""

_CB = ["income", "savings_capacity", "liquid_balance_total"]
CB_LONG = "nl AS (" + " UNION ALL ".join(
    f"SELECT customer_id, has_housing_data AS y, '{c}' AS variable, CAST({c} AS DOUBLE) AS value FROM feat"
    for c in _CB) + ")"
SQL["capture_bias"] = feat_with(CB_LONG, MW) + """
SELECT variable, n_event, n_non_event, round(u, 6) AS u, round(z, 6) AS z,
       round(median_event, 6) AS median_event, round(median_non_event, 6) AS median_non_event
FROM mw LEFT JOIN med USING (variable)"""

SQL["customer_serving"] = fact_with() + """,
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY population ORDER BY reference_value, customer_id) AS DOUBLE)
                     / count(*) OVER (PARTITION BY population) AS percentile_in_group
           FROM fact WHERE reference_value IS NOT NULL)
SELECT CAST(customer_id AS VARCHAR) AS customer_id, population, level, round(percentile_in_group, 6) AS percentile_in_group,
       segment, age_group, round(score, 6) AS score, model_used, round(amount_base_12m, 6) AS amount_base_12m,
       round(expected_value_12m, 6) AS expected_value_12m, has_investment_history
FROM ranked"""

_KV = ["n_customers", "n_prioritised_a_b", "n_level_a", "n_level_a_with_history", "n_level_a_without_history",
       "gross_inflow_12m", "n_inflow", "gross_outflow_12m", "n_outflow", "opportunity_conservative_12m",
       "opportunity_base_12m", "opportunity_optimistic_12m", "n_with_amount", "mean_customer_width", "net_12m"]
SQL["summary_kv"] = fact_with(SUMMARY) + ",\nsumm2 AS (SELECT *, gross_inflow_12m + gross_outflow_12m AS net_12m, coalesce((SELECT string_agg(level, ',' ORDER BY level) FROM (SELECT level FROM fact WHERE has_investment_history = 1 AND level IS NOT NULL GROUP BY level HAVING stddev_samp(amount_base_12m) < 1.0) z), '') AS levels_without_signal FROM summ)\n" + \
    " UNION ALL ".join(f"SELECT '{k}' AS key, round(CAST({k} AS DOUBLE), 6) AS value FROM summ2" for k in _KV)


# --------------------------------------------------------------------------
# quality report, monitoring
# --------------------------------------------------------------------------
def _check(table, src, constraint, columns, violations, rows="count(*)"):
    return (f"SELECT '{table}' AS table_name, '{constraint}' AS \"constraint\", '{columns}' AS columns, CAST({rows} AS BIGINT) AS n_rows, "
            f"CAST({violations} AS BIGINT) AS violations FROM {src}")


def _key(table, src, columns):
    return _check(table, src, "primary_key", columns, f"count(*) - count(DISTINCT ({columns}))" if "," in columns
                  else f"count(*) - count(DISTINCT {columns})")


def _nulls(table, src, constraint, columns):
    cond = " OR ".join(f"{c} IS NULL" for c in columns.split(","))
    return _check(table, src, constraint, columns, f"count(*) FILTER (WHERE {cond})")


def _ascii(table, src, c):
    return _check(table, src, "ascii", c, f"count(*) FILTER (WHERE regexp_matches({c}, '[^\\x00-\\x7F]'))")


def _fk(table, src, c, parent, psrc, pc):
    return _check(table, f"(SELECT {c} AS k FROM {src} WHERE {c} IS NOT NULL) x LEFT JOIN (SELECT DISTINCT {pc} AS pk FROM {psrc}) y ON x.k = y.pk",
                  f"foreign_key:{parent}", c, "count(DISTINCT k) FILTER (WHERE pk IS NULL)")


_UNKNOWN = ("SELECT '{t}', '{k}', '{c}', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)")
_QUALITY = [
    _key("balances", "bal", "customer_id,product,row_key"), _key("balances", "bal", "customer_id,product,obs_date"),
    _UNKNOWN.format(t="balances", k="primary_key", c="customer_id,product,valuation_date"),
    _nulls("balances", "bal", "not_null", "obs_date"), _nulls("balances", "bal", "not_null", "balance"), _ascii("balances", "bal", "product"),
    _fk("balances", "bal", "customer_id", "customers", "cust_raw", "customer_id"),
    _key("customers", "cust_raw", "customer_id"), _nulls("customers", "cust_raw", "pk_not_null", "customer_id"),
    *[_nulls("customers", "cust_raw", "not_null", c) for c in ("gender", "segment", "housing", "income", "assets")], _ascii("customers", "cust_raw", "name"),
    _key("income_estimates", "est", "customer_id"), _fk("income_estimates", "est", "customer_id", "customers", "cust_raw", "customer_id"),
    _key("customer_features", "feat", "customer_id"), _fk("customer_features", "feat", "customer_id", "customers", "cust_raw", "customer_id"),
    _UNKNOWN.format(t="exchange_rates", k="primary_key", c="currency"),
    _key("dim_product", "dim_product", "product_id"), _nulls("dim_product", "dim_product", "pk_not_null", "product_id"),
    _key("dim_time", "dim_time", "date_id"), _nulls("dim_time", "dim_time", "pk_not_null", "date_id"),
    _key("fact_monthly", "fact", "customer_id,product_id,date_id"), _nulls("fact_monthly", "fact", "pk_not_null", "customer_id,product_id,date_id"),
    _nulls("fact_monthly", "fact", "not_null", "month"),
    _fk("fact_monthly", "fact", "product_id", "dim_product", "dim_product", "product_id"),
    _fk("fact_monthly", "fact", "date_id", "dim_time", "dim_time", "date_id"),
]
SQL["quality_report"] = feat_with(STAR) + "SELECT *, CASE WHEN violations IS NULL THEN 'NOT VERIFIED' WHEN violations = 0 THEN 'OK' ELSE 'FAIL' END AS status FROM (\n" + \
    "\nUNION ALL ".join(_QUALITY) + ") q"


def _inputs_at(i, cut_expr):
    """Product features as of a cut, pivoted to the model variables of a customer."""
    products = [p for p in S.product_slugs if p not in S.label_products]
    cols = []
    for p in products:
        cols += [f"coalesce(max(CASE WHEN product = '{p}' THEN balance_snapshot END), 0.0) AS {p}_balance_snapshot"]
        cols += [f"CASE WHEN count(*) FILTER (WHERE product = '{p}') = 0 THEN 0.0 ELSE max(CASE WHEN product = '{p}' THEN {c} END) END AS {p}_{c}"
                 for c in ("balance_mean_6m", "trend_6m")]
        cols += [f"CAST(coalesce(max(CASE WHEN product = '{p}' THEN n_obs_window END), 0) AS DOUBLE) AS {p}_n_obs_window"]
    liquid = " + ".join(f"coalesce(max(CASE WHEN product = '{p}' THEN balance_snapshot END), 0.0)" for p in S.liquid_products)
    label = " OR ".join(f"coalesce(max(CASE WHEN product = '{p}' THEN balance_snapshot END) > 0, false)" for p in S.label_products)
    return f"""mc{i} AS (SELECT c AS cut_date, CAST(c - INTERVAL 6 MONTH AS DATE) AS win_start, CAST(c - INTERVAL 3 MONTH AS DATE) AS mid
         FROM (SELECT CAST({cut_expr} AS DATE) AS c FROM cut) q),
ms{i} AS (SELECT customer_id, product,
         arg_max(balance, {{'d': obs_date, 'k': row_key}}) FILTER (WHERE balance IS NOT NULL) AS balance_snapshot,
         avg(balance) FILTER (WHERE obs_date >= win_start) AS balance_mean_6m,
         count(balance) FILTER (WHERE obs_date >= win_start) AS n_obs_window,
         avg(balance) FILTER (WHERE obs_date >= mid) - avg(balance) FILTER (WHERE obs_date >= win_start AND obs_date < mid) AS trend_6m
       FROM bal, mc{i} WHERE obs_date <= cut_date GROUP BY customer_id, product),
mi{i} AS (SELECT {i} AS y, {", ".join(cols)}, {liquid} AS liquid_balance_total, CAST({label} AS INTEGER) AS label
       FROM ms{i} GROUP BY customer_id)"""


_MON_VARS = [f"{p}_{c}" for p in S.product_slugs if p not in S.label_products
             for c in ("balance_snapshot", "balance_mean_6m", "trend_6m", "n_obs_window")] + ["liquid_balance_total"]
MONITOR = _inputs_at(0, "cut_date - INTERVAL 12 MONTH") + ",\n" + _inputs_at(1, "cut_date") + f""",
mi AS (SELECT * FROM mi0 UNION ALL SELECT * FROM mi1),
ml AS ({" UNION ALL ".join(f"SELECT '{c}' AS variable, y, {c} AS v FROM mi WHERE {c} IS NOT NULL" for c in _MON_VARS)}),
mq AS (SELECT variable, list_sort(list_distinct(quantile_cont(v, {DEC}))) AS e FROM ml WHERE y = 0 GROUP BY variable),
mb AS (SELECT variable, len(list_filter(e[2:len(e) - 1], lambda x: x < v)) AS bin, count(*) FILTER (WHERE y = 0) AS nb, count(*) FILTER (WHERE y = 1) AS nc
       FROM ml JOIN mq USING (variable) GROUP BY 1, 2),
mp AS (SELECT variable, (nc + 0.5) / (sum(nc) OVER w + 0.5 * count(*) OVER w) AS p, (nb + 0.5) / (sum(nb) OVER w + 0.5 * count(*) OVER w) AS q
       FROM mb WINDOW w AS (PARTITION BY variable)),
mr AS (SELECT y, label, (2 * rank() OVER (PARTITION BY y ORDER BY liquid_balance_total) + count(*) OVER (PARTITION BY y, liquid_balance_total) - 1) / 2.0 AS r
       FROM mi),
ma AS (SELECT y, CASE WHEN sum(label) > 0 AND count(*) - sum(label) > 0
                 THEN (sum(r * label) - sum(label) * (sum(label) + 1) / 2.0) / (sum(label) * (count(*) - sum(label))) END AS auc FROM mr GROUP BY y),
mauc AS (SELECT max(CASE WHEN y = 0 THEN auc END) AS base, max(CASE WHEN y = 1 THEN auc END) AS now FROM ma),
mape AS (SELECT component, quantile_cont(CASE WHEN abs(real) > 1.0 THEN abs((real - pred) / abs(real)) END, 0.5) AS v FROM bt
         WHERE real IS NOT NULL AND pred IS NOT NULL GROUP BY component),
msrc AS (SELECT source, max(obs_date) AS last FROM bal GROUP BY source),
mon AS (SELECT 'psi' AS indicator, variable, sum((p - q) * ln(p / q)) AS value, 0.25 AS threshold, true AS above FROM mp GROUP BY variable
  UNION ALL SELECT 'auc_drop', 'liquid_balance_total', base - now, 0.05, true FROM mauc
  UNION ALL SELECT 'auc_ceiling', 'liquid_balance_total', now, {S.auc_leak_ceiling}, true FROM mauc
  UNION ALL SELECT 'impact_ratio', attribute, impact_ratio, {S.disparate_impact_min}, false FROM di2
  UNION ALL SELECT 'proxy_auc', 'gender', auc, {S.auc_proxy_substantial}, true FROM prx
  UNION ALL SELECT 'backtest_ape_median', component, v, 0.10, true FROM mape
  UNION ALL SELECT 'source_age_days', source, CAST((SELECT max(last) FROM msrc) - last AS DOUBLE), 31.0, true FROM msrc)"""
SQL["monitoring"] = fact_with(SEL, _auc_sql("CAST(gender = 'F' AS INTEGER)", "prx", "gender IS NOT NULL"), MONITOR) + """
SELECT indicator, variable, round(value, 6) AS value, round(CAST(threshold AS DOUBLE), 6) AS threshold,
       CASE WHEN value IS NULL THEN 'NOT VERIFIED' WHEN (above AND value > threshold) OR (NOT above AND value < threshold) THEN 'ALERT' ELSE 'OK' END AS status
FROM mon"""
