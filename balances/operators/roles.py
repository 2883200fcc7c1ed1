"""One source of truth for what a column may be used for (M1, M2, DQ8, F18).

Every list of predictors, the leak guard and the column dictionary read the
lists below, so a column added to one table cannot slip into a model because a
second list was forgotten.
"""
from __future__ import annotations

from balances.config import SETTINGS as S

# --- fixed values: what each column of the gold and score tables is ---
IDS = ("customer_id", "name")
LABELS = ("adoption_label", "adoption_label_recent")
#: Contain the label without saying so: they count the label's products too.
LABEL_AGGREGATES = ("n_products_total", "has_investment_history")
LABEL_PREFIXES = tuple(f"{p}_" for p in S.label_products)
#: Describe the population a customer falls into, not the customer.
POPULATION_FLAGS = ("has_product_history", "no_signal", "trainable", "population", "no_recent_data")
#: Written by the scoring and amount steps; inputs of no model.
OUTPUTS = ("score", "model_used", "reference_value", "reference_type", "level", "pct_rank",
           "annual_savings_capacity", "expected_value_12m")
OUTPUT_PREFIXES = ("amount_",)
PROTECTED = ("gender",)
INTERMEDIATE_SUFFIXES = ("_snapshot_date",)
INTERMEDIATE = ("first_month",)

#: Say that another column is missing (or not): constant wherever that column is known, so no VIF.
MISSING_FLAGS = ("missing_estimator", "has_income_estimate", "no_financial_any", "no_financial_all", "missing_financial",
                 "no_recent_data", "missing_housing", "has_housing_data", "liquid_cv_insufficient", "incomplete_profile")

#: Financial capacity: all that model B may read, in this order.
SET_B = (*S.financial_cols, "savings_capacity", "income_estimate", "has_income_estimate", "missing_estimator",
         "expense_income_ratio", "savings_income_pct", "liability_asset_ratio", "equity_per_income",
         "income_gap", "income_gap_pct", "no_financial_any", "age_group", "housing", "has_housing_data",
         "incomplete_profile", "segment")


def role(column: str) -> str:
    """id, leak, flag, output, excluded, intermediate, A+B or A."""
    if column in IDS:
        return "id"
    if column in LABELS or column in LABEL_AGGREGATES or column.startswith(LABEL_PREFIXES):
        return "leak"
    if column in POPULATION_FLAGS:
        return "flag"
    if column in OUTPUTS or column.startswith(OUTPUT_PREFIXES):
        return "output"
    if column in PROTECTED:
        return "excluded"
    if column in INTERMEDIATE or column.endswith(INTERMEDIATE_SUFFIXES):
        return "intermediate"
    return "A+B" if column in SET_B else "A"


def model_a(columns) -> list[str]:
    return leak_check([c for c in columns if role(c) in ("A", "A+B")])


def model_b(columns) -> list[str]:
    present = set(columns)
    return leak_check([c for c in SET_B if c in present])


def leak_check(columns) -> list[str]:
    """DQ8: refuse a feature list that holds anything but predictors."""
    bad = [c for c in columns if role(c) not in ("A", "A+B")]
    if bad:
        raise ValueError(f"leak suspected, forbidden feature columns: {bad}")
    return list(columns)
