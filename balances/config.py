"""Domain constants.

Fixed values that must equal the reference's for results to agree are stated
plainly here, together, in natural order.
"""
from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    # --- fixed values (thresholds and windows of the reference) ---
    iv_min: float = 0.02                 # IV below this: discard
    auc_leak_ceiling: float = 0.95       # AUC above this: leak suspected
    auc_pattern_weak: float = 0.60       # missing-pattern AUC bands
    auc_pattern_informative: float = 0.70
    auc_proxy_moderate: float = 0.60     # gender-proxy AUC bands
    auc_proxy_substantial: float = 0.70
    lift_incomplete_profile: float = 1.5  # conditional lift for one profile flag
    vif_alert: float = 10.0
    disparate_impact_min: float = 0.80   # the 80 % rule
    backtest_months: int = 3
    cv_min_observed_months: int = 3
    recent_label_days: int = 90
    window_months: int = 6
    seed: int = 42
    test_fraction: float = 0.2
    capture_rates: tuple = (("conservative", 0.10), ("base", 0.25), ("optimistic", 0.40))
    iv_cuts: tuple = ((0.02, "discard"), (0.10, "weak"), (0.30, "medium"))  # else "strong"
    woe_eps: float = 0.5                 # Haldane-Anscombe correction
    n_bins: int = 10
    missing_label: str = "Sin dato"
    level_labels: tuple = ("D", "C", "B", "A")  # ascending quartiles of the rank
    evidence_neutral_woe: float = 0.10
    flat_std_threshold: float = 1.0      # commercial block: std below => no signal
    # --- adapter parameters (driver tables -> this domain) ---
    balance_center: float = 250000.0     # balance = o_totalprice - center
    products: tuple = field(default_factory=lambda: (
        ("1-URGENT", "savings"),
        ("2-HIGH", "checking"),
        ("3-MEDIUM", "term_deposit"),
        ("4-NOT SPECIFIED", "trust_fund"),
        ("5-LOW", "robo_advisor"),
    ))
    liquid_products: tuple = ("savings", "checking")
    invest_non_label_products: tuple = ("term_deposit", "trust_fund")
    label_products: tuple = ("robo_advisor",)
    financial_cols: tuple = ("income", "expenses", "assets", "liabilities", "equity")

    @property
    def product_slugs(self) -> list[str]:
        return [slug for _, slug in self.products]

    @property
    def non_label_products(self) -> list[str]:
        return [p for p in self.product_slugs if p not in self.label_products]


SETTINGS = Settings()
