"""Parameters of the revival rules, kept in one frozen object.

Operators never hard-code thresholds, windows, cut-off dates or status
names; they read them from a :class:`RevivalConfig`.  Two presets match the
two order adapters in :mod:`rekindle.sources.adapters`.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class RevivalConfig:
    # --- status vocabulary (order header / line StatusDef) -------------------
    status_fail: str = "Fail"
    status_finish: str = "Finish"
    status_return: str = "Return"

    # --- R4/R5: personal cycle and dormancy threshold -------------------------
    fallback_ci: int = 67          # cycle used for a member's first gap
    k: float = 3.0                 # threshold = clip(k * cycle, clip_lo, clip_hi)
    clip_lo: int = 30
    clip_hi: int = 365

    # --- R7: label window (timestamp exact, (t0_ts, t0_ts + window]) ---------
    window_days: int = 120

    # --- R8/R9: censoring and calendar split ---------------------------------
    censor_cutoff: dt.date | None = None     # keep t0_date <= cutoff
    train_end: dt.date | None = None         # train: t0_date <= train_end
    embargo_days: int = 120                  # test: t0_date >= train_end + embargo

    # --- feature rules ---------------------------------------------------------
    promo_months: tuple[int, ...] = (5, 11)
    recent_days: tuple[int, ...] = (90, 180, 365)
    pre_dormancy_days: int = 90
    sealed_days: int = 365
    null_coupon_is_used: bool = True   # T2: NaN != 0 counts as "used coupon"
    null_safe_pages: bool = False      # T4: NULL page equals NULL page
    age_bounds: tuple[float, float] = (10.0, 100.0)
    min_days_since_register: int = 0

    # --- funnel gates (A20) ----------------------------------------------------
    label_rate_bounds: tuple[float, float] = (0.60, 0.80)
    max_split_rate_gap: float = 0.10

    # --- scoring (M-operators) -------------------------------------------------
    threshold: float = 0.5
    mid_lo: float = 0.4
    mid_hi: float = 0.6
    seed: int = 42
    snapshot_cols: tuple[str, ...] = ("member_card_level", "is_app_installed",
                                      "marketing_optin_count")

    extra: dict = field(default_factory=dict)

    @property
    def test_start(self) -> dt.date | None:
        if self.train_end is None:
            return None
        return self.train_end + dt.timedelta(days=self.embargo_days)

    def with_(self, **kw) -> "RevivalConfig":
        return replace(self, **kw)


# Fixed parameter values of the original study (shop data, 2022-2024).
REFERENCE = RevivalConfig(
    fallback_ci=67, k=3.0, clip_lo=30, clip_hi=365, window_days=120,
    censor_cutoff=dt.date(2023, 11, 1), train_end=dt.date(2023, 3, 31),
    embargo_days=120,
)

# Adapter A (TPC-H style orders, 1995-01-01 .. 2001-08-01, dates only).
ADAPTER_A = RevivalConfig(
    fallback_ci=67, k=3.0, clip_lo=30, clip_hi=365, window_days=120,
    censor_cutoff=dt.date(2001, 8, 1) - dt.timedelta(days=120),
    train_end=dt.date(1999, 12, 31), embargo_days=120,
)

# Adapter B (30 days of exact-timestamp events).
ADAPTER_B = RevivalConfig(
    fallback_ci=1, k=2.0, clip_lo=2, clip_hi=10, window_days=2,
)
