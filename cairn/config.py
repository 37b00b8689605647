"""Parameters of the operators, as plain dataclasses (no settings loader)."""

from __future__ import annotations

from dataclasses import dataclass


# A matched sell with pnl >= +50 USD is a win, <= -50 USD a loss.
MEANINGFUL_PNL_USD = 50.0

# Trader score (P18) as (weight, value giving the full score):
# pnl 0.25 at 5000 USD, roi 0.25 at 200 %, win rate 0.20 at 100 %,
# volume 0.15 at 50000 USD, frequency 0.10 at 10 trades/day, sharpe 0.05 at 3.
SCORE_PNL = (0.25, 5000)
SCORE_ROI = (0.25, 200)
SCORE_WIN_RATE = (0.20, 100)
SCORE_VOLUME = (0.15, 50000)
SCORE_FREQUENCY = (0.10, 10)
SCORE_SHARPE = (0.05, 3)

# Coverage confidence: >= 85 High, >= 80 Good, >= 70 Acceptable, else Low.
COVERAGE_BANDS = ((85, "High"), (80, "Good"), (70, "Acceptable"))
COVERAGE_OTHER = "Low"

# Tier-score normalisers (roi 200 %, sharpe 3, pnl 20000 USD as "volume")
# and activity penalty (above 10 trades/day x 0.9, below 0.2 x 0.95).
TIER_ROI_FULL, TIER_SHARPE_FULL, TIER_PNL_FULL = 200, 3, 20000
PENALTY_HIGH_FREQ, PENALTY_HIGH = 10, 0.9
PENALTY_LOW_FREQ, PENALTY_LOW = 0.2, 0.95


@dataclass(frozen=True)
class PnlConfig:
    """Eligibility thresholds of a wallet PnL record (P17), applied to unrounded values."""
    min_meaningful_trades: int = 5
    min_coverage: float = 70.0
    min_win_rate: float = 60.0
    min_realized_pnl: float = 500.0   # strictly greater
    min_roi: float = 20.0
    min_trading_days: int = 2
    min_transactions: int = 2         # F11, pipeline YAML value
    method: str = "fifo"


# Accepted calculation-method labels.
FIFO_METHODS = ("fifo", "fifo_enhanced", "fifo_cost_basis_matched", "fifo_cost_basis_matched_min50")


@dataclass(frozen=True)
class TierCriteria:
    name: str
    coverage: float
    roi: float
    win_rate: float
    sharpe: float
    pnl: float
    trades: int
    freq_min: float
    freq_max: float
    drawdown: float


# Tier thresholds that must equal the reference's, in its order
# (coverage %, roi %, win rate %, sharpe, pnl USD, meaningful trades,
#  frequency range per day inclusive, max drawdown %).
TIERS = (
    TierCriteria("ELITE", 85, 50, 70, 1.5, 10000, 50, 0.5, 5, 20),
    TierCriteria("STRONG", 80, 25, 65, 1.0, 5000, 30, 0.3, 7, 25),
    TierCriteria("PROMISING", 75, 15, 60, 0.5, 2000, 20, 0.2, 10, 30),
    TierCriteria("QUALIFIED", 70, 5, 55, 0.2, 500, 10, 0.01, 15, 40),
    TierCriteria("EXPERIMENTAL", 60, 100, 75, 2.0, 1000, 15, 0.01, 20, 35),
)

# Tier-score weights (coverage, roi, sharpe, win rate, volume);
# every tier not listed uses DEFAULT_WEIGHTS.
TIER_WEIGHTS = {
    "ELITE": (0.20, 0.25, 0.25, 0.20, 0.10),
    "STRONG": (0.25, 0.25, 0.20, 0.20, 0.10),
    "PROMISING": (0.30, 0.20, 0.20, 0.20, 0.10),
}
DEFAULT_WEIGHTS = (0.35, 0.20, 0.20, 0.15, 0.10)

# Push-list priority of tiers (G14 sort: ELITE first).
TIER_PRIORITY = ("ELITE", "STRONG", "PROMISING", "QUALIFIED", "EXPERIMENTAL")


@dataclass(frozen=True)
class RankConfig:
    tiers: tuple = TIERS
    compat: bool = True            # G4: drawdown 0 counts as 100 (reference behaviour)
    auto_follow_coverage: float = 85.0
    auto_follow_days: int = 30
    verified_days: int = 30
    verified_trades: int = 20
    verified_coverage: float = 75.0


@dataclass(frozen=True)
class TokenScreen:
    """F1 bounds; None = no filter."""
    min_liquidity: float | None = 100_000
    max_liquidity: float | None = 200_000_000
    min_volume_1h: float | None = 50_000
    min_price_change_2h: float | None = 0
    min_price_change_24h: float | None = 20
    limit: int = 100
    offset: int = 0


@dataclass(frozen=True)
class TxFilter:
    """allowed lower-case types and minimum USD value of the base side."""
    include_types: tuple = ("swap", "transfer")
    min_value_usd: float = 100.0


@dataclass(frozen=True)
class HolderBand:
    """Skip the top pct of holders, then take the next ``take``."""
    skip_top_percentage: float = 10.0
    holders_per_token: int = 2000
    top_holders_limit: int = 100


@dataclass(frozen=True)
class RetryPolicy:
    max_attempts: int = 3
    base_seconds: int = 5
    multiplier: float = 2.0


