"""Fixed values of the close, stated once.

The literals below have to equal the bank's own (segment spellings, reason
names, day limits), otherwise results differ.
"""

from __future__ import annotations

from dataclasses import dataclass

OBSERVED = "observed"  # what the nightly jobs really leave in the tables
INTENDED = "intended"  # what the rules evidently meant to do

# --- fixed values: segment spellings -------------------------------------
RETAIL = "RETAIL"
NONRETAIL = "NONRETAIL"
RETAIL_MIXED_CASE = "Retail"
NONRETAIL_HYPHEN = "NON-RETAIL"
PRIVATE_INDIVIDUAL = "PI"

# --- fixed values: product and account codes ------------------------------
CARD_GROUP = "CC"
CARD_PRODUCT_GROUP = "CREDIT CARD"
EXCLUDED_ACCOUNT = "1914000000"

# --- fixed values: reasons that lead to customer-level probation ----------
CUSTOMER_REASONS_OBSERVED = ("BANKRUPTACY", "DECEASED", "LOSS OF SUFFICIENT INCOME", "INDEBTEDNESS")
CUSTOMER_REASONS_INTENDED = ("BANKCRUPTCY", "DECEASED", "LOSS OF SUFFICIENT INCOME", "INDEBTEDNESS")

# --- fixed values: reasons that lead to deal-level probation --------------
DEAL_REASONS = (
    "DPD",
    "DEBT SALE",
    "FORECLOSURE COLLATERAL",
    "POCI",
    "CROSS",
    "CREDIT RISK ADJUSTMENT",
    "CONTRACT TERMINATION",
    "NON ACCRUED STATUS",
    "BREACH OF COVENANTS",
)

# --- fixed values: contagion reasons --------------------------------------
CONTAGION_REASON = "CROSS CONTAGION INDICATOR"
PULLING_REASON = "CROSS DEFAULT PULLING EFFECT"
PROBATION_PREFIX = "PRB "

# --- fixed values: write-off and recovery movement types ------------------
RECOVERY_MOVEMENTS = ("WA", "WO", "REP", "DS")


@dataclass(frozen=True)
class Limits:
    """Day limits and fallbacks of the close."""

    event_dpd: int = 90
    absorbing_dpd: int = 180
    exit_max_dpd: int = 60
    restart_dpd: int = 10
    distressed_dpd: int = 60
    probation_months: int = 3
    reset_months: int = 12
    pulling_share: float = 0.2


LIMITS = Limits()


def check_mode(mode: str) -> bool:
    """True for the observed results, False for the intended ones."""
    if mode not in (OBSERVED, INTENDED):
        raise ValueError(f"mode must be {OBSERVED!r} or {INTENDED!r}, not {mode!r}")
    return mode == OBSERVED
