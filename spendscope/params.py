"""Thresholds and definition choices shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Literal

# The default thresholds of the five criteria.
DEFAULT_DAILY_RATE = 120.0
DEFAULT_AMOUNT_QUANTILE = 0.95
DEFAULT_DISTANCE_KM = 150.0
DEFAULT_CATEGORIES = 10
DEFAULT_GAP_SECONDS = 600
DEFAULT_SHORT_GAPS = 5


@dataclass(frozen=True)
class Params:
    """One immutable set of definitions; every operator takes it explicitly.

    ``amount_decimals`` states how many decimals the amounts carry. When set, sums, averages
    and deviations, those of distances too, are computed from exact sums, so not a bit of them
    depends on the order of addition, and a NaN amount raises. When ``None`` amounts are summed as plain doubles, whose last digits
    may differ from one evaluation to the next; keep the profiles, as ``analyse`` does,
    before comparing averages with a threshold taken from them.

    ``distinct="sketch"`` estimates distinct users per category and hour, and
    ``amount_method="sketch"`` the quantile of the amounts, both within the errors that
    ``operators.sketches`` states. They are for inputs where the exact ways cost too much.
    """

    daily_rate: float = DEFAULT_DAILY_RATE
    amount_quantile: float = DEFAULT_AMOUNT_QUANTILE
    amount_method: Literal["rank", "interpolated", "sketch"] = "rank"
    amount_population: Literal["users", "transactions"] = "users"
    distance_km: float = DEFAULT_DISTANCE_KM
    categories: int = DEFAULT_CATEGORIES
    gap_seconds: int = DEFAULT_GAP_SECONDS
    short_gaps: int = DEFAULT_SHORT_GAPS
    gap: Literal["seconds", "exact"] = "seconds"
    burst: Literal["gaps", "window"] = "gaps"
    window_transactions: int = DEFAULT_SHORT_GAPS
    span: Literal["days", "exact"] = "days"
    null_bin: bool = False
    distinct: Literal["exact", "sketch"] = "exact"
    amount_decimals: int | None = None

    def __post_init__(self) -> None:
        if not 0.0 <= self.amount_quantile <= 1.0:
            raise ValueError("amount_quantile must lie in [0, 1]")
        if self.gap_seconds <= 0:
            raise ValueError("gap_seconds must be positive")
        if self.short_gaps < 1 or self.window_transactions < 1:
            raise ValueError("burst counts must be at least 1")
        choices = {
            "amount_method": ("rank", "interpolated", "sketch"),
            "amount_population": ("users", "transactions"),
            "gap": ("seconds", "exact"),
            "burst": ("gaps", "window"),
            "span": ("days", "exact"),
            "distinct": ("exact", "sketch"),
        }
        for name, allowed in choices.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}")
