from spendscope.functions.expressions import (
    DISTANCE_DECIMALS,
    MICROS,
    amount_bin,
    day_of_week,
    epoch_micros,
    epoch_seconds,
    exact_amount,
    exact_deviation,
    exact_mean,
    exact_span_days,
    guarded_rate,
    is_local,
    is_weekend,
    mean,
    percent,
    planar_km,
    ratio,
    total,
    units,
    whole_span_days,
)

__all__ = [
    "DISTANCE_DECIMALS",
    "MICROS",
    "amount_bin",
    "day_of_week",
    "epoch_micros",
    "epoch_seconds",
    "exact_amount",
    "exact_deviation",
    "exact_mean",
    "exact_span_days",
    "guarded_rate",
    "is_local",
    "is_weekend",
    "mean",
    "percent",
    "planar_km",
    "ratio",
    "total",
    "units",
    "whole_span_days",
]
