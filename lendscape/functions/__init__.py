"""Column expressions; all of them stay inside whole-stage code generation."""

from lendscape.functions.columns import (
    bracket,
    day_gap,
    keyed_mask,
    mask,
    percent,
    safe_ratio,
    sentinel_to_null,
    surrogate_key,
    unit_hash,
)

__all__ = [
    "bracket",
    "day_gap",
    "keyed_mask",
    "mask",
    "percent",
    "safe_ratio",
    "sentinel_to_null",
    "surrogate_key",
    "unit_hash",
]
