"""Column-level functions (JVM-side expressions only; no Python UDFs)."""

from snapflow.functions.scalars import (
    any_not_null, delta, greatest_strict, growth_pct, retain_days, safe_ratio, tier,
    trend_indicator, with_audit,
)
from snapflow.functions.jsonpaths import coalesce_key, extract, fill_zero, to_variant

__all__ = [
    "any_not_null", "delta", "greatest_strict", "growth_pct", "retain_days", "safe_ratio", "tier",
    "trend_indicator", "with_audit", "coalesce_key", "extract", "fill_zero", "to_variant",
]
