"""Column-level business rules (classification, rounding, guarded ratios)."""

from riskloom.functions import rules

__all__ = ["rules"]
