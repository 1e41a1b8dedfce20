"""Data tests and freshness."""

from appkpi.quality.checks import (
    Check,
    accepted_range,
    accepted_values,
    is_true,
    not_null,
    quality_report,
    raise_on_errors,
    unique,
)
from appkpi.quality.freshness import Freshness, freshness_report

__all__ = [
    "Check",
    "Freshness",
    "accepted_range",
    "accepted_values",
    "freshness_report",
    "is_true",
    "not_null",
    "quality_report",
    "raise_on_errors",
    "unique",
]
