"""Column-expression helpers (JVM-side, codegen-friendly)."""

from panelcast.functions.columns import (
    add_periods,
    fmt_fixed,
    is_finite,
    normal_cdf,
    normal_two_sided_p,
    period_of,
    significance_stars,
    step_interval,
)

__all__ = [
    "add_periods",
    "fmt_fixed",
    "is_finite",
    "normal_cdf",
    "normal_two_sided_p",
    "period_of",
    "significance_stars",
    "step_interval",
]
