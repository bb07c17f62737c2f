"""Column expressions: missing-value rules, safe ratios and row-wise statistics."""

from cohortforge.functions.semantics import (
    ratio, psum, nan_to_null, replace_inf, clip_positive, sentinel_to_null, as_text,
    NO_DATE_SENTINEL,
)
from cohortforge.functions.rowwise import (
    row_mean, row_std, row_sum, row_kurtosis, with_row_kurtosis, with_row_std,
)

__all__ = [
    "ratio", "psum", "nan_to_null", "replace_inf", "clip_positive", "sentinel_to_null",
    "as_text", "NO_DATE_SENTINEL", "row_mean", "row_std", "row_sum", "row_kurtosis",
    "with_row_kurtosis", "with_row_std",
]
