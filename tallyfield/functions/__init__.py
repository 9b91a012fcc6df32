"""Column-to-column helpers, all native expressions."""

from tallyfield.functions.columns import (
    active_in,
    binary_label,
    blank_to_null,
    code_where,
    extra_size,
    great_circle_km,
    hash_uniform,
    haversine_km,
    is_blank,
    month_of,
    over_threshold,
    overlap_size,
    ratio,
    row_hash,
    row_id,
    row_key,
    strip_quotes,
    year_of,
)

__all__ = [
    "active_in",
    "binary_label",
    "blank_to_null",
    "code_where",
    "extra_size",
    "great_circle_km",
    "hash_uniform",
    "haversine_km",
    "is_blank",
    "month_of",
    "over_threshold",
    "overlap_size",
    "ratio",
    "row_hash",
    "row_id",
    "row_key",
    "strip_quotes",
    "year_of",
]
