from oddlens.functions.columns import (
    bucket_of_rank,
    clean_number,
    edge_bin,
    is_bad,
    is_numeric,
    month_digits,
    normalize_missing,
    numeric_columns,
    parse_date,
    ratio,
    round_doubles,
    share_gap,
)
from oddlens.functions.ranking import global_row_number, prefix_sums

__all__ = [
    "bucket_of_rank",
    "clean_number",
    "edge_bin",
    "global_row_number",
    "is_bad",
    "is_numeric",
    "month_digits",
    "normalize_missing",
    "numeric_columns",
    "parse_date",
    "prefix_sums",
    "ratio",
    "round_doubles",
    "share_gap",
]
