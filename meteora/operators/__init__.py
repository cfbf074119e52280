"""Relational operators of the observation transform."""

from meteora.operators.aggregate import first_flags, to_daily, to_wide, to_yearly
from meteora.operators.cleaning import clean, drop_flagged, normalize_flags
from meteora.operators.join import checked_broadcast, fits_broadcast
from meteora.operators.limit import sample_rows, top_k
from meteora.operators.pivot import explode_elements, pivot_native
from meteora.operators.setops import union_all
from meteora.operators.window import keep_first, partition_avg, row_number_first, window_avg, window_dedup

__all__ = [
    "first_flags", "to_daily", "to_wide", "to_yearly", "clean", "drop_flagged", "normalize_flags",
    "checked_broadcast", "fits_broadcast", "sample_rows", "top_k", "explode_elements",
    "pivot_native", "union_all", "keep_first", "partition_avg", "row_number_first", "window_avg", "window_dedup",
]
