"""Scalar column functions."""

from tablehaul.functions.dates import days_back, start_of_day_ms, text_date
from tablehaul.functions.text import binary_to_text, cell_text, file_stem, strip_quotes, table_path
from tablehaul.functions.units import bytes_to_mb, ms_to_min

__all__ = [
    "binary_to_text",
    "bytes_to_mb",
    "cell_text",
    "days_back",
    "file_stem",
    "ms_to_min",
    "start_of_day_ms",
    "strip_quotes",
    "table_path",
    "text_date",
]
