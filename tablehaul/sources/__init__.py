"""Reading tables and directories of Parquet files."""

from tablehaul.sources.scan import (
    file_row_counts,
    is_empty,
    key_columns,
    leaf_columns,
    listed_files,
    leaf_paths,
    row_count,
    scan_dir,
    scan_table,
    with_keys,
)

__all__ = [
    "file_row_counts",
    "is_empty",
    "key_columns",
    "leaf_columns",
    "listed_files",
    "leaf_paths",
    "row_count",
    "scan_dir",
    "scan_table",
    "with_keys",
]
