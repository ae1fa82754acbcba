"""Writing tables, and where their files go."""

from tablehaul.sinks.layout import (
    marker_uri,
    s3a_settings,
    target_uri,
    trigger_uri,
    write_marker,
    write_trigger,
)
from tablehaul.sinks.writers import (
    FORMATS,
    ParquetOptions,
    read_written,
    write_table,
    written_row_count,
)

__all__ = [
    "FORMATS",
    "ParquetOptions",
    "marker_uri",
    "read_written",
    "s3a_settings",
    "target_uri",
    "trigger_uri",
    "write_marker",
    "write_table",
    "write_trigger",
    "written_row_count",
]
