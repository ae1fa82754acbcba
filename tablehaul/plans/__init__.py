"""Whole jobs: exports, reports and retention deletes."""

from tablehaul.plans.delete import delete_from, delete_many, finish_delete
from tablehaul.plans.export import export_frame, export_tables, exported_files, null_rows
from tablehaul.plans.report import delete_counts, export_details, export_summary, sent_count_sum

__all__ = [
    "delete_counts",
    "delete_from",
    "delete_many",
    "export_details",
    "export_frame",
    "export_summary",
    "export_tables",
    "exported_files",
    "finish_delete",
    "null_rows",
    "sent_count_sum",
]
