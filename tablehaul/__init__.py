"""Table exports, their checks and retention deletes as plain Spark jobs."""

from tablehaul.specs import DeleteSpec, ExportSpec, delete_specs, export_specs

__all__ = ["DeleteSpec", "ExportSpec", "delete_specs", "export_specs"]
