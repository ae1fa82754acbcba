"""DataFrame-to-DataFrame operators."""

from tablehaul.operators.lines import json_lines, pipe_lines, trigger_line
from tablehaul.operators.predicates import all_of, any_of, keep_predicate, predicate
from tablehaul.operators.project import nested_to_json, project, rename, stringify
from tablehaul.operators.retention import older_than, retain
from tablehaul.operators.validate import (
    check_columns,
    null_cell_counts,
    null_cell_rows,
    reconcile,
)

__all__ = [
    "all_of",
    "any_of",
    "check_columns",
    "json_lines",
    "keep_predicate",
    "nested_to_json",
    "null_cell_counts",
    "null_cell_rows",
    "older_than",
    "pipe_lines",
    "predicate",
    "project",
    "reconcile",
    "rename",
    "retain",
    "stringify",
    "trigger_line",
]
