"""Column and table names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bookkeeping columns a source table carries.
UPDATE_TIME = "_UPT_"
SYSTEM_COLUMNS = ("_DELETED_", "_INST_", "_INSUN_", "_UPT_", "_UPUN_")
# Dumped Parquet directories carry the row key as well.
DUMP_SYSTEM_COLUMNS = SYSTEM_COLUMNS + ("_PK_",)


def col(name: str) -> Column:
    """A top-level column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def split_names(names: str | list[str] | tuple[str, ...] | None) -> list[str]:
    """``"a, b"`` or a list -> trimmed names without blanks."""
    if names is None:
        return []
    if isinstance(names, str):
        names = names.split(",")
    return [n.strip() for n in names if n.strip()]


def clean_table_path(table: str) -> str:
    return table.strip().strip("/")


def table_stem(table: str) -> str:
    return clean_table_path(table).replace("/", "_")
