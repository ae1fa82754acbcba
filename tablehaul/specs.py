"""What to export and what to delete, one spec per table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tablehaul.names import DUMP_SYSTEM_COLUMNS, SYSTEM_COLUMNS
from tablehaul.operators.predicates import Pred, matches_all
from tablehaul.operators.retention import older_than
from tablehaul.sinks.layout import target_uri
from tablehaul.sinks.writers import ParquetOptions, format_name


@dataclass(frozen=True)
class ExportSpec:
    """One table's export.

    ``source`` is a Parquet path or a DataFrame; with ``file_suffix`` it is a directory of
    dumped files. ``system_columns`` are those ``skip_system`` drops, unset the usual ones and for
    dumped files the row key too. ``values`` is ``text``, ``binary`` (UTF-8 bytes) or ``typed``.
    ``null_cells`` is ``ignore``, ``warn`` or ``fail``; unset it warns for Parquet and Avro.
    ``convert=False`` only counts the source. ``schema`` names the source's columns and saves the
    look at every footer.
    """

    table: str
    source: str | DataFrame
    root: str = ""
    format: str = "parquet"
    env: str | None = None
    delta_date: str | None = None
    file_suffix: str | None = None
    convert: bool = True
    columns: str | list[str] | None = None
    declared_columns: tuple[str, ...] = ()
    skip: str | list[str] = ""
    skip_system: bool = True
    system_columns: tuple[str, ...] | None = None
    rename: str | Mapping[str, str] | None = None
    where: Pred = None
    as_text: bool = False
    days_back: tuple[str, int] | None = None
    today: date | None = None
    tz: str = "UTC"
    keys: str | list[str] = ""
    values: str = "text"
    null_text: str | None = None
    null_cells: str | None = None
    expected_rows: int | None = None
    parquet: ParquetOptions = field(default_factory=ParquetOptions)
    max_rows: int | None = None
    n_files: int | None = None
    marker: bool = False
    stamp: str | None = None
    trigger_prefix: str | None = None
    name_prefix: str = ""
    name_stamp: str = ""
    schema: StructType | None = None

    def __post_init__(self):
        format_name(self.format)
        if self.system_columns is None:
            names = SYSTEM_COLUMNS if self.file_suffix is None else DUMP_SYSTEM_COLUMNS
            object.__setattr__(self, "system_columns", names)
        if self.values not in ("text", "binary", "typed"):
            raise ValueError(f"values must be text, binary or typed: {self.values!r}")
        if self.null_cells not in (None, "ignore", "warn", "fail"):
            raise ValueError(f"null_cells must be ignore, warn or fail: {self.null_cells!r}")
        if self.values == "typed" and self.null_text is not None:
            raise ValueError("null_text needs text or binary values")
        if "\n" in (self.null_text or ""):
            raise ValueError("null_text must be one line")
        if self.days_back and self.today is None:
            raise ValueError("days_back needs today")
        if self.convert and not self.root:
            raise ValueError(f"no target root for {self.table}")

    @property
    def target(self) -> str:
        return target_uri(
            self.root, self.table, self.env, self.delta_date, self.name_prefix, self.name_stamp
        )

    @property
    def null_policy(self) -> str:
        if self.null_cells is not None:
            return self.null_cells
        return "warn" if format_name(self.format) in ("parquet", "avro") else "ignore"


@dataclass(frozen=True)
class DeleteSpec:
    """One table's retention delete. ``delete_days`` takes the place of ``where``; with neither,
    or with a match-all ``where``, every row goes. ``schema`` names all of the table's columns."""

    table: str
    path: str
    where: Pred = None
    delete_days: int | None = None
    now: datetime | None = None
    real_delete: bool = True
    schema: StructType | None = None

    def __post_init__(self):
        if self.delete_days is not None and self.now is None:
            raise ValueError("delete_days needs now")

    @property
    def pred(self) -> Pred:
        if self.delete_days is not None:
            return older_than(self.delete_days, self.now)
        return None if matches_all(self.where) else self.where


def broadcast_option(name: str, value, n: int) -> list:
    """One value per table from a ``;`` text or a list; a single value serves all tables."""
    values = value.split(";") if isinstance(value, str) else value
    if not isinstance(values, list):
        values = [values]
    if len(values) == 1:
        return values * n
    if len(values) != n:
        raise ValueError(f"{name} has {len(values)} values for {n} tables")
    return values


def table_list(tables: str | Iterable[str]) -> list[str]:
    names = tables.split(";") if isinstance(tables, str) else list(tables)
    return [t.strip() for t in names if t.strip()]


def days_back_option(text: str | tuple[str, int] | None) -> tuple[str, int] | None:
    """``"column:days"`` -> ``("column", days)``; blank means no criterion."""
    if not text or isinstance(text, tuple):
        return text or None
    if not text.strip():
        return None
    column, sep, days = text.strip().rpartition(":")
    if not sep or not column.strip():
        raise ValueError(f"not a column:days pair: {text!r}")
    return column.strip(), int(days)


def export_specs(
    tables: str | Iterable[str],
    locate: Callable[[str], str | DataFrame],
    root: str,
    *,
    where: Pred | list = None,
    columns: str | list = "",
    skip: str | list = "",
    rename: str | list = "",
    days_back: str | list = "",
    keys: str | list = "",
    expected_rows: int | list | None = None,
    **common,
) -> list[ExportSpec]:
    """Specs for several tables from per-table option lists.

    ``columns``, ``skip``, ``rename``, ``days_back`` and ``keys`` are ``;`` texts or lists,
    ``where`` and ``expected_rows`` are lists or one value for all. ``locate`` maps a table
    name to its source. The other options are the same for every table.
    """
    names = table_list(tables)
    per_table = {
        "where": where,
        "columns": columns,
        "skip": skip,
        "rename": rename,
        "days_back": days_back,
        "keys": keys,
        "expected_rows": expected_rows,
    }
    lists = {k: broadcast_option(k, v, len(names)) for k, v in per_table.items()}
    lists["days_back"] = [days_back_option(d) for d in lists["days_back"]]
    return [
        ExportSpec(
            table=t,
            source=locate(t),
            root=root,
            **{k: values[i] for k, values in lists.items()},
            **common,
        )
        for i, t in enumerate(names)
    ]


def delete_specs(
    tables: str | Iterable[str],
    locate: Callable[[str], str],
    *,
    where: list | None = None,
    delete_days: str | list = "",
    now: datetime | None = None,
    real_delete: bool = True,
) -> list[DeleteSpec]:
    """Delete specs; the lists must be as long as the table list."""
    names = table_list(tables)
    where = [None] * len(names) if where is None else where
    days = delete_days.split(";") if isinstance(delete_days, str) else delete_days
    if delete_days == "":
        days = [""] * len(names)
    for name, values in (("where", where), ("delete_days", days)):
        if len(values) != len(names):
            raise ValueError(f"{name} has {len(values)} values for {len(names)} tables")
    return [
        DeleteSpec(
            table=t,
            path=locate(t),
            where=w,
            delete_days=None if d is None or not str(d).strip() else int(d),
            now=now,
            real_delete=real_delete,
        )
        for t, w, d in zip(names, where, days)
    ]
