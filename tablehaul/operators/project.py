"""Column choice, renaming and the text form of columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.functions.text import cell_text, is_nested, json_ready
from tablehaul.names import SYSTEM_COLUMNS, col, split_names


def project(
    df: DataFrame,
    columns: str | list[str] | None = None,
    skip: str | Iterable[str] = (),
    skip_system: bool = True,
    system_columns: Iterable[str] = SYSTEM_COLUMNS,
) -> DataFrame:
    """Select ``columns`` (all when blank) without the skipped ones; names match exactly."""
    skipped = set(split_names(skip if isinstance(skip, str) else list(skip)))
    if skip_system:
        skipped |= set(system_columns)
    wanted = split_names(columns) or df.columns
    unknown = [c for c in wanted if c not in df.columns]
    if unknown:
        raise ValueError(f"columns not in the table: {unknown}")
    return df.select(*[col(c) for c in wanted if c not in skipped])


def rename_mapping(mapping: str | Mapping[str, str] | None) -> dict[str, str]:
    """``"old:new, old2:new2"`` or a dict; items with a blank side are left out."""
    if not mapping:
        return {}
    if isinstance(mapping, str):
        items = []
        for item in split_names(mapping):
            old, sep, new = item.partition(":")
            if not sep or ":" in new:
                raise ValueError(f"not an old:new pair: {item!r}")
            items.append((old, new))
    else:
        items = list(mapping.items())
    return {old.strip(): new.strip() for old, new in items if old.strip() and new.strip()}


def rename(df: DataFrame, mapping: str | Mapping[str, str] | None) -> DataFrame:
    """Rename columns, all at once; names the table lacks are ignored."""
    names = rename_mapping(mapping)
    new_names = [names.get(c, c) for c in df.columns]
    twice = sorted({c for c in new_names if new_names.count(c) > 1})
    if twice:
        raise ValueError(f"renaming gives these columns twice: {twice}")
    return df.select(*[col(c).alias(n) for c, n in zip(df.columns, new_names)])


def stringify(
    df: DataFrame, binary: bool = False, null_text: str | None = None, nested: str = "json"
) -> DataFrame:
    """Every column as text, or as its UTF-8 bytes with ``binary``.

    Nulls stay null unless ``null_text`` is given. ``nested="null"`` writes nested values as
    null in place of JSON.
    """
    if nested not in ("json", "null"):
        raise ValueError(f"nested must be 'json' or 'null': {nested!r}")

    def text(f: T.StructField) -> Column:
        if nested == "null" and is_nested(f.dataType):
            c = F.lit(None).cast("string")
        else:
            c = cell_text(col(f.name), f.dataType)
        if null_text is not None:
            c = F.coalesce(c, F.lit(null_text))
        if binary:
            c = c.cast("binary")
        return c.alias(f.name, metadata=f.metadata)

    return df.select(*[text(f) for f in df.schema.fields])


def nested_to_json(df: DataFrame, columns: str | list[str] | None = None) -> DataFrame:
    """Struct, array and map columns (all, or those named) as JSON text."""
    wanted = split_names(columns)

    def convert(f: T.StructField) -> Column:
        if is_nested(f.dataType) and (not wanted or f.name in wanted):
            return F.to_json(json_ready(col(f.name), f.dataType)).alias(f.name)
        return col(f.name)

    return df.select(*[convert(f) for f in df.schema.fields])
