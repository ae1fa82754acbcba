"""Rows as lines of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.functions.text import cell_text, json_ready
from tablehaul.names import col, table_stem


def pipe_lines(df: DataFrame, separator: str = "|") -> DataFrame:
    """One ``line`` per row: text cells with a separator between, null as empty."""
    cells = [F.coalesce(cell_text(col(f.name), f.dataType), F.lit("")) for f in df.schema.fields]
    return df.select(F.concat_ws(separator, *cells).alias("line"))


def with_text_keys(df: DataFrame) -> DataFrame:
    """The same rows with text keys in every map, ready to be written as JSON."""
    return df.select(*[json_ready(col(f.name), f.dataType).alias(f.name) for f in df.schema])


def json_lines(df: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """One JSON object per row in ``line``; null fields are left out unless kept."""
    options = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return with_text_keys(df).select(F.to_json(F.struct("*"), options).alias("line"))


def trigger_text(table: str, stamp: str, rows: int | str, prefix: str | None = None) -> str:
    """``prefix|timestamp|rows``; the prefix defaults to the upper-case table stem."""
    return f"{(prefix or '').strip() or table_stem(table).upper()}|{stamp}|{rows}"


def trigger_line(df: DataFrame, table: str, stamp: str, prefix: str | None = None) -> DataFrame:
    """The trigger row of a table as a one-row DataFrame."""
    head = trigger_text(table, stamp, "", prefix)
    return df.agg(F.concat(F.lit(head), F.count(F.lit(1)).cast("string")).alias("line"))


def line_breaks(df: DataFrame) -> Column:
    """Line breaks in all cells. Only text and bytes can hold any: JSON escapes them."""
    breaks = [
        F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
        for text in (
            cell_text(col(f.name), f.dataType)
            for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BinaryType))
        )
    ]
    return F.sum(sum((F.coalesce(n, F.lit(0)) for n in breaks), F.lit(0)))
