"""Text functions: quotes, table paths and the text form of a cell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strip_quotes(c: Column) -> Column:
    """Remove every single quote."""
    return F.replace(c, F.lit("'"), F.lit(""))


def table_path(c: Column) -> Column:
    """``/group/table/`` -> ``group/table``."""
    return F.btrim(c, F.lit("/"))


def file_stem(c: Column) -> Column:
    """``/group/table`` -> ``group_table``, the name used for files."""
    return F.translate(table_path(c), "/", "_")


def binary_to_text(c: Column) -> Column:
    """Bytes as UTF-8; malformed sequences become U+FFFD."""
    return F.make_valid_utf8(c.cast("string"))


def json_ready(c: Column, dtype: T.DataType) -> Column:
    """Give every map text keys (bytes as base64), which is what JSON objects need."""
    if not _has_non_text_key(dtype):
        return c
    if isinstance(dtype, T.MapType):
        if isinstance(dtype.keyType, T.BinaryType):
            c = F.transform_keys(c, lambda k, _: F.base64(k))
        elif not isinstance(dtype.keyType, T.StringType):
            c = F.transform_keys(c, lambda k, _: k.cast("string"))
        return F.transform_values(c, lambda _, v: json_ready(v, dtype.valueType))
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda e: json_ready(e, dtype.elementType))
    fields = [json_ready(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]
    return F.when(c.isNotNull(), F.struct(*fields))


def _has_non_text_key(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return not isinstance(dtype.keyType, T.StringType) or _has_non_text_key(dtype.valueType)
    if isinstance(dtype, T.ArrayType):
        return _has_non_text_key(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_has_non_text_key(f.dataType) for f in dtype.fields)
    return False


def is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))


def cell_text(c: Column, dtype: T.DataType) -> Column:
    """The text form of a cell: bytes as UTF-8, nested values as JSON, the rest by cast."""
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.BinaryType):
        return binary_to_text(c)
    if is_nested(dtype):
        return F.to_json(json_ready(c, dtype))
    return c.cast("string")
