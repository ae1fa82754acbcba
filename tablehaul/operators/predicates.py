"""Row predicates as plain data.

A predicate is a comparison ``(column, op, value)`` with op one of ``= > >= < <=``, or
``("and", p, q, ...)`` / ``("or", p, q, ...)`` over other predicates. ``None``, ``""`` and
``"*:*"`` match every row.
"""

from __future__ import annotations

import re
from datetime import date, datetime, time
from decimal import ROUND_FLOOR, Decimal, InvalidOperation, localcontext
from functools import reduce
from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.names import col

Value = Union[str, int, float, Decimal, date, datetime]
Pred = Union[None, str, tuple]

_COMPARE = {
    "=": lambda a, b: a == b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}
_OPPOSITE = {
    "=": lambda a, b: a != b,
    ">": lambda a, b: a <= b,
    ">=": lambda a, b: a < b,
    "<": lambda a, b: a >= b,
    "<=": lambda a, b: a > b,
}


def all_of(*preds: Pred) -> Pred:
    """All must hold; match-all members drop out."""
    kept = [p for p in preds if not matches_all(p)]
    return None if not kept else kept[0] if len(kept) == 1 else ("and", *kept)


def any_of(*preds: Pred) -> Pred:
    """One must hold; one match-all member makes the whole match all."""
    if not preds or any(matches_all(p) for p in preds):
        return None
    return preds[0] if len(preds) == 1 else ("or", *preds)


def matches_all(pred: Pred) -> bool:
    return pred is None or (isinstance(pred, str) and pred.strip() in ("", "*:*"))


def predicate(pred: Pred, schema: T.StructType | None = None, as_text: bool = False) -> Column:
    """The predicate as a boolean column.

    With ``schema``, the value is moved to the column's type, so that the comparison is pushed
    to the scan; where the type is coarser, the bound is rounded so that the same rows match. On
    a text column every value is compared as text. ``as_text`` compares the
    text forms by bytes instead, quotes removed from the value. That is pushed down for text
    columns and, with ``schema``, for binary ones, which have the same order. ``schema`` also
    lets a comparison name a nested field by its dotted path.
    """
    if matches_all(pred):
        return F.lit(True)
    if _is_node(pred):
        parts = [predicate(p, schema, as_text) for p in pred[1:]]
        return reduce(lambda a, b: a & b if pred[0] == "and" else a | b, parts)
    op, left, right = _sides(pred, schema, as_text)
    return _COMPARE[op](left, right)


def keep_predicate(
    pred: Pred, schema: T.StructType | None = None, as_text: bool = False
) -> Column:
    """True exactly where ``predicate`` is not true, rows with unknown outcome included.

    Written without NOT or coalesce, as comparisons and null tests, so that it is pushed down.
    """
    if matches_all(pred):
        return F.lit(False)
    if _is_node(pred):
        parts = [keep_predicate(p, schema, as_text) for p in pred[1:]]
        return reduce(lambda a, b: a | b if pred[0] == "and" else a & b, parts)
    op, left, right = _sides(pred, schema, as_text)
    return _OPPOSITE[op](left, right) | left.isNull()


def _is_node(pred: tuple) -> bool:
    if not isinstance(pred, tuple):
        raise ValueError(f"not a predicate: {pred!r}")
    if len(pred) > 1 and pred[0] in ("and", "or") and not isinstance(pred[1], str):
        return True
    if len(pred) != 3 or not isinstance(pred[0], str):
        raise ValueError(f"not a predicate: {pred!r}")
    if pred[1] not in _COMPARE:
        raise ValueError(f"unknown operator {pred[1]!r} in {pred!r}")
    if pred[2] is None:
        raise ValueError(f"null cannot be compared: {pred!r}")
    return False


def _field(name: str, schema: T.StructType | None) -> tuple[Column, T.DataType | None]:
    """A column by its exact name or, within ``schema``, a nested field by its dotted path."""
    if schema is None:
        return col(name), None
    if name in schema.names:
        return col(name), schema[name].dataType
    head, *rest = name.split(".")
    if head not in schema.names:
        raise ValueError(f"no column {name}")
    column, dtype = col(head), schema[head].dataType
    for part in rest:
        if not isinstance(dtype, T.StructType) or part not in dtype.names:
            raise ValueError(f"no column {name}")
        column, dtype = column[part], dtype[part].dataType
    return column, dtype


def _sides(
    pred: tuple, schema: T.StructType | None, as_text: bool
) -> tuple[str, Column, Column]:
    """The operator and both sides of a comparison."""
    name, op, value = pred
    left, dtype = _field(name, schema)
    if as_text:
        text = F.lit(str(value).replace("'", ""))
        if isinstance(dtype, T.BinaryType):
            return op, left, text.cast("binary")
        return op, left.cast("string"), text
    if dtype is None:
        return op, left, F.lit(value)
    if isinstance(dtype, T.StringType):
        return op, left, F.lit(value if isinstance(value, str) else _plain_text(value))
    if isinstance(dtype, (T.IntegralType, T.DecimalType)):
        return _exact_number(pred, op, left, value, dtype)
    if isinstance(dtype, T.DateType) and isinstance(value, str):
        value = _moment(value)
    if isinstance(dtype, T.DateType) and isinstance(value, datetime):
        day = F.lit(value.date())
        if value.time() == time.min:
            return op, left, day
        if op == "=":
            return _never(left)
        return {">": ">", ">=": ">", "<": "<=", "<=": "<="}[op], left, day
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)) and isinstance(value, date):
        # As text, so that a value without a zone is read as the column's type reads it.
        return op, left, F.lit(value.isoformat()).cast(dtype)
    if isinstance(value, str):
        return op, left, F.lit(value).cast(dtype)
    return op, left, F.lit(value)


_WITH_TIME = re.compile(r"\d{4}-\d\d-\d\d[ T]\d.*")


def _moment(text: str) -> str | datetime:
    """A text that has a time besides the date as that moment, without a zone; others stay."""
    if not _WITH_TIME.fullmatch(text.strip()):
        return text
    found = datetime.fromisoformat(text.strip())
    if found.tzinfo is not None:
        raise ValueError(f"a date has no zone: {text!r}")
    return found


def _plain_text(value: Value) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def _never(left: Column) -> tuple[str, Column, Column]:
    """A comparison that no value satisfies; null stays unknown."""
    return "<", left, left


def _always(left: Column) -> tuple[str, Column, Column]:
    return "<=", left, left


def _exact_number(
    pred: tuple, op: str, left: Column, value: Value, dtype: T.DataType
) -> tuple[str, Column, Column]:
    """Compare a whole or decimal column with any number, as the column's own type.

    Between two neighbouring values of the type, "greater" means greater than the lower one and
    "less" less than the upper one.
    """
    try:
        number = Decimal(str(value).strip() if not isinstance(value, bool) else int(value))
    except InvalidOperation:
        number = Decimal("NaN")
    if number.is_nan():
        raise ValueError(f"not a number: {pred!r}")
    decimal = isinstance(dtype, T.DecimalType)
    scale = dtype.scale if decimal else 0
    if decimal:
        least, most = -(10**dtype.precision - 1), 10**dtype.precision - 1
    else:
        bits = {"tinyint": 7, "smallint": 15, "int": 31}.get(dtype.simpleString(), 63)
        least, most = -(2**bits), 2**bits - 1
    with localcontext() as context:
        context.prec = 400
        if number.is_infinite() or not least <= number.scaleb(scale) <= most:
            above = number > 0
            if op == "=" or above == (op in (">", ">=")):
                return _never(left)
            return _always(left)
        units = number.scaleb(scale)
        lower = units.to_integral_value(ROUND_FLOOR)
        if units != lower:
            if op == "=":
                return _never(left)
            op, units = (">", lower) if op in (">", ">=") else ("<=", lower)
        bound = Decimal(int(units)).scaleb(-scale)
    return op, left, F.lit(str(int(bound)) if not decimal else f"{bound:f}").cast(dtype)
