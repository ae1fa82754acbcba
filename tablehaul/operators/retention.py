"""Which rows a retention delete removes, and which stay."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.names import UPDATE_TIME
from tablehaul.operators.predicates import Pred, keep_predicate, predicate


def older_than(
    days: int, now: datetime, column: str = UPDATE_TIME, kind: str = "epoch_ms"
) -> Pred:
    """Rows last changed ``days`` days before ``now`` or earlier.

    The column holds epoch milliseconds or, with ``kind="time"``, dates or timestamps, which are
    compared with the bound as it stands.
    """
    if kind == "time":
        return (column, "<=", now - timedelta(days=days))
    if kind != "epoch_ms":
        raise ValueError(f"unknown kind of age column: {kind!r}")
    if now.tzinfo is None:
        now = now.replace(tzinfo=timezone.utc)
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (column, "<=", (now - epoch) // timedelta(milliseconds=1) - days * 86_400_000)


def removed(df: DataFrame, pred: Pred | Column) -> DataFrame:
    """The rows the delete removes: those where ``pred`` is true."""
    return df.where(pred if isinstance(pred, Column) else predicate(pred, df.schema))


def retain(df: DataFrame, pred: Pred | Column) -> DataFrame:
    """The rows that stay: ``pred`` is false, or unknown because of a null."""
    if isinstance(pred, Column):
        return df.where(~F.coalesce(pred, F.lit(False)))
    return df.where(keep_predicate(pred, df.schema))
