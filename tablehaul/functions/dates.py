"""Days-back criteria. "Today" is always an argument, never the clock."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.names import UPDATE_TIME, col


def text_date(day: date) -> str:
    """``yyyyMMdd``, whose text order is the date order."""
    return day.strftime("%Y%m%d")


def start_of_day_ms(day: date, tz: str = "UTC") -> int:
    """Epoch milliseconds of midnight at the start of ``day``."""
    return int(datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(tz)).timestamp()) * 1000


def _midnight(day: date, kind: str, tz: str) -> Column:
    if kind == "time":
        return F.lit(day.isoformat()).cast("timestamp_ntz")
    return F.timestamp_millis(F.lit(start_of_day_ms(day, tz)))


def kind_of(dtype: T.DataType) -> str | None:
    """The kind of days-back column by its type; None leaves it to the name."""
    kinds = {"date": "day", "timestamp_ntz": "time", "timestamp": "zoned_time"}
    return kinds.get(dtype.simpleString())


def days_back(
    column: str, days: int, today: date, kind: str | None = None, tz: str = "UTC"
) -> Column:
    """Rows of the last ``days`` days.

    ``kind="date"`` reads a ``yyyyMMdd`` text column, where 0 days means today only.
    ``kind="day"`` is the same on a date column, ``kind="time"`` on a timestamp column without
    a zone and ``kind="zoned_time"`` on one with a zone, where days begin at midnight in ``tz``.
    ``kind="epoch_ms"`` reads a number column and is always "since". Without ``kind`` the
    update-time column counts as ``epoch_ms`` and any other as ``date``. The bound is a
    plain literal, so the comparison reaches the Parquet scan.
    """
    if kind is None:
        kind = "epoch_ms" if column == UPDATE_TIME else "date"
    first = today - timedelta(days=days)
    if kind == "epoch_ms":
        return col(column) >= F.lit(start_of_day_ms(first, tz))
    if kind == "day":
        return col(column) == F.lit(first) if days == 0 else col(column) >= F.lit(first)
    if kind in ("time", "zoned_time"):
        start, end = (_midnight(d, kind, tz) for d in (first, first + timedelta(days=1)))
        since = col(column) >= start
        return since & (col(column) < end) if days == 0 else since
    if kind != "date":
        raise ValueError(f"unknown kind of days-back column: {kind!r}")
    bound = F.lit(text_date(first))
    return col(column) == bound if days == 0 else col(column) >= bound
