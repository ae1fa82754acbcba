"""Unit conversions of the export reports."""

from __future__ import annotations

from pyspark.sql import Column


def bytes_to_mb(c: Column) -> Column:
    return c.cast("double") / 1024 / 1024


def ms_to_min(c: Column) -> Column:
    return c.cast("double") / 1000 / 60
