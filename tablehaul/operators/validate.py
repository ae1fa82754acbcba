"""Checks of exported data: null cells, declared columns, row counts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.names import col, split_names


def null_cell_counts(df: DataFrame) -> DataFrame:
    """``(column_name, n_null)`` for every column: one pass, one partial row per task.

    The counters are named by position, so any column name works.
    """
    counters = [F.count_if(col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(df.columns)]
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"nulls_{i}").alias("n_null"))
        for i, c in enumerate(df.columns)
    ]
    return df.agg(*counters).select(F.inline(F.array(*cells)))


def null_cell_rows(
    df: DataFrame, keys: str | list[str], columns: str | list[str] | None = None
) -> DataFrame:
    """Every null cell as the row's keys and the ``column_name``.

    The null columns of a row are gathered in one array first, so rows without nulls never
    leave the filter.
    """
    checked = split_names(columns) or df.columns
    names = F.array_compact(
        F.array(*[F.when(col(c).isNull(), F.lit(c)) for c in checked])
    )
    any_null = reduce(or_, [col(c).isNull() for c in checked])
    return df.where(any_null).select(
        *[col(k) for k in split_names(keys)], F.explode(names).alias("column_name")
    )


def check_columns(df: DataFrame, declared: Iterable[str]) -> None:
    """Raise when the declared columns and the table's differ; nothing declared, no check."""
    declared = list(declared)
    if not declared:
        return
    missing = sorted((Counter(declared) - Counter(df.columns)).elements())
    extra = sorted((Counter(df.columns) - Counter(declared)).elements())
    if missing or extra:
        raise ValueError(
            f"declared {len(declared)} columns, table has {len(df.columns)}: "
            f"not in the table {missing}, not declared {extra}"
        )


def reconcile(read: DataFrame, written: DataFrame, sent: DataFrame | None = None) -> DataFrame:
    """Compare counts per table: ``(table_name, n)`` frames of rows read, written and sent.

    ``status`` is ``ok``, ``read_ne_written``, ``missing`` (a table without a sent count) or
    ``sent_ne_read``. Without ``sent`` only read and written are compared. The frames have one
    row per table.
    """
    counts = read.select("table_name", F.col("n").alias("n_read")).join(
        written.select("table_name", F.col("n").alias("n_written")), "table_name", "full"
    )
    status = F.when(~F.col("n_read").eqNullSafe(F.col("n_written")), "read_ne_written")
    if sent is None:
        return counts.withColumn("status", status.otherwise("ok"))
    counts = counts.join(
        sent.select("table_name", F.col("n").alias("n_sent")), "table_name", "full"
    )
    return counts.withColumn(
        "status",
        status.when(F.col("n_sent").isNull(), "missing")
        .when(~F.col("n_sent").eqNullSafe(F.col("n_read")), "sent_ne_read")
        .otherwise("ok"),
    )
