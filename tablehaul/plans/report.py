"""Reports over exports and deletes: plain aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.functions.units import bytes_to_mb, ms_to_min
from tablehaul.operators.predicates import Pred
from tablehaul.operators.retention import removed
from tablehaul.sources.scan import file_row_counts


def sent_count_sum(sent: DataFrame) -> DataFrame:
    """Rows sent per table from ``(table_name, server, n)``, one row per server and table."""
    return sent.groupBy("table_name").agg(F.sum("n").alias("n"))


def delete_counts(tables: dict[str, tuple[DataFrame, Pred | Column]]) -> DataFrame:
    """``(table_name, n_deleted)``: what each table's predicate would remove."""
    counts = [
        removed(df, pred).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_deleted")
        )
        for name, (df, pred) in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def export_details(
    df: DataFrame,
    table: str,
    target: str | None = None,
    cost_ms: int | None = None,
    files: DataFrame | None = None,
) -> DataFrame:
    """One row per file behind ``df``, a scan of an export. ``cost_ms`` is the table's write
    time: Spark writes files side by side, so a file has none of its own and each repeats the table's.
    ``files`` lists those without rows too."""
    cost = F.lit(cost_ms).cast("long")
    return file_row_counts(df, files).select(
        F.lit(table).alias("table_name"),
        "file_path",
        F.lit(target).alias("target_path"),
        "n_rows",
        "size_bytes",
        bytes_to_mb(F.col("size_bytes")).alias("size_mb"),
        cost.alias("cost_ms"),
        ms_to_min(cost).alias("cost_min"),
    )


def export_summary(details: DataFrame, keys: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per table and target from the detail rows."""
    key_text = F.lit("")
    for table, names in (keys or {}).items():
        key_text = F.when(F.col("table_name") == table, ",".join(names)).otherwise(key_text)
    return (
        details.groupBy("table_name", "target_path")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.count(F.lit(1)).alias("n_files"),
            F.sum("size_bytes").alias("size_bytes"),
            F.max("cost_ms").alias("cost_ms"),
        )
        .select(
            "*",
            bytes_to_mb(F.col("size_bytes")).alias("size_mb"),
            ms_to_min(F.col("cost_ms")).alias("cost_min"),
            key_text.alias("keys"),
        )
    )
