"""Export of tables: scan, filter, project, rename, text, write, reconcile, mark."""

from __future__ import annotations

import re
import time
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablehaul.functions.dates import days_back, kind_of
from tablehaul.names import col, split_names, table_stem
from tablehaul.operators.lines import line_breaks
from tablehaul.operators.predicates import matches_all, predicate
from tablehaul.operators.project import project, rename, rename_mapping, stringify
from tablehaul.operators.validate import check_columns, null_cell_rows
from tablehaul.plans.report import export_details, export_summary
from tablehaul.sinks.layout import marker_uri, trigger_uri, write_marker, write_trigger
from tablehaul.sinks.writers import format_name, write_table, written_records
from tablehaul.sources.files import data_files, delete, exists, qualified
from tablehaul.sources.scan import key_columns, listed_files, scan_dir, scan_table, source_folders, with_keys
from tablehaul.specs import ExportSpec

RESULT_SCHEMA = (
    "table_name string, target_path string, format string, n_read long, n_written long, "
    "n_null_cells long, n_files long, size_bytes long, size_mb double, cost_ms long, "
    "cost_min double, keys string, status string, message string"
)


@dataclass
class _Result:
    table_name: str
    target_path: str | None
    format: str
    n_read: int | None = None
    n_written: int | None = None
    n_null_cells: int | None = None
    n_files: int = 0
    size_bytes: int = 0
    size_mb: float = 0.0
    cost_ms: int | None = None
    cost_min: float | None = None
    keys: str = ""
    status: str = "ok"
    message: str = ""


def source_frame(spark: SparkSession, spec: ExportSpec) -> DataFrame:
    if isinstance(spec.source, DataFrame):
        return spec.source
    if spec.file_suffix is not None:
        return scan_dir(spark, spec.source, spec.file_suffix, spec.schema)
    return scan_table(spark, spec.source, schema=spec.schema)


def _selected(spark: SparkSession, spec: ExportSpec) -> DataFrame:
    """The spec's rows and columns under their new names, still typed."""
    df = source_frame(spark, spec)
    check_columns(df, spec.declared_columns)
    keys = split_names(spec.keys) or key_columns(df)
    unknown = [k for k in keys if k not in df.columns]
    if unknown:
        raise ValueError(f"keys not in the table: {unknown}")
    if not matches_all(spec.where):
        df = df.where(predicate(spec.where, df.schema, spec.as_text))
    if spec.days_back:
        column, days = spec.days_back
        kind = kind_of(df.schema[column].dataType) if column in df.columns else None
        df = df.where(days_back(column, days, spec.today, kind, spec.tz))
    df = project(df, spec.columns, spec.skip, spec.skip_system, spec.system_columns)
    names = rename_mapping(spec.rename)
    df = rename(df, names)
    return with_keys(df, [names.get(k, k) for k in keys if names.get(k, k) in df.columns])


def _as_values(df: DataFrame, spec: ExportSpec) -> DataFrame:
    if spec.values == "typed":
        return df
    return stringify(df, binary=spec.values == "binary", null_text=spec.null_text)


def export_frame(spark: SparkSession, spec: ExportSpec) -> DataFrame:
    """The rows an export writes, as a lazy DataFrame."""
    return _as_values(_selected(spark, spec), spec)


def _counted(df: DataFrame, spec: ExportSpec) -> tuple[DataFrame, Observation]:
    """Count rows, null cells and line breaks while the write runs, without a pass of its own.

    The counters feed the writing stage directly, where a retried task counts once. They are
    named by position, so any column name works.
    """
    metrics = [F.count(F.lit(1)).alias("n_read")]
    if spec.null_policy != "ignore":
        metrics += [F.count(col(c)).alias(f"filled_{i}") for i, c in enumerate(df.columns)]
    if format_name(spec.format) in ("csv", "pipe"):
        metrics.append(line_breaks(df).alias("line_breaks"))
    seen = Observation()
    return df.observe(seen, *metrics), seen


def _export_one(spark: SparkSession, spec: ExportSpec) -> _Result:
    fmt = format_name(spec.format)
    result = _Result(spec.table, spec.target if spec.convert else None, fmt)
    if not spec.convert:
        return _verify_only(spark, spec, result)
    df = _selected(spark, spec)
    result.keys = ",".join(key_columns(df))
    # From here on nothing vouches for the target until the new files are counted.
    delete(spark, marker_uri(spec.target, spec.table))
    if spec.stamp:
        delete(spark, trigger_uri(spec.target, spec.table, spec.stamp))
    old = data_files(spark, spec.target)
    if spec.n_files is not None:
        df = df.repartition(spec.n_files)
    counted, seen = _counted(df, spec)
    start = time.monotonic()
    values = _as_values(counted, spec)
    write_table(values, spec.target, fmt, spec.parquet, spec.max_rows, spec.table, mode="append")
    cost_ms = int((time.monotonic() - start) * 1000)
    new = sorted(set(data_files(spark, spec.target)) - set(old))
    found = seen.get
    result.n_read = found["n_read"]
    if not result.n_read:
        result.n_written = 0
        result.status = "empty"
        _remove(spark, spec.target, new)
        return result
    _add_files(spark, result, spec, cost_ms, new)
    result.n_written -= found.get("line_breaks", 0)
    if fmt == "csv":
        result.n_written -= result.n_files * (1 + sum(c.count("\n") for c in df.columns))
    nulls = {}
    if spec.null_policy != "ignore":
        counts = {c: found["n_read"] - found[f"filled_{i}"] for i, c in enumerate(df.columns)}
        nulls = {c: n for c, n in counts.items() if n}
        result.n_null_cells = sum(nulls.values())
    _judge(result, spec, nulls)
    _remove(spark, spec.target, old if result.status == "ok" else new)
    if result.status == "ok":
        if spec.marker:
            write_marker(spark, spec.target, spec.table)
        if fmt == "pipe" and spec.stamp:
            write_trigger(
                spark, spec.target, spec.table, spec.stamp, result.n_read, spec.trigger_prefix
            )
    return result


def _remove(spark: SparkSession, folder: str, names: list[str]) -> None:
    """Delete files of a folder; a run that stops midway leaves the rest to the next one."""
    with ThreadPoolExecutor(max_workers=16) as pool:
        list(pool.map(lambda n: delete(spark, f"{folder.rstrip('/')}/{n}"), names))


def _add_files(
    spark: SparkSession, result: _Result, spec: ExportSpec, cost_ms: int, new: list[str]
) -> None:
    """Re-read what was written: records or lines, files and bytes.

    A write job has its own name inside the names of all its files.
    """
    job = re.match(r"part-\d+-([0-9a-f-]{36})", new[0])
    written = written_records(spark, spec.target, result.format, f"part-*-{job[1]}*" if job else "*")
    row = export_summary(export_details(written, spec.table, spec.target, cost_ms)).first()
    result.n_written = 0
    result.cost_ms = cost_ms
    if row is not None:
        result.n_written = row.n_rows
        result.n_files = row.n_files
        result.size_bytes = row.size_bytes
        result.size_mb = row.size_mb
        result.cost_min = row.cost_min


def _judge(result: _Result, spec: ExportSpec, nulls: dict[str, int]) -> None:
    if result.n_read != result.n_written:
        result.status = "failed"
        result.message = f"read {result.n_read} rows but wrote {result.n_written}"
    elif spec.expected_rows is not None and spec.expected_rows != result.n_read:
        result.status = "failed"
        result.message = f"{spec.expected_rows} rows were sent but {result.n_read} read"
    elif nulls:
        result.message = "null cells: " + ", ".join(f"{c} {n}" for c, n in nulls.items())
        if spec.null_policy == "fail":
            result.status = "failed"


def _verify_only(spark: SparkSession, spec: ExportSpec, result: _Result) -> _Result:
    df = source_frame(spark, spec)
    check_columns(df, spec.declared_columns)
    result.keys = ",".join(key_columns(df))
    files = listed_files(spark, spec.source, spec.file_suffix) if isinstance(spec.source, str) else None
    row = export_summary(export_details(df, spec.table, files=files)).first()
    result.n_read = result.n_written = row.n_rows if row else 0
    if not result.n_read:
        result.status = "empty"
    if row is not None:
        result.n_files, result.size_bytes = row.n_files, row.size_bytes
        result.size_mb = row.size_mb
    _judge(result, spec, {})
    return result


def exported_files(spark: SparkSession, specs: Iterable[ExportSpec]) -> DataFrame:
    """One row per file that the exports left, as ``export_details`` gives them.

    Text formats are counted by lines.
    """
    details = [
        export_details(written_records(spark, s.target, s.format), s.table, s.target) for s in specs
    ]
    return reduce(DataFrame.unionAll, details)


def null_rows(spark: SparkSession, spec: ExportSpec) -> DataFrame:
    """Keys and column of every null cell an export would write, under the exported names."""
    df = _selected(spark, spec)
    return null_cell_rows(df, key_columns(df))


def _check_paths(spark: SparkSession, specs: list[ExportSpec]) -> None:
    """Before anything is written: every source is there, and no target touches a source or
    another target."""
    sources = [s.source for s in specs if isinstance(s.source, str)]
    for s in specs:
        if isinstance(s.source, str) and not exists(spark, s.source):
            raise ValueError(f"no table {s.table} at {s.source}")
    sources = [qualified(spark, s) + "/" for s in sources]
    targets = [qualified(spark, s.target) + "/" for s in specs if s.convert]
    for i, target in enumerate(targets):
        for other in sources + targets[i + 1 :]:
            if target.startswith(other) or other.startswith(target):
                raise ValueError(f"target {target} overlaps {other}")
    # A frame's folders are checked against every target, its own and those of others.
    for s in specs:
        if isinstance(s.source, DataFrame):
            for folder in sorted(qualified(spark, f) + "/" for f in source_folders(s.source)):
                if any(folder.startswith(t) or t.startswith(folder) for t in targets):
                    raise ValueError(f"{s.table} is read from a target, {folder}")


def export_tables(
    spark: SparkSession, specs: Iterable[ExportSpec], parallel: int = 4
) -> DataFrame:
    """Export every table, up to ``parallel`` at a time, and report one row per table.

    ``status`` is ``ok``, ``empty`` (nothing to export) or ``failed``. One table's failure does
    not stop the others. The source is evaluated once: new files are written beside the old
    ones, counted, and then the old ones go; unless the status is ``ok`` the new ones go
    instead. An older marker and the stamp's trigger row go before anything is written, and new
    ones are written for ``ok`` only.
    """
    specs = list(specs)
    _check_paths(spark, specs)

    def run(spec: ExportSpec) -> _Result:
        # Each table is a pool of its own where the cluster schedules FAIR.
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", table_stem(spec.table))
        spark.sparkContext.setJobDescription(f"export {spec.table}")
        try:
            return _export_one(spark, spec)
        except Exception as e:
            message = str(e).strip().splitlines() or [type(e).__name__]
            return _Result(
                spec.table,
                spec.target if spec.convert else None,
                format_name(spec.format),
                status="failed",
                message=message[0],
            )

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        results = list(pool.map(inheritable_thread_target(spark)(run), specs))
    return spark.createDataFrame([tuple(vars(r).values()) for r in results], RESULT_SCHEMA)
