"""One writer per output format, and the matching read for checks."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.names import clean_table_path
from tablehaul.operators.lines import line_breaks, pipe_lines, with_text_keys
from tablehaul.operators.project import stringify
from tablehaul.sinks.small_files import fits, write_small_files
from tablehaul.sources.files import RENAMES, delete, qualified, rename_over
from tablehaul.sources.scan import file_row_counts, source_folders

# The option names for the two Parquet page versions.
PARQUET_VERSIONS = {"v1": "PARQUET_1_0", "v2": "PARQUET_2_0"}

# Every field quoted, a quote doubled, null written as "". White space is kept.
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


@dataclass(frozen=True)
class ParquetOptions:
    """Parquet settings, with the defaults exports use."""

    compression: str = "gzip"
    version: str = "v2"
    dictionary: bool = True
    dictionary_page_bytes: int = 512

    def as_options(self) -> dict[str, str]:
        version = PARQUET_VERSIONS.get(self.version.lower())
        if version is None:
            raise ValueError(f"unknown Parquet version: {self.version!r}")
        return {
            "compression": self.compression,
            "parquet.writer.version": version,
            "parquet.enable.dictionary": str(self.dictionary).lower(),
            "parquet.dictionary.page.size": str(self.dictionary_page_bytes),
        }


# Fixed value: each task moves its own files, where the driver would rename all of them one by one.
COMMIT_IN_TASKS = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def _writer(df: DataFrame, limit: dict[str, str], mode: str) -> DataFrameWriter:
    return df.write.mode(mode).options(**limit)


def _write_parquet(df, uri, options, limit, table, mode):
    options = options or ParquetOptions()
    _writer(df, limit, mode).options(**options.as_options()).parquet(uri)


def _write_small(df: DataFrame, uri: str, options: ParquetOptions, max_rows: int) -> bool:
    """Whether ``uri`` now holds the rows in small files; if not, it is for Spark's writer."""
    return fits(df, uri, options.compression, max_rows) and write_small_files(df, uri, options, max_rows) > 0


def _write_csv(df, uri, options, limit, table, mode):
    _writer(stringify(df), limit, mode).options(quoteAll="true", **CSV_OPTIONS).csv(uri)


def _write_json(df, uri, options, limit, table, mode):
    _writer(with_text_keys(df), limit, mode).json(uri)


def _write_pipe(df, uri, options, limit, table, mode):
    _writer(pipe_lines(df), limit, mode).option("lineSep", "\n").text(uri)


def _write_avro(df, uri, options, limit, table, mode):
    namespace, _, name = clean_table_path(table or "table").rpartition("/")
    writer = _writer(df, limit, mode).format("avro").option("recordName", name)
    if namespace:
        writer = writer.option("recordNamespace", namespace.replace("/", "."))
    try:
        writer.save(uri)
    except AnalysisException as e:
        if "avro" in str(e).lower() and "find" in str(e).lower():
            raise RuntimeError(
                "writing Avro needs the spark-avro module on the class path"
            ) from e
        raise


FORMATS: dict[str, Callable] = {
    "parquet": _write_parquet,
    "csv": _write_csv,
    "json": _write_json,
    "pipe": _write_pipe,
    "avro": _write_avro,
}


def format_name(fmt: str) -> str:
    name = fmt.strip().lower()
    if name not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}, known are {', '.join(FORMATS)}")
    return name


def write_table(
    df: DataFrame,
    uri: str,
    format: str = "parquet",
    options: ParquetOptions | None = None,
    max_rows: int | None = None,
    table: str | None = None,
    mode: str = "overwrite",
) -> None:
    """Write ``df`` to the directory ``uri``, replacing what is there unless ``mode`` is append.

    ``max_rows`` is a strict limit of rows per file. It may make very many files, so where a folder is
    renamed in one step they are written beside the directory, each task moving its own, and take its place
    when they are whole: a failed run leaves what was there. ``table`` names the Avro record.
    """
    if max_rows is not None and max_rows < 1:
        raise ValueError(f"max_rows must be positive: {max_rows}")
    write = FORMATS[format_name(format)]
    limit = {} if max_rows is None else {"maxRecordsPerFile": str(max_rows)}
    spark = df.sparkSession
    home = qualified(spark, uri)
    if max_rows is None or mode != "overwrite" or home.partition(":")[0] not in RENAMES:
        write(df, uri, options, limit, table, mode)
        return
    if home in {qualified(spark, f) for f in source_folders(df)}:
        raise ValueError(f"{uri} cannot be overwritten while it is read")
    parent, _, name = home.rpartition("/")
    staged = f"{parent}/_{name}_{uuid.uuid4().hex[:12]}"
    try:
        if not (write is _write_parquet and _write_small(df, staged, options or ParquetOptions(), max_rows)):
            write(df, staged, options, limit | COMMIT_IN_TASKS, table, mode)
    except BaseException:
        delete(spark, staged)
        raise
    rename_over(spark, staged, home)
    spark.catalog.refreshByPath(home)


def read_written(
    spark: SparkSession, uri: str, format: str, schema: T.StructType | None = None
) -> DataFrame:
    """Read an export back. Pipe output comes back as ``line``; JSON and CSV want a schema."""
    name = format_name(format)
    if name == "parquet":
        return spark.read.parquet(uri)
    if name == "avro":
        return spark.read.format("avro").load(uri)
    if name == "pipe":
        return spark.read.option("lineSep", "\n").text(uri).withColumnRenamed("value", "line")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if name == "json":
        return reader.json(uri)
    return reader.options(multiLine="true", **CSV_OPTIONS).csv(uri)


def written_records(
    spark: SparkSession, uri: str, format: str, names: str = "*"
) -> DataFrame:
    """An export as a frame to count, without parsing: Parquet and Avro give a row per record,
    the text formats a row per line, CSV headers and line breaks inside values included.
    ``names`` is a glob for the files to count."""
    name = format_name(format)
    reader = spark.read.option("pathGlobFilter", names)
    if name in ("parquet", "avro"):
        return reader.format(name).load(uri)
    return reader.option("lineSep", "\n").text(uri)


def written_row_count(
    spark: SparkSession, uri: str, format: str, source: DataFrame | None = None
) -> DataFrame:
    """The records of an export as ``n_rows``.

    CSV lines are counted, less the headers and the line breaks inside the cells of ``source``,
    the frame that was written. Without it CSV is parsed, each file in one task.
    """
    if format_name(format) == "csv" and source is not None:
        header = 1 + sum(c.count("\n") for c in source.columns)
        files = file_row_counts(written_records(spark, uri, format))
        records = files.agg(F.sum(F.col("n_rows") - header).alias("n"))
        inside = source.agg((-line_breaks(source)).alias("n"))
        return records.unionAll(inside).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
    if format_name(format) == "csv":
        one_column = T.StructType([T.StructField("c", T.StringType())])
        written = read_written(spark, uri, format, one_column)
    else:
        written = written_records(spark, uri, format)
    return written.agg(F.count(F.lit(1)).alias("n_rows"))
