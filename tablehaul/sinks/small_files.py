"""Parquet files of few rows each, filled by Arrow inside Spark's tasks.

Spark's own writer pays by the file, not by the row: some 6 ms of CPU to set it up and, on a local file system
without Hadoop's native library, two ``chmod`` processes. A table cut into very small files is those costs only.
"""

from __future__ import annotations

import importlib.util
import os
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablehaul.sources.files import delete, file_system, hadoop_path, rename_over, write_small_text

#: Rows of a file up to which this pays; larger files go through Spark's writer, which streams their rows.
MOST_ROWS = 1000
#: Where attempts of tasks announce themselves before they write, and what that folder is called when all are done.
OPEN, CLOSED = "_attempts", "_attempts_closed"
#: Per codec Arrow's name and Spark's level and file ending.
CODECS = {
    "gzip": ("gzip", 6, ".gz"),
    "snappy": ("snappy", None, ".snappy"),
    "zstd": ("zstd", 3, ".zstd"),
    "none": ("none", None, ""),
    "uncompressed": ("none", None, ""),
}
#: What Spark and Arrow give the same columns of Parquet.
PLAIN_TYPES = [
    T.BooleanType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(),
    T.StringType(), T.BinaryType(), T.DateType(), T.TimestampNTZType(),
]


def fits(df: DataFrame, uri: str, compression: str, max_rows: int) -> bool:
    """Whether ``write_small_files`` makes of a frame what Spark's writer makes: for few rows a file, flat columns of
    common types, a plain local folder, and a session without Parquet settings of its own."""
    spark, fields = df.sparkSession, df.schema.fields
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return bool(
        max_rows <= MOST_ROWS
        and compression.lower() in CODECS
        and fields
        and all(f.dataType in PLAIN_TYPES and "parquet.field.id" not in f.metadata for f in fields)
        and len({f.name.lower() for f in fields}) == len(fields)
        and not df.isStreaming
        and uri.startswith("file:")
        and conf.get("fs.file.impl") is None
        and not conf.getPropsWithPrefix("parquet.")
        and spark.conf.get("spark.sql.parquet.datetimeRebaseModeInWrite") == "CORRECTED"
        and importlib.util.find_spec("pyarrow")
    )


def write_small_files(df: DataFrame, uri: str, options, max_rows: int) -> int:
    """Write ``df`` to the new folder ``uri`` with at most ``max_rows`` rows a file; the number of files.

    Each attempt of a task announces itself and writes files of names of its own. When Spark has a result of every task
    no attempt can begin any more; if there were others than those with the results, failed or doubled ones, only
    the files of the attempts with the results are kept. A frame without rows makes no file.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = df.sparkSession
    context = spark.sparkContext
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    settings = options.as_options()
    codec, level, ending = CODECS[options.compression.lower()]
    delta = settings["parquet.writer.version"] == "PARQUET_2_0"
    dictionary, page = options.dictionary, options.dictionary_page_bytes
    schema = to_arrow_schema(df.schema).remove_metadata()
    footer = {
        "org.apache.spark.version": spark.version,
        "org.apache.spark.sql.parquet.row.metadata": df._jdf.schema().json(),
    }
    job = uuid.uuid4()
    home = hadoop_path(spark, uri).toUri().getPath()
    kept = f"{home}_kept"
    access = 0o666 & ~context._jvm.org.apache.hadoop.fs.permission.FsPermission.getUMask(conf).toShort()
    fs = file_system(spark, uri)
    fs.mkdirs(hadoop_path(spark, uri, OPEN))

    # The functions are nested, so that executors need not have this package.
    def cut(batches: Iterator) -> Iterator:
        """The rows of a task, ``max_rows`` by ``max_rows``, each time with the encodings of their columns."""
        import pyarrow as pa

        held, n_held = [], 0
        for batch in batches:
            held.append(pa.RecordBatch.from_arrays(batch.columns, schema=schema))
            n_held += batch.num_rows
            if n_held >= max_rows:
                rows = pa.Table.from_batches(held).combine_chunks()
                whole, how = n_held - n_held % max_rows, encodings(rows)
                yield from ((rows.slice(at, max_rows), how) for at in range(0, whole, max_rows))
                held, n_held = rows.slice(whole).to_batches(), n_held - whole
        if n_held:
            rows = pa.Table.from_batches(held).combine_chunks()
            yield rows, encodings(rows)

    def encodings(rows) -> dict:
        """As Spark's writer: dictionaries where they surely fit their page and save bytes, else by type."""
        import pyarrow.types as kinds

        coded, others = [], {}
        for field, column in zip(schema, rows.columns):
            if kinds.is_boolean(field.type):
                continue
            size = column.unique().nbytes if dictionary else None
            if size is not None and size <= page and size < column.slice(0, max_rows).nbytes:
                coded.append(field.name)
            elif delta and not kinds.is_floating(field.type):
                text = kinds.is_string(field.type) or kinds.is_binary(field.type)
                others[field.name] = "DELTA_BYTE_ARRAY" if text else "DELTA_BINARY_PACKED"
        return {"use_dictionary": coded, "column_encoding": others}

    def content(rows, how: dict) -> memoryview:
        """A whole file."""
        import pyarrow as pa
        import pyarrow.parquet as pq

        out = pa.BufferOutputStream()
        with pq.ParquetWriter(
            out, schema, version="2.6", data_page_version="2.0" if delta else "1.0", compression=codec,
            compression_level=level, dictionary_pagesize_limit=page, store_schema=False, write_page_checksum=True, **how
        ) as writer:
            writer.write_table(rows)
            writer.add_key_value_metadata(footer)
        return memoryview(out.getvalue())

    def name(task: int, attempt: int, at: int) -> str:
        return f"part-{task:05d}-{job}-{attempt}-c{at:03d}{ending}.parquet"

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        running, n_files = TaskContext.get(), 0
        task, attempt = running.partitionId(), running.taskAttemptId()
        open(f"{home}/{OPEN}/{attempt}", "xb").close()  # fails once the driver has closed the job
        for rows, how in cut(batches):
            with open(f"{home}/{name(task, attempt, n_files)}", "xb", buffering=0) as out:
                os.fchmod(out.fileno(), access)
                data = content(rows, how)
                while data:
                    data = data[out.write(data) :]
            n_files += 1
        yield pa.RecordBatch.from_pydict({"task": [task], "attempt": [attempt], "n_files": [n_files]})

    def keep(done) -> None:
        for at in range(done.n_files):
            try:
                os.rename(f"{home}/{name(done.task, done.attempt, at)}", f"{kept}/{name(done.task, done.attempt, at)}")
            except FileNotFoundError:
                # Only another attempt to keep this file may have moved it.
                if not os.path.exists(f"{kept}/{name(done.task, done.attempt, at)}"):
                    raise

    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))  # mapInArrow looks columns up by name, dots and all
    done = plain.mapInArrow(write, "task long, attempt long, n_files long").collect()
    os.rename(f"{home}/{OPEN}", f"{home}/{CLOSED}")
    if {str(r.attempt) for r in done} != set(os.listdir(f"{home}/{CLOSED}")):
        fs.mkdirs(hadoop_path(spark, f"{uri}_kept"))
        try:
            context.parallelize(done, len(done)).foreach(keep)
        except BaseException:
            delete(spark, f"{uri}_kept")
            raise
        rename_over(spark, f"{uri}_kept", uri)
    else:
        fs.delete(hadoop_path(spark, uri, CLOSED), True)
    if conf.getBoolean("mapreduce.fileoutputcommitter.marksuccessfuljobs", True):
        write_small_text(spark, f"{uri}/_SUCCESS", "")
    return sum(r.n_files for r in done)
