"""Scans, counts and column lists."""

from __future__ import annotations

import importlib.util
import os
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.names import col, split_names
from tablehaul.operators.predicates import Pred, matches_all, predicate
from tablehaul.sources.files import exists, file_system, hadoop_path

KEY_FLAG = "primary_key"
#: Tasks of a count per core of the cluster: enough that none holds up the others for long.
TASKS_PER_CORE = 16
#: From so many local Parquet files of so few bytes on average, their rows are counted from the footers alone.
MANY_FILES, SMALL_BYTES = 5000, 1 << 20


def scan_table(
    spark: SparkSession,
    path: str,
    columns: str | list[str] | None = None,
    where: Pred | Column = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """A table's rows that match ``where``, with the named columns (all when blank).

    The columns of all files are merged; a column whose types do not fit together is an error
    that names it. A given ``schema`` is taken as it is and saves the look at every footer.
    """
    if not exists(spark, path):
        raise ValueError(f"no table at {path}")
    df = merged(spark, path, schema).parquet(path)
    if isinstance(where, Column):
        df = df.where(where)
    elif not matches_all(where):
        df = df.where(predicate(where, df.schema))
    wanted = split_names(columns)
    return df.select(*[col(c) for c in wanted]) if wanted else df


def merged(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrameReader:
    """A reader that gives the columns of every file, or those of ``schema``."""
    if schema is not None:
        return spark.read.schema(schema)
    if file_system(spark, path).getFileStatus(hadoop_path(spark, path)).isFile():
        return spark.read
    return spark.read.option("mergeSchema", "true")


def suffix_glob(suffix: str) -> str:
    """A glob for file names with this ending in any letter case."""

    def any_case(ch: str) -> str:
        if ch.lower() != ch.upper():
            return f"[{ch.lower()}{ch.upper()}]"
        return "\\" + ch if ch in "*?[]{}\\," else ch

    return "*" + "".join(any_case(ch) for ch in suffix)


def scan_dir(
    spark: SparkSession, path: str, suffix: str = ".parquet", schema: T.StructType | None = None
) -> DataFrame:
    """The Parquet files directly in ``path`` whose names end with ``suffix``, case ignored.

    Having none is an error, and so is one with content that readers skip because its name
    starts with ``_`` or ``.``. Sub-folders are not read, not even ``key=value`` ones. Columns are those of
    all the files, as in ``scan_table``.
    """
    paths, options = _dir_paths(spark, path, suffix)
    return merged(spark, path, schema).options(**options).parquet(*paths)


def _dir_paths(spark: SparkSession, path: str, suffix: str) -> tuple[list[str], dict[str, str]]:
    """What ``scan_dir`` gives a reader to read, and with which options."""
    fs = file_system(spark, path)
    glob = suffix_glob(suffix)
    found = [f for f in fs.globStatus(hadoop_path(spark, path, glob)) or [] if f.isFile()]
    if not found:
        raise ValueError(f"no files ending with {suffix} in {path}")
    hidden = sorted(
        f.getPath().getName() for f in found if f.getPath().getName()[0] in "_." and f.getLen() > 0
    )
    if hidden:
        raise ValueError(f"readers skip these files of {path}: {', '.join(hidden)}")
    if fs.globStatus(hadoop_path(spark, path, "*=*")):
        return [f.getPath().toString() for f in found], {}
    return [path], {"pathGlobFilter": glob}


def listed_files(spark: SparkSession, path: str, suffix: str | None = None) -> DataFrame:
    """``(file_path, size_bytes)`` of the files behind ``scan_table`` or, with ``suffix``, ``scan_dir``.

    They come from the listing, those without rows too; no content is read.
    """
    paths, options = ([path], {}) if suffix is None else _dir_paths(spark, path, suffix)
    files = spark.read.format("binaryFile").options(**options).load(paths)
    return files.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("size_bytes"))


def source_folders(df: DataFrame) -> set[str]:
    """The tables' folders (or single files) that a frame reads, as they were given to its readers.

    They come from the frame's plan, so nothing is evaluated and no file is listed. Only for sources
    that are not plain files (tables of a metastore) the plan's files are asked for.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found, others = set(), False
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        relation = _file_relation(leaf)
        if relation is not None:
            roots = relation.location().rootPaths()
            found |= {roots.apply(i).toString() for i in range(roots.size())}
        else:
            others = True
    if others:
        found |= {unquote(f.rpartition("/")[0]) for f in df.inputFiles()}
    return found


def _file_relation(plan):
    """The files that a node of a plan reads, if it does nothing else."""
    relation = plan.relation() if plan.getClass().getSimpleName() == "LogicalRelation" else None
    return relation if relation is not None and relation.getClass().getSimpleName() == "HadoopFsRelation" else None


def row_count(df: DataFrame) -> DataFrame:
    """The exact count as ``n_rows``; over Parquet it reads no column."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def file_row_counts(df: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """``(file_path, n_rows, size_bytes)`` for each file behind a scan.

    Counts are partial per task before the shuffle, and no column is read. Small files come to a scan in
    parts of a few dozen, which are joined to a number of tasks that goes by the cluster. Of very many local
    Parquet files only the footers are read. A scan shows no file without rows; ``files`` from ``listed_files``
    adds those.
    """
    counts = footer_row_counts(df) if _many_local_files(df) else _scan_row_counts(df)
    if files is None:
        return counts
    n_rows = F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows")
    return files.join(counts.drop("size_bytes"), "file_path", "left").select("file_path", n_rows, "size_bytes")


def _scan_row_counts(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    n_tasks = max(
        TASKS_PER_CORE * spark.sparkContext.defaultParallelism,
        int(spark.conf.get("spark.sql.shuffle.partitions")),
    )
    file = F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("size")
    return df.select(*file).coalesce(n_tasks).groupBy("file_path").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max("size").alias("size_bytes"),
    )


def _many_local_files(df: DataFrame) -> bool:
    """Whether a frame is nothing but the rows of very many small Parquet files below one plain local folder."""
    spark = df.sparkSession
    relation = _file_relation(df._jdf.queryExecution().analyzed())
    if relation is None or relation.fileFormat().getClass().getSimpleName() != "ParquetFileFormat":
        return False
    conf, location = spark._jsparkSession.sessionState().newHadoopConf(), relation.location()
    return bool(
        location.getClass().getSimpleName() == "InMemoryFileIndex"
        and location.rootPaths().size() == 1
        and location.rootPaths().apply(0).toString().startswith("file:/")
        and (n_files := location.allFiles().size()) >= MANY_FILES
        and location.sizeInBytes() <= n_files * SMALL_BYTES
        and conf.get("fs.file.impl") is None
        and not conf.getPropsWithPrefix("parquet.")
        and spark.conf.get("spark.sql.files.ignoreCorruptFiles") == "false"
        and spark.conf.get("spark.sql.files.ignoreMissingFiles") == "false"
        and importlib.util.find_spec("pyarrow")
    )


def footer_row_counts(df: DataFrame) -> DataFrame:
    """``file_row_counts`` of local Parquet files, whose names are dealt out to tasks that read footers.

    A scan copies the Hadoop configuration for each file, which takes longer than its footer.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    names = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(df._jdf.inputFiles())
    listed = spark._jsparkSession.createDataset(names, jvm.org.apache.spark.sql.Encoders.STRING()).toDF()

    # Nested, so that executors need not have this package.
    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            found = {"file_path": [], "n_rows": [], "size_bytes": []}
            for path in batch.column(0).to_pylist():
                path = urlsplit(path).path
                local = unquote(path)
                name = os.path.basename(local)
                if name[0] == "." or name[0] == "_" and "=" not in name or not (size := os.stat(local).st_size):
                    continue  # no data to a scan
                found["file_path"].append(f"file:{path}")  # as scans have it
                found["n_rows"].append(pq.read_metadata(local).num_rows)
                found["size_bytes"].append(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.string() if k == "file_path" else pa.int64()) for k, v in found.items()], list(found)
            )

    counts = DataFrame(listed, spark).mapInArrow(count, "file_path string, n_rows long, size_bytes long")
    return counts.where("n_rows > 0")


def leaf_paths(df: DataFrame) -> list[list[str]]:
    """The path of every leaf column, in order, as the Parquet schema names its parts."""

    def leaves(dtype: T.DataType, path: list[str]) -> list[list[str]]:
        if isinstance(dtype, T.StructType):
            return [p for f in dtype.fields for p in leaves(f.dataType, path + [f.name])]
        if isinstance(dtype, T.ArrayType):
            return leaves(dtype.elementType, path + ["list", "element"])
        if isinstance(dtype, T.MapType):
            return leaves(dtype.keyType, path + ["key_value", "key"]) + leaves(
                dtype.valueType, path + ["key_value", "value"]
            )
        return [path]

    return leaves(df.schema, [])


def leaf_columns(df: DataFrame) -> list[str]:
    """The path parts of every leaf column, in order."""
    return [part for path in leaf_paths(df) for part in path]


def with_keys(df: DataFrame, keys: str | list[str]) -> DataFrame:
    """Mark key columns; the mark is kept in the Parquet footer."""
    names = split_names(keys)
    for key in names:
        if key not in df.columns:
            raise ValueError(f"key column not in the table: {key}")
    marked = [
        col(f.name).alias(f.name, metadata={**f.metadata, KEY_FLAG: True})
        if f.name in names
        else col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*marked) if names else df


def key_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.metadata.get(KEY_FLAG)]
