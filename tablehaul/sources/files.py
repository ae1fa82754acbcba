"""File-system access through the session's Hadoop configuration, so any URI works."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

#: File systems that rename a folder in one step.
RENAMES = ("file", "hdfs", "abfs", "abfss")


def hadoop_path(spark: SparkSession, *parts: str):
    """A Hadoop path; later parts are children of the first."""
    path_class = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    path = path_class(parts[0])
    for part in parts[1:]:
        path = path_class(path, part)
    return path


def file_system(spark: SparkSession, uri: str):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path(spark, uri).getFileSystem(conf)


def qualified(spark: SparkSession, uri: str) -> str:
    """The URI with scheme and authority, without a trailing slash."""
    return file_system(spark, uri).makeQualified(hadoop_path(spark, uri)).toString()


def exists(spark: SparkSession, uri: str) -> bool:
    return file_system(spark, uri).exists(hadoop_path(spark, uri))


def write_small_text(spark: SparkSession, uri: str, text: str) -> None:
    """Create a small file (a marker, a trigger row), replacing an older one."""
    out = file_system(spark, uri).create(hadoop_path(spark, uri), True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_small_text(spark: SparkSession, uri: str) -> str:
    source = file_system(spark, uri).open(hadoop_path(spark, uri))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def delete(spark: SparkSession, uri: str) -> None:
    file_system(spark, uri).delete(hadoop_path(spark, uri), True)


def rename_over(spark: SparkSession, copy: str, home: str) -> None:
    """Replace a folder, or nothing, by a copy of it that lies beside it."""
    delete(spark, home)
    if not file_system(spark, home).rename(hadoop_path(spark, copy), hadoop_path(spark, home)):
        raise OSError(f"{copy} could not be renamed to {home}")


def data_files(spark: SparkSession, uri: str) -> list[str]:
    """Names of the files directly in a folder that readers see; none where there is no folder."""
    if not exists(spark, uri):
        return []
    names = (f.getPath().getName() for f in file_system(spark, uri).listStatus(hadoop_path(spark, uri)) if f.isFile())
    return sorted(n for n in names if n[0] not in "_.")


@cache
def _local_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="tablehaul-")


def shared_folder(spark: SparkSession) -> str:
    """A folder every executor can reach, unique to this application.

    It lies in ``spark.checkpoint.dir``. Only where that is unset in local mode, as in tests,
    a local folder stands in.
    """
    application_id = spark.sparkContext.applicationId
    master = spark.sparkContext.master
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root(application_id)
    elif not master.startswith("local") and re.match("file:/+(var/)?tmp(/|$)", root):
        raise RuntimeError(f"spark.checkpoint.dir is a temporary folder of one machine: {root}")
    return f"{root.rstrip('/')}/tablehaul/{application_id}"


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
