"""Retention deletes on Parquet directories.

Folders (the table's own, or those of its partitions) that hold no row to delete are left alone. The
others are replaced: the rows that stay are written beside the table and counted, then each folder
gives way to its copy. Which folders change comes from a join of two counts per
folder, so the driver holds one row per changed folder and never a list of files.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from hashlib import md5
from typing import NamedTuple
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.names import col
from tablehaul.operators.predicates import Pred
from tablehaul.operators.retention import removed, retain
from tablehaul.sources.files import RENAMES, delete, exists, hadoop_path, qualified, rename_over
from tablehaul.sources.scan import scan_table
from tablehaul.specs import DeleteSpec

#: A folder below the table, its copy below the staged folder (null where nothing stays) and the codec of its files.
REPLACED = "folder string, copy string, compression string"


class Changed(NamedTuple):
    """A folder with matches: where it lies below the table, its URI, one of its files, and its rows."""

    folder: str
    uri: str
    file: str
    n_match: int
    n_rows: int

    @property
    def n_kept(self) -> int:
        return self.n_rows - self.n_match


def delete_from(
    spark: SparkSession,
    path: str,
    pred: Pred | Column,
    real_delete: bool = True,
    schema: T.StructType | None = None,
) -> int:
    """Delete the rows where ``pred`` is true and return their number.

    Rows for which it is unknown stay. Match-all deletes every row and keeps the schema. With
    ``real_delete=False`` rows are only counted. ``schema`` names all of the table's columns and
    saves the look at every footer.

    The rows that stay in folders with matches are copied beside the table, and each copy takes its
    folder's place, by a rename where the store has one. A run that stops before the copy is whole has changed
    nothing, later ``finish_delete`` completes it. While a folder is replaced readers may miss its rows, and no
    other job may write the table.
    """
    staged = _staged(spark, path)
    if exists(spark, staged):
        raise RuntimeError(f"{path} has an unfinished delete, call finish_delete first")
    table = scan_table(spark, path, schema=schema)
    matches = removed(table, pred)
    if not real_delete:
        return matches.count()
    changed = _changed(spark, path, table, matches)
    total = sum(c.n_match for c in changed)
    if total:
        emptied = not any(c.n_kept for c in changed) and table.count() == total  # footers only
        _check_schema(spark, changed[0].file, schema)
        _replace(spark, path, _stage(spark, path, changed, emptied, table.schema, pred))
    return total


def _staged(spark: SparkSession, path: str) -> str:
    """Where a delete keeps the copy: beside the table, under a name that readers skip."""
    parent, _, name = qualified(spark, path).rpartition("/")
    return f"{parent}/_{name}_delete"


def _check_schema(spark: SparkSession, file: str, schema: T.StructType | None) -> None:
    """Columns that a given schema leaves out would be lost."""
    lost = set(spark.read.parquet(file).columns) - set(schema.names) if schema is not None else ()
    if lost:
        raise ValueError(f"the schema lacks columns of the table: {sorted(lost)}")


def _folder() -> Column:
    """The URI of the folder a row's file lies in."""
    return F.regexp_replace("_metadata.file_path", "/[^/]*$", "")


def _changed(spark: SparkSession, path: str, table: DataFrame, matches: DataFrame) -> list[Changed]:
    """Each folder with a match."""
    base = qualified(spark, path)
    n = F.count(F.lit(1))
    file = F.min("_metadata.file_path").alias("file")
    of_matches = matches.groupBy(_folder().alias("uri")).agg(n.alias("n_match"), file)
    of_all = table.groupBy(_folder().alias("uri")).agg(n.alias("n_rows"))
    out = []
    for r in of_matches.join(of_all, "uri").collect():
        found = unquote(r.uri)
        if not f"{found}/".startswith(f"{base}/"):
            raise ValueError(f"{found} does not lie in {path}")
        out.append(Changed(found[len(base) :].strip("/"), r.uri, unquote(r.file), r.n_match, r.n_rows))
    return sorted(out)


def _stage(
    spark: SparkSession,
    path: str,
    changed: list[Changed],
    emptied: bool,
    schema: T.StructType,
    pred: Pred | Column,
) -> list[tuple]:
    """Copy what stays of the folders; the list of folders, written last, says that the copy is whole.

    A copy is named by a hash of its folder, so that the folder's own name, whoever wrote it, stays as it is.
    """
    base, staged = qualified(spark, path), _staged(spark, path)
    codec = _codec(spark, changed[0].file)
    options = {"compression": codec} if codec else {}
    parts = [p.partition("=")[0] for p in changed[0].folder.split("/") if "=" in p]
    data = [col(c) for c in schema.names if c not in parts]
    source = spark.read.option("basePath", base).schema(schema)
    source = source.parquet(*[f"{base}/{c.folder}".rstrip("/") for c in changed])
    kept = retain(source, pred)
    if emptied:
        kept.select(*data).limit(0).write.options(**options).parquet(f"{staged}/schema")
    by = "copy"
    while by.lower() in {c.lower() for c in schema.names}:
        by += "_"
    copies = {c: f"rows/{by}={md5(c.uri.encode()).hexdigest()}" for c in changed if c.n_kept}
    expected, found = sum(c.n_kept for c in changed), 0
    if expected:
        seen = Observation()
        counted = kept.observe(seen, F.count(F.lit(1)).alias("n"))
        if parts:
            hashed = F.md5(_folder().cast("binary")).alias(by)
            counted.select(*data, hashed).write.options(**options).partitionBy(by).parquet(f"{staged}/rows")
        else:
            counted.select(*data).write.options(**options).parquet(f"{staged}/{copies[changed[0]]}")
        found = seen.get["n"]
    if found != expected:
        delete(spark, staged)
        raise RuntimeError(f"{path}: {expected} rows should stay, {found} were written")
    rows = [(c.folder, "schema" if emptied and not i else copies.get(c), codec) for i, c in enumerate(changed)]
    spark.createDataFrame(rows, REPLACED).coalesce(1).write.parquet(f"{staged}/folders")
    return rows


def _replace(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    """Put whole copies in their folders' place. It may be run again after it stopped."""
    base, staged = qualified(spark, path), _staged(spark, path)

    def put(row: tuple) -> None:
        folder, copy, codec = row
        home = f"{base}/{folder}".rstrip("/")
        if copy is None:
            delete(spark, home)
        elif exists(spark, f"{staged}/{copy}"):  # else it was renamed before a run stopped
            _put(spark, f"{staged}/{copy}", home, codec)

    with ThreadPoolExecutor(max_workers=8) as pool:
        list(pool.map(inheritable_thread_target(spark)(put), rows))
    delete(spark, staged)


def _put(spark: SparkSession, copy: str, home: str, codec: str | None) -> None:
    """Replace one folder by its copy; where the store does not rename in one step, Spark overwrites it."""
    if home.partition(":")[0] in RENAMES:
        rename_over(spark, copy, home)
        return
    writer = spark.read.parquet(copy).write.mode("overwrite")
    (writer.option("compression", codec) if codec else writer).parquet(home)


def finish_delete(spark: SparkSession, path: str) -> bool:
    """Complete a delete that stopped while it replaced folders; one that stopped before is dropped.

    Returns whether there was one to complete.
    """
    staged = _staged(spark, path)
    if exists(spark, f"{staged}/folders/_SUCCESS"):
        rows = spark.read.schema(REPLACED).parquet(f"{staged}/folders").collect()
        _replace(spark, path, [tuple(r) for r in rows])
        return True
    if exists(spark, staged):
        delete(spark, staged)
    return False


def _codec(spark: SparkSession, file: str) -> str | None:
    """The compression of a table's files, by the footer of one of them."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(hadoop_path(spark, file), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        blocks = reader.getFooter().getBlocks()
        return blocks[0].getColumns()[0].getCodec().name().lower() if len(blocks) else None
    finally:
        reader.close()


def delete_many(
    spark: SparkSession, specs: Iterable[DeleteSpec], parallel: int = 4
) -> DataFrame:
    """Run the deletes, up to ``parallel`` at a time, and report one row per table.

    ``status`` is ``ok`` or ``failed``; one table's failure does not stop the others.
    """

    def run(spec: DeleteSpec) -> tuple[str, int | None, str, str]:
        spark.sparkContext.setJobDescription(f"delete from {spec.table}")
        try:
            n = delete_from(spark, spec.path, spec.pred, spec.real_delete, spec.schema)
            return spec.table, n, "ok", ""
        except Exception as e:
            message = str(e).strip().splitlines() or [type(e).__name__]
            return spec.table, None, "failed", message[0]

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(run), specs))
    return spark.createDataFrame(
        rows, "table_name string, n_deleted long, status string, message string"
    )
