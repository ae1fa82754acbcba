"""What several operators share: words, crc folds, durable intermediate tables."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tablehaul.sources.files import fresh_folder

#: Separators of words, as characters of a regular-expression class.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it again.

    The rows are computed once and survive the loss of any executor.
    """
    uri = fresh_folder(df.sparkSession, name)
    df.write.parquet(uri)
    return df.sparkSession.read.schema(df.schema).parquet(uri)


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator works on, whatever else the table holds."""
    return df.select(
        F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("string").alias("text")
    )


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fold(id_col: Column, n: int) -> Column:
    """crc32 of the id's text modulo n; null ids give null."""
    return F.crc32(id_col.cast("string").cast("binary")) % F.lit(n)


@cache
def _packed() -> str:
    package = Path(__file__).resolve().parents[1]
    at = tempfile.mkdtemp(prefix="tablehaul-package-")
    return shutil.make_archive(f"{at}/tablehaul", "zip", package.parent, package.name)


_SENT: set[str] = set()


def map_arrow(df: DataFrame, fn: Callable, schema: T.StructType | str) -> DataFrame:
    """mapInArrow whose function may use this package on executors that have it not installed."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _SENT:
        context.addPyFile(_packed())
        _SENT.add(context.applicationId)
    return df.mapInArrow(fn, schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def map_texts(
    df: DataFrame,
    fn: Callable[[list[str | None]], dict[str, list]],
    fields: str,
    batches: int = 512,
) -> DataFrame:
    """Columns computed from each text, beside the id.

    ``df`` has the columns id and text. ``fn`` gets up to ``batches`` texts at a time and
    returns a list or Arrow array per field of the DDL string ``fields``.
    """
    schema = T.StructType([df.schema["id"], *T.StructType.fromDDL(fields).fields])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for part in parts:
            for start in range(0, part.num_rows, batches):
                piece = part.slice(start, batches)
                made = fn(piece.column("text").to_pylist())
                ids = piece.column("id").cast(arrow.field(0).type)
                arrays = [_array(made[f.name], f.type) for f in list(arrow)[1:]]
                yield pa.RecordBatch.from_arrays([ids, *arrays], schema=arrow)

    return map_arrow(df, run, schema)


def filter_texts(
    df: DataFrame, text_col: str, keep: Callable[[list[str | None]], list[bool]], batches: int = 512
) -> DataFrame:
    """The rows, with all their columns, whose text ``keep`` says yes to."""
    at = df.columns.index(text_col)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start in range(0, part.num_rows, batches):
                piece = part.slice(start, batches)
                yield piece.filter(pa.array(keep(piece.column(at).to_pylist()), pa.bool_()))

    return map_arrow(df, run, df.schema)


def ranked(df: DataFrame, by: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """The frame with each row's place, from 1, among the rows that agree in ``by``.

    ``order`` names columns, nulls first; equal rows take turns. The rows are dealt out by range, so that a
    group, however large, lies in as many chunks as it fills, is numbered in each, and the
    chunks' totals, a row for each, say where the numbers of the next begin.
    """
    row, chunk, before = (free_name(df, c) for c in ("row", "chunk", "before"))
    places = [*by, *order, row]
    dealt = df.withColumn(row, F.monotonically_increasing_id()).repartitionByRange(*places)
    dealt = durable(dealt.withColumn(chunk, F.spark_partition_id()), "ranked")
    n = free_name(df, "n")
    totals = dealt.groupBy(*by, chunk).agg(F.count("*").alias(n))
    earlier = Window.partitionBy(*by).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn(before, F.sum(n).over(earlier)).where(F.col(before) > 0).drop(n)
    totals = durable(totals, "ranked-totals")
    within = F.row_number().over(Window.partitionBy(*by, chunk).orderBy(*order, row))
    numbered = dealt.withColumn(name, within)
    same = [numbered[c].eqNullSafe(totals[c]) for c in (*by, chunk)]
    joined = numbered.join(totals, same, "left").select(*[numbered[c] for c in numbered.columns], before)
    return joined.withColumn(name, F.col(name) + F.coalesce(before, F.lit(0))).drop(row, chunk, before)


def row_key(df: DataFrame, id_col: str, text_col: str) -> Column:
    """Tells rows apart that share an id: the id and a hash of the text."""
    return F.struct(
        F.col(quoted(id_col)).alias("id"), F.xxhash64(F.col(quoted(text_col))).alias("text_hash")
    )


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_key(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """The frame with its row key in a new column, and that column's name."""
    name = free_name(df, "row_key")
    return df.withColumn(name, row_key(df, id_col, text_col)), name


def one_of_each(df: DataFrame, decisions: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows whose key is kept, one of each.

    ``decisions`` has a row per row of ``df`` with its row key ``id`` and ``kept``. Rows that agree
    in id and text are one document, of which one row stays.
    """
    keyed, name = with_row_key(df, id_col, text_col)
    keys = durable(
        decisions.groupBy("id").agg(F.max("kept").alias("kept"), F.count("*").alias("n")), "row-keys"
    ).withColumnRenamed("id", name)
    out = keyed.join(keys.where("NOT kept").select(name), name, "left_anti")
    repeated = keys.where("kept AND n > 1").select(name)
    if not repeated.isEmpty():
        once = out.join(repeated, name, "left_semi").dropDuplicates([name])
        out = out.join(repeated, name, "left_anti").unionByName(once)
    return out.select(*[F.col(quoted(c)) for c in df.columns])
