"""

Each query stands next to the SQL that must give the same rows. Queries that write put their
files in the session's shared folder and return a frame over what they read back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablehaul import functions as tf
from tablehaul import operators as ops
from tablehaul.plans import (
    delete_counts,
    delete_from,
    delete_many,
    export_details,
    export_frame,
    export_summary,
    export_tables,
    exported_files,
    null_rows,
    sent_count_sum,
)
from tablehaul.sinks import ParquetOptions, read_written, write_table, written_row_count
from tablehaul.sinks.layout import marker_uri, trigger_uri
from tablehaul.sources import (
    file_row_counts,
    key_columns,
    leaf_paths,
    listed_files,
    row_count,
    scan_dir,
    scan_table,
    with_keys,
)
from tablehaul.sources.files import exists, fresh_folder
from tablehaul.specs import DeleteSpec, ExportSpec, delete_specs, export_specs

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Fixed "today" of the test data, never the clock.
EVENTS_TODAY = date(2024, 1, 31)
LINEITEM_TODAY = date(2001, 11, 5)

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str, **scan) -> DataFrame:
    return scan_table(spark, table_file(sf_dir, name), **scan)


def table_file(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def epoch_ms(c: Column) -> Column:
    """Epoch milliseconds of a zone-less timestamp read as UTC, whatever the session zone."""
    days = F.unix_date(c.cast("date")).cast("long")
    minutes = F.hour(c) * 60 + F.minute(c)
    millis = F.floor(F.date_part(F.lit("SECOND"), c) * 1000)
    return (days * 86_400_000 + minutes * 60_000 + millis).cast("long")


def with_system_columns(df: DataFrame, changed: str) -> DataFrame:
    """Give a test table the bookkeeping columns of a source table."""
    return df.select(
        "*",
        F.lit("false").alias("_DELETED_"),
        F.lit("grid-1").alias("_INST_"),
        F.lit("loader").alias("_INSUN_"),
        epoch_ms(F.col(changed)).alias("_UPT_"),
        F.lit("loader").alias("_UPUN_"),
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


# ---- scans and sources ----------------------------------------------------------------


@query(
    "scan_table",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_returnflag = 'R'""",
)
def q_scan_table(spark, sf_dir):
    return table(
        spark,
        sf_dir,
        "lineitem",
        columns="l_orderkey, l_linenumber, l_quantity",
        where=ops.all_of(("l_shipdate", ">=", "1998-01-01"), ("l_returnflag", "=", "R")),
    )


@query(
    "scan_dir",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus FROM lineitem",
)
def q_scan_dir(spark, sf_dir):
    return scan_dir(spark, sf_dir, "LineItem.PARQUET").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus"
    )


def two_versions(spark, sf_dir, name: str) -> str:
    """Orders in a folder of two writes, the second with a column the first lacks."""
    uri = fresh_folder(spark, name)
    orders = table(spark, sf_dir, "orders")
    early = F.col("o_orderkey") % 2 == 0
    orders.where(early).drop("o_orderpriority").write.parquet(uri)
    orders.where(~early).write.mode("append").parquet(uri)
    return uri


TWO_VERSIONS = """SELECT * REPLACE (
    CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
) FROM orders"""


@query("scan_mixed_columns", TWO_VERSIONS)
def q_scan_mixed_columns(spark, sf_dir):
    """A folder of many files, some without a column."""
    return scan_dir(spark, two_versions(spark, sf_dir, "mixed-scan"), ".PARQUET")


@query("export_mixed_columns", TWO_VERSIONS)
def q_export_mixed_columns(spark, sf_dir):
    spec = ExportSpec(
        "orders", two_versions(spark, sf_dir, "mixed"), fresh_folder(spark, "mixed-out"), values="typed"
    )
    report = export_tables(spark, [spec]).first()
    if report.status != "ok":
        raise RuntimeError(report.message)
    return scan_table(spark, spec.target)


@query(
    "delete_late_column",
    f"SELECT * FROM ({TWO_VERSIONS}) WHERE (o_orderpriority = '1-URGENT') IS NOT TRUE",
)
def q_delete_late_column(spark, sf_dir):
    uri = two_versions(spark, sf_dir, "late")
    delete_from(spark, uri, ("o_orderpriority", "=", "1-URGENT"))
    return scan_table(spark, uri)


@query("export_given_schema", f"SELECT o_orderkey, o_orderpriority FROM ({TWO_VERSIONS}) WHERE o_orderkey > 100")
def q_export_given_schema(spark, sf_dir):
    """The columns of a source as they are given; no footer is asked for them."""
    uri = two_versions(spark, sf_dir, "given")
    schema = "o_orderkey long, o_orderpriority string"
    spec = ExportSpec(
        "orders", uri, "unused", values="typed", where=("o_orderkey", ">", 100), schema=StructType.fromDDL(schema)
    )
    return export_frame(spark, spec)


@query(
    "delete_given_schema",
    """SELECT * EXCLUDE (o_orderpriority) FROM orders
       WHERE NOT (o_orderstatus = 'F' AND o_totalprice > 100000)""",
)
def q_delete_given_schema(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").drop("o_orderpriority")
    uri = copied(spark, orders, "given-delete")
    where = ops.all_of(("o_orderstatus", "=", "F"), ("o_totalprice", ">", 100000))
    report = delete_many(spark, [DeleteSpec("orders", uri, where, schema=orders.schema)]).first()
    if report.status != "ok":
        raise RuntimeError(report.message)
    return spark.read.schema(orders.schema).parquet(uri)


@query(
    "key_columns",
    """SELECT 'o_orderkey' AS column_name, count(o_orderkey) AS n_filled FROM orders
       UNION ALL SELECT 'o_custkey', count(o_custkey) FROM orders""",
)
def q_key_columns(spark, sf_dir):
    """Key columns read from the footers of a written copy."""
    uri = fresh_folder(spark, "keys")
    write_table(with_keys(table(spark, sf_dir, "orders"), "o_orderkey, o_custkey"), uri)
    copy = scan_table(spark, uri)
    return filled(copy, key_columns(copy))


def filled(df: DataFrame, names: list[str]) -> DataFrame:
    """Cells that are not null, per column."""
    counts = df.agg(*[F.count(F.col(n)).alias(n) for n in names])
    return counts.unpivot([], names, "column_name", "n_filled")


@query(
    "leaf_columns",
    """SELECT 'event_id' AS column_name, count(event_id) AS n_filled FROM events
       UNION ALL SELECT 'who.user_id', count(user_id) FROM events
       UNION ALL SELECT 'who.event_type', count(event_type) FROM events""",
)
def q_leaf_columns(spark, sf_dir):
    """Leaf columns of a written copy with a nested one."""
    uri = fresh_folder(spark, "leaves")
    events = table(spark, sf_dir, "events")
    write_table(events.select("event_id", F.struct("user_id", "event_type").alias("who")), uri)
    copy = scan_table(spark, uri)
    leaves = [".".join(path) for path in leaf_paths(copy)]
    counts = copy.agg(*[F.count(F.col(n)).alias(n.replace(".", "/")) for n in leaves])
    rows = counts.unpivot([], [f"`{n.replace('.', '/')}`" for n in leaves], "column_name", "n_filled")
    return rows.withColumn("column_name", F.replace("column_name", F.lit("/"), F.lit(".")))


@query(
    "table_row_count",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES
    ),
)
def q_table_row_count(spark, sf_dir):
    return union_all(
        [
            row_count(table(spark, sf_dir, t)).select(F.lit(t).alias("table_name"), "n_rows")
            for t in TABLES
        ]
    )


@query(
    "file_row_counts",
    " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS file_name, count(*) AS n_rows FROM {t}" for t in TABLES
    ),
)
def q_file_row_counts(spark, sf_dir):
    return union_all(
        [
            file_row_counts(table(spark, sf_dir, t)).select(
                F.substring_index("file_path", "/", -1).alias("file_name"), "n_rows"
            )
            for t in TABLES
        ]
    )


@query(
    "file_row_counts_empty",
    "SELECT count(*) AS n_rows, true AS has_bytes FROM orders UNION ALL SELECT 0, true FROM region WHERE r_regionkey = 0",
)
def q_file_row_counts_empty(spark, sf_dir):
    """A folder with a file that has no rows."""
    uri = fresh_folder(spark, "with-empty")
    orders = table(spark, sf_dir, "orders").coalesce(1)
    orders.write.parquet(uri)
    orders.limit(0).write.mode("append").parquet(uri)
    counts = file_row_counts(scan_table(spark, uri), listed_files(spark, uri))
    return counts.select("n_rows", (F.col("size_bytes") > 0).alias("has_bytes"))


# ---- projections ----------------------------------------------------------------------


@query("project_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def q_project_columns(spark, sf_dir):
    return ops.project(table(spark, sf_dir, "orders"), "o_orderkey, o_custkey, o_totalprice")


@query("drop_system_columns", "SELECT * FROM orders")
def q_drop_system_columns(spark, sf_dir):
    return ops.project(with_system_columns(table(spark, sf_dir, "orders"), "o_orderdate"))


@query("drop_named_columns", "SELECT * EXCLUDE (l_tax, l_discount) FROM lineitem")
def q_drop_named_columns(spark, sf_dir):
    return ops.project(table(spark, sf_dir, "lineitem"), skip=" l_tax , l_discount,L_QUANTITY")


@query(
    "rename_columns",
    """SELECT * RENAME (l_orderkey AS order_key, l_linenumber AS order_line_no)
       FROM lineitem""",
)
def q_rename_columns(spark, sf_dir):
    return ops.rename(
        table(spark, sf_dir, "lineitem"),
        "l_orderkey:order_key, l_linenumber:order_line_no, absent:x,",
    )


@query("stringify_columns", "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM lineitem")
def q_stringify_columns(spark, sf_dir):
    return ops.stringify(table(spark, sf_dir, "lineitem"))


@query(
    "stringify_null_text",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
              coalesce(nullif(o_orderpriority, '5-LOW'), 'null') AS o_orderpriority
       FROM orders""",
)
def q_stringify_null_text(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority")
    )
    return ops.stringify(orders, null_text="null")


@query("binary_to_text", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents")
def q_binary_to_text(spark, sf_dir):
    documents = table(spark, sf_dir, "documents", columns="doc_id, text")
    return ops.stringify(ops.stringify(documents, binary=True))


@query(
    "nested_to_json",
    """SELECT event_id,
              CAST(to_json({'user_id': user_id, 'event_type': event_type,
                            'inner': {'props': props}}) AS VARCHAR) AS as_struct,
              CAST(to_json(MAP([user_id], [event_type])) AS VARCHAR) AS as_map,
              CAST(to_json([user_id, event_id]) AS VARCHAR) AS as_list,
              CAST(to_json([MAP([event_id], [{'u': user_id}])]) AS VARCHAR) AS as_mixed
       FROM events""",
)
def q_nested_to_json(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return ops.nested_to_json(
        events.select(
            "event_id",
            F.struct("user_id", "event_type", F.struct("props").alias("inner")).alias(
                "as_struct"
            ),
            F.create_map("user_id", "event_type").alias("as_map"),
            F.array("user_id", "event_id").alias("as_list"),
            F.array(F.create_map("event_id", F.struct(F.col("user_id").alias("u")))).alias(
                "as_mixed"
            ),
        )
    )


@query(
    "nested_array_json",
    """SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
              CAST(unnest(embedding) AS DOUBLE) AS value
       FROM embeddings""",
)
def q_nested_array_json(spark, sf_dir):
    text = ops.nested_to_json(table(spark, sf_dir, "embeddings"), "embedding")
    back = F.from_json("embedding", "array<float>")
    return text.select("vec_id", F.posexplode(back).alias("pos", "value")).select(
        "vec_id", "pos", F.col("value").cast("double").alias("value")
    )


# ---- filters --------------------------------------------------------------------------


@query("filter_all", "SELECT * FROM orders")
def q_filter_all(spark, sf_dir):
    return table(spark, sf_dir, "orders", where="*:*")


@query("filter_eq", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def q_filter_eq(spark, sf_dir):
    return table(
        spark,
        sf_dir,
        "orders",
        columns="o_orderkey,o_orderstatus",
        where=("o_orderstatus", "=", "F"),
    )


@query(
    "filter_gt_ge",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_quantity > 30 AND l_linenumber >= 3""",
)
def q_filter_gt_ge(spark, sf_dir):
    return table(
        spark,
        sf_dir,
        "lineitem",
        columns="l_orderkey,l_linenumber,l_quantity",
        where=ops.all_of(("l_quantity", ">", 30), ("l_linenumber", ">=", 3)),
    )


@query(
    "filter_lt_le",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_quantity < 10 AND l_linenumber <= 3""",
)
def q_filter_lt_le(spark, sf_dir):
    return table(
        spark,
        sf_dir,
        "lineitem",
        columns="l_orderkey,l_linenumber,l_quantity",
        where=ops.all_of(("l_quantity", "<", 10), ("l_linenumber", "<=", 3)),
    )


@query(
    "filter_and",
    """SELECT * FROM lineitem
       WHERE l_returnflag = 'A' AND l_quantity > 25 AND l_shipdate < TIMESTAMP '1999-06-01'""",
)
def q_filter_and(spark, sf_dir):
    return table(
        spark,
        sf_dir,
        "lineitem",
        where=(
            "and",
            ("l_returnflag", "=", "A"),
            ("l_quantity", ">", 25),
            ("l_shipdate", "<", datetime(1999, 6, 1).isoformat(" ")),
        ),
    )


@query(
    "filter_or",
    """SELECT * FROM orders
       WHERE o_orderstatus = 'P' OR o_totalprice >= 200000
          OR (o_totalprice < 20000 AND o_orderpriority = '1-URGENT')""",
)
def q_filter_or(spark, sf_dir):
    return table(
        spark,
        sf_dir,
        "orders",
        where=(
            "or",
            ("o_orderstatus", "=", "P"),
            ("o_totalprice", ">=", 200000),
            ("and", ("o_totalprice", "<", 20000), ("o_orderpriority", "=", "1-URGENT")),
        ),
    )


@query(
    "filter_text_order",
    "SELECT o_orderkey, o_custkey FROM orders WHERE CAST(o_custkey AS VARCHAR) >= '5'",
)
def q_filter_text_order(spark, sf_dir):
    orders = table(spark, sf_dir, "orders", columns="o_orderkey,o_custkey")
    return orders.where(ops.predicate(("o_custkey", ">=", "'5'"), as_text=True))


@query(
    "filter_mixed_literals",
    """SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem
       WHERE l_orderkey > 10.5 AND l_linenumber >= 1.5 AND l_linenumber < 5.5
         AND l_returnflag <> '5' AND CAST(l_quantity AS DECIMAL(12, 2)) > 20.005
         AND l_shipdate >= TIMESTAMP '1996-01-01'
         AND CAST(l_shipdate AS DATE) < TIMESTAMP '2001-06-05 12:00:00'
         AND CAST(l_shipdate AS DATE) >= TIMESTAMP '1996-03-01 00:00:01'
         AND CAST(l_shipdate AS DATE) <> DATE '1996-05-05'""",
)
def q_filter_mixed_literals(spark, sf_dir):
    """Floats on whole numbers, text on a number, a number on text, decimals, a date, and texts with
    and without a time on a column of dates."""
    lineitem = table(spark, sf_dir, "lineitem")
    lineitem = lineitem.withColumn("quantity", F.col("l_quantity").cast("decimal(12,2)"))
    lineitem = lineitem.withColumn("day", F.col("l_shipdate").cast("date"))
    where = ops.all_of(
        ("l_orderkey", ">", 10.5),
        ("l_linenumber", ">=", "1.5"),
        ("l_linenumber", "<", 5.5),
        ops.any_of(("l_returnflag", ">", 5), ("l_returnflag", "<", 5)),
        ("quantity", ">", "20.005"),
        ("l_shipdate", ">=", date(1996, 1, 1)),
        ("day", "<", "2001-06-05 12:00:00"),
        ("day", ">=", "1996-03-01T00:00:01"),
        ops.any_of(("day", "<", "1996-05-05"), ("day", ">", "1996-05-05 00:00:00")),
    )
    kept = lineitem.where(ops.predicate(where, lineitem.schema))
    return kept.select("l_orderkey", "l_linenumber", "l_returnflag")


def dated_orders(spark, sf_dir) -> DataFrame:
    """A written table whose dates are text, as a source table has them."""
    uri = fresh_folder(spark, "dated")
    table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("odate")
    ).write.parquet(uri)
    return scan_table(spark, uri)


@query(
    "days_back_date",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS odate FROM orders
       WHERE strftime(o_orderdate, '%Y%m%d') >= '20010507'""",
)
def q_days_back_date(spark, sf_dir):
    days = (LINEITEM_TODAY - date(2001, 5, 7)).days
    return dated_orders(spark, sf_dir).where(tf.days_back("odate", days, LINEITEM_TODAY))


@query(
    "days_back_today_only",
    """SELECT o_orderkey, o_orderdate FROM orders
       WHERE o_orderdate >= TIMESTAMP '1999-01-10' AND o_orderdate < TIMESTAMP '1999-01-11'""",
)
def q_days_back_today_only(spark, sf_dir):
    orders = table(spark, sf_dir, "orders", columns="o_orderkey, o_orderdate")
    return orders.where(tf.days_back("o_orderdate", 0, date(1999, 1, 10), "time"))


@query(
    "days_back_update_time",
    """SELECT event_id, epoch_us(ts) // 1000 AS "_UPT_" FROM events
       WHERE epoch_us(ts) // 1000 >= 1706054400000""",
)
def q_days_back_update_time(spark, sf_dir):
    uri = fresh_folder(spark, "epoch")
    with_system_columns(table(spark, sf_dir, "events"), "ts").write.parquet(uri)
    events = scan_table(spark, uri)
    return events.where(tf.days_back("_UPT_", 7, EVENTS_TODAY)).select("event_id", "_UPT_")


@query(
    "days_back_and_query",
    """SELECT event_id, event_type FROM events
       WHERE (event_type = 'error' OR value > 50) AND ts >= TIMESTAMP '2024-01-21'""",
)
def q_days_back_and_query(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    wanted = ops.any_of(("event_type", "=", "error"), ("value", ">", 50))
    criterion = tf.days_back("ts", 10, EVENTS_TODAY, "time")
    return events.where(ops.predicate(wanted, events.schema) & criterion).select(
        "event_id", "event_type"
    )


# ---- aggregations and reports ---------------------------------------------------------


@query(
    "sent_count_sum",
    """SELECT 'lineitem' AS table_name, count(*) AS n FROM lineitem
       UNION ALL SELECT 'part', count(*) FROM part""",
)
def q_sent_count_sum(spark, sf_dir):
    """``l_suppkey % 4`` stands in for the server that sends a row."""

    def sent(name: str, key: str) -> DataFrame:
        df = table(spark, sf_dir, name)
        return df.groupBy(
            F.lit(name).alias("table_name"), (F.col(key) % 4).alias("server")
        ).agg(F.count(F.lit(1)).alias("n"))

    return sent_count_sum(sent("lineitem", "l_suppkey").unionAll(sent("part", "p_partkey")))


@query(
    "delete_counts",
    """SELECT 'lineitem' AS table_name,
              count(*) FILTER (WHERE l_returnflag = 'R') AS n_deleted FROM lineitem
       UNION ALL SELECT 'events', count(*) FILTER (WHERE ts <= TIMESTAMP '2024-01-16')
       FROM events
       UNION ALL SELECT 'region', count(*) FROM region""",
)
def q_delete_counts(spark, sf_dir):
    events = with_system_columns(table(spark, sf_dir, "events"), "ts")
    return delete_counts(
        {
            "lineitem": (table(spark, sf_dir, "lineitem"), ("l_returnflag", "=", "R")),
            "events": (events, ops.older_than(15, datetime(2024, 1, 31))),
            "region": (table(spark, sf_dir, "region"), None),
        }
    )


def exported_details(spark, sf_dir) -> DataFrame:
    frames = []
    for name in ("orders", "lineitem"):
        uri = fresh_folder(spark, f"details-{name}")
        write_table(table(spark, sf_dir, name), uri)
        frames.append(export_details(spark.read.parquet(uri), name, uri, cost_ms=90_000))
    return union_all(frames)


@query(
    "export_details",
    """SELECT 'orders' AS table_name, count(*) AS n_rows, true AS sizes_agree,
              CAST(1.5 AS DOUBLE) AS cost_min FROM orders
       UNION ALL SELECT 'lineitem', count(*), true, 1.5 FROM lineitem""",
)
def q_export_details(spark, sf_dir):
    """File names and sizes depend on the machine, so only what must hold is compared."""
    agree = (F.col("size_bytes") > 0) & (F.col("size_mb") * 1048576 == F.col("size_bytes"))
    return (
        exported_details(spark, sf_dir)
        .groupBy("table_name")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.every(agree).alias("sizes_agree"),
            F.max("cost_min").alias("cost_min"),
        )
    )


@query(
    "report_summary",
    """SELECT 'orders' AS table_name, count(*) AS n_rows, 'o_orderkey' AS "keys",
              CAST(90000 AS BIGINT) AS cost_ms FROM orders
       UNION ALL SELECT 'lineitem', count(*), 'l_orderkey,l_linenumber', 90000
       FROM lineitem""",
)
def q_report_summary(spark, sf_dir):
    keys = {"orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"]}
    summary = export_summary(exported_details(spark, sf_dir), keys)
    return summary.select("table_name", "n_rows", "keys", "cost_ms")


# ---- scalar functions -----------------------------------------------------------------


@query(
    "fn_strip_quotes",
    """SELECT doc_id, replace('''' || text || '''', '''', '') AS text FROM documents""",
)
def q_fn_strip_quotes(spark, sf_dir):
    quoted = F.concat(F.lit("'"), "text", F.lit("'"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", tf.strip_quotes(quoted).alias("text")
    )


def customer_paths(spark, sf_dir) -> DataFrame:
    path = F.concat(F.lit("/"), "c_mktsegment", F.lit("/"), "c_name", F.lit("/"))
    return table(spark, sf_dir, "customer").select("c_custkey", path.alias("path"))


@query(
    "fn_table_path",
    """SELECT c_custkey, trim('/' || c_mktsegment || '/' || c_name || '/', '/') AS path
       FROM customer""",
)
def q_fn_table_path(spark, sf_dir):
    return customer_paths(spark, sf_dir).select(
        "c_custkey", tf.table_path(F.col("path")).alias("path")
    )


@query(
    "fn_file_stem",
    "SELECT c_custkey, c_mktsegment || '_' || c_name AS stem FROM customer",
)
def q_fn_file_stem(spark, sf_dir):
    return customer_paths(spark, sf_dir).select(
        "c_custkey", tf.file_stem(F.col("path")).alias("stem")
    )


@query(
    "fn_units",
    """SELECT doc_id, CAST(n_chars AS DOUBLE) / 1024 / 1024 AS mb,
              CAST(n_chars AS DOUBLE) / 1000 / 60 AS mins FROM documents""",
)
def q_fn_units(spark, sf_dir):
    size = F.col("n_chars")
    return table(spark, sf_dir, "documents").select(
        "doc_id", tf.bytes_to_mb(size).alias("mb"), tf.ms_to_min(size).alias("mins")
    )


@query(
    "pipe_lines",
    """SELECT concat_ws('|', c_custkey, coalesce(c_name, ''),
                        coalesce(nullif(c_mktsegment, 'BUILDING'), ''), c_nationkey) AS line
       FROM customer""",
)
def q_pipe_lines(spark, sf_dir):
    return ops.pipe_lines(
        table(spark, sf_dir, "customer").select(
            "c_custkey",
            "c_name",
            F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"),
            "c_nationkey",
        )
    )


@query(
    "json_lines",
    """SELECT CASE WHEN event_type = 'error'
                   THEN CAST(to_json({'event_id': event_id, 'user_id': user_id,
                                      'props': props}) AS VARCHAR)
                   ELSE CAST(to_json({'event_id': event_id, 'user_id': user_id,
                                      'event_type': event_type, 'props': props})
                             AS VARCHAR) END AS line
       FROM events""",
)
def q_json_lines(spark, sf_dir):
    return ops.json_lines(
        table(spark, sf_dir, "events").select(
            "event_id",
            "user_id",
            F.nullif("event_type", F.lit("error")).alias("event_type"),
            "props",
        )
    )


# ---- sinks ----------------------------------------------------------------------------


@query("sink_parquet_roundtrip", "SELECT * FROM lineitem")
def q_sink_parquet_roundtrip(spark, sf_dir):
    uri = fresh_folder(spark, "parquet")
    write_table(table(spark, sf_dir, "lineitem"), uri)
    return read_written(spark, uri, "parquet")


@query(
    "sink_parquet_v1_binary_roundtrip",
    "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM documents",
)
def q_sink_parquet_v1_binary_roundtrip(spark, sf_dir):
    uri = fresh_folder(spark, "parquet-v1")
    text = ops.stringify(table(spark, sf_dir, "documents"), binary=True)
    write_table(text, uri, options=ParquetOptions(version="v1", dictionary=False))
    return ops.stringify(read_written(spark, uri, "parquet"))


@query(
    "sink_csv_roundtrip",
    "SELECT coalesce(CAST(COLUMNS(*) AS VARCHAR), '') FROM documents",
)
def q_sink_csv_roundtrip(spark, sf_dir):
    uri = fresh_folder(spark, "csv")
    documents = table(spark, sf_dir, "documents")
    write_table(documents, uri, "csv")
    text_columns = ", ".join(f"{c} string" for c in documents.columns)
    return read_written(spark, uri, "csv", text_columns).na.fill("")


@query("sink_json_roundtrip", "SELECT * FROM conversations")
def q_sink_json_roundtrip(spark, sf_dir):
    uri = fresh_folder(spark, "json")
    conversations = table(spark, sf_dir, "conversations")
    write_table(conversations, uri, "json")
    return read_written(spark, uri, "json", conversations.schema)


@query(
    "sink_pipe_roundtrip",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
              o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
              CAST(o_orderdate AS VARCHAR) AS o_orderdate,
              coalesce(nullif(o_orderpriority, '5-LOW'), '') AS o_orderpriority
       FROM orders""",
)
def q_sink_pipe_roundtrip(spark, sf_dir):
    uri = fresh_folder(spark, "pipe")
    priority = F.nullif("o_orderpriority", F.lit("5-LOW"))
    orders = table(spark, sf_dir, "orders").withColumn("o_orderpriority", priority)
    write_table(orders, uri, "pipe")
    cells = F.split("line", r"\|", -1)
    return read_written(spark, uri, "pipe").select(
        *[cells[i].alias(c) for i, c in enumerate(orders.columns)]
    )


@query(
    "max_rows_per_file",
    "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_over_limit FROM lineitem",
)
def q_max_rows_per_file(spark, sf_dir):
    """The limit is so small that even 40 tasks over the smallest data have to split."""
    uri = fresh_folder(spark, "limited")
    lineitem = table(spark, sf_dir, "lineitem")
    limit = 100
    write_table(lineitem, uri, max_rows=limit)
    return file_row_counts(spark.read.parquet(uri)).agg(
        F.sum("n_rows").alias("n_rows"),
        F.count_if(F.col("n_rows") > limit).alias("n_over_limit"),
    )


@query(
    "trigger_line",
    "SELECT 'SALES_ORDERS|20240131000000|' || count(*) AS line FROM orders",
)
def q_trigger_line(spark, sf_dir):
    return ops.trigger_line(table(spark, sf_dir, "orders"), "/sales/orders", "20240131000000")


# ---- validation and reconciliation ----------------------------------------------------


def orders_with_nulls(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
    )


@query(
    "null_cell_counts",
    """SELECT 'o_orderkey' AS column_name, count(*) FILTER (WHERE o_orderkey IS NULL) AS n_null
       FROM orders
       UNION ALL SELECT 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus = 'F')
       FROM orders
       UNION ALL SELECT 'o_orderpriority', count(*) FILTER (WHERE o_orderpriority = '5-LOW')
       FROM orders""",
)
def q_null_cell_counts(spark, sf_dir):
    return ops.null_cell_counts(orders_with_nulls(spark, sf_dir))


@query(
    "null_cell_rows",
    """SELECT o_orderkey, 'o_orderstatus' AS column_name FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, 'o_orderpriority' FROM orders
       WHERE o_orderpriority = '5-LOW'""",
)
def q_null_cell_rows(spark, sf_dir):
    return ops.null_cell_rows(orders_with_nulls(spark, sf_dir), "o_orderkey")


RECONCILED = ("orders", "lineitem", "events")


def named_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))


@query(
    "reconcile_counts",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, count(*) AS n_read, count(*) AS n_written,
                   count(*) AS n_sent, 'ok' AS status FROM {t}"""
        for t in RECONCILED
    ),
)
def q_reconcile_counts(spark, sf_dir):
    read, written = [], []
    for name, fmt in zip(RECONCILED, ("csv", "parquet", "json")):
        df = table(spark, sf_dir, name)
        uri = fresh_folder(spark, f"reconcile-{name}")
        write_table(df, uri, fmt)
        read.append(named_count(df, name))
        written.append(
            written_row_count(spark, uri, fmt, df).select(
                F.lit(name).alias("table_name"), F.col("n_rows").alias("n")
            )
        )
    reads = union_all(read)
    return ops.reconcile(reads, union_all(written), sent=reads)


@query(
    "reconcile_failures",
    """SELECT 'orders' AS table_name, count(*) AS n_read,
              count(*) FILTER (WHERE o_orderstatus = 'O') AS n_written, count(*) AS n_sent,
              'read_ne_written' AS status FROM orders
       UNION ALL SELECT 'lineitem', count(*), count(*), -1, 'missing' FROM lineitem
       UNION ALL SELECT 'events', count(*), count(*), count(*) + 1, 'sent_ne_read'
       FROM events""",
)
def q_reconcile_failures(spark, sf_dir):
    """Each table's counts are spoilt in one way, and each way has its status."""
    frames = {t: table(spark, sf_dir, t) for t in RECONCILED}
    counts = {t: named_count(df, t) for t, df in frames.items()}
    partly = named_count(frames["orders"].where("o_orderstatus = 'O'"), "orders")
    one_more = counts["events"].withColumn("n", F.col("n") + 1)
    return ops.reconcile(
        union_all(list(counts.values())),
        union_all([partly, counts["lineitem"], counts["events"]]),
        sent=union_all([counts["orders"], one_more]),
    ).na.fill({"n_sent": -1})


# ---- exports --------------------------------------------------------------------------


@query(
    "export_summary",
    " UNION ALL ".join(
        f"""SELECT 'store/{t}' AS table_name, count(*) AS n_read, count(*) AS n_written,
                   CAST(0 AS BIGINT) AS n_null_cells, 'ok' AS status FROM {t}"""
        for t in TABLES
    ),
)
def q_export_summary(spark, sf_dir):
    specs = export_specs(
        ";".join(f"store/{t}" for t in TABLES),
        lambda name: table_file(sf_dir, name.rpartition("/")[2]),
        fresh_folder(spark, "export"),
        marker=True,
    )
    return export_tables(spark, specs).select(
        "table_name", "n_read", "n_written", "n_null_cells", "status"
    )


@query(
    "export_formats",
    " UNION ALL ".join(
        f"""SELECT '{f}/documents' AS table_name, '{f}' AS format, count(*) AS n_read,
                   count(*) AS n_written, 'ok' AS status FROM documents"""
        for f in ("parquet", "csv", "json", "pipe")
    ),
)
def q_export_formats(spark, sf_dir):
    """Whole texts with line breaks, quotes and separators, counted again in every format."""
    root = fresh_folder(spark, "formats")
    specs = [
        ExportSpec(f"{f}/documents", table_file(sf_dir, "documents"), root, format=f)
        for f in ("parquet", "csv", "json", "pipe")
    ]
    return export_tables(spark, specs).select(
        "table_name", "format", "n_read", "n_written", "status"
    )


@query(
    "export_delta_pipe",
    """SELECT concat_ws('|', event_id, strftime(ts, '%Y%m%d'), user_id, event_type) AS line
       FROM events WHERE ts >= TIMESTAMP '2024-01-24' AND event_type >= 'click'""",
)
def q_export_delta_pipe(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyyMMdd"))
    spec = ExportSpec(
        table="/web/events",
        source=with_system_columns(events, "ts"),
        root=fresh_folder(spark, "delta"),
        format="pipe",
        env="test",
        delta_date="20240131",
        columns="event_id,day,user_id,event_type,_UPT_",
        rename="event_id:id",
        where=("event_type", ">=", "click"),
        days_back=("_UPT_", 7),
        today=EVENTS_TODAY,
        stamp="20240131000000",
    )
    report = export_tables(spark, [spec]).first()
    if report.status != "ok":
        raise RuntimeError(report.message)
    return read_written(spark, spec.target, "pipe")


@query(
    "export_option_lists",
    """SELECT 'store/orders' AS table_name,
              concat_ws('|', o_orderkey, strftime(o_orderdate, '%Y%m%d'), o_orderstatus) AS line
       FROM orders WHERE strftime(o_orderdate, '%Y%m%d') >= '20000101'
       UNION ALL
       SELECT 'store/part', concat_ws('|', p_partkey, p_name, p_type, p_size)
       FROM part WHERE p_size > 10""",
)
def q_export_option_lists(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    sources = {
        "store/orders": orders.withColumn("day", F.date_format("o_orderdate", "yyyyMMdd")),
        "store/part": table_file(sf_dir, "part"),
    }
    specs = export_specs(
        "store/orders;store/part",
        sources.__getitem__,
        fresh_folder(spark, "lists"),
        where=[None, ("p_size", ">", 10)],
        columns="o_orderkey,day,o_orderstatus;",
        skip=";p_brand, p_retailprice",
        rename="o_orderkey:order_key;p_partkey:part_key,p_name:name",
        days_back="day:674;",
        today=LINEITEM_TODAY,
        format="pipe",
    )
    failed = [r.message for r in export_tables(spark, specs).collect() if r.status != "ok"]
    if failed:
        raise RuntimeError(failed[0])
    return union_all(
        [
            read_written(spark, s.target, "pipe").select(
                F.lit(s.table).alias("table_name"), "line"
            )
            for s in specs
        ]
    )


@query(
    "export_csv_header",
    """SELECT * RENAME (doc_id AS id, n_chars AS "number of, chars")
       FROM (SELECT CAST(COLUMNS(* EXCLUDE lang) AS VARCHAR) FROM documents)""",
)
def q_export_csv_header(spark, sf_dir):
    """The columns are named by the header alone."""
    spec = ExportSpec(
        table="documents",
        source=table_file(sf_dir, "documents"),
        root=fresh_folder(spark, "header"),
        format="csv",
        skip="lang",
        rename={"doc_id": "id", "n_chars": "number of, chars"},
    )
    report = export_tables(spark, [spec]).first()
    if report.status != "ok":
        raise RuntimeError(report.message)
    return read_written(spark, spec.target, "csv")


@query(
    "export_verify_only",
    """SELECT 'orders' AS table_name, count(*) AS n_read, CAST(1 AS BIGINT) AS n_files,
              'ok' AS status, '' AS message
       FROM orders
       UNION ALL SELECT 'lineitem', count(*), 1, 'ok', '' FROM lineitem
       UNION ALL SELECT 'part', count(*), 1, 'failed',
                        '1 rows were sent but ' || count(*) || ' read' FROM part
       UNION ALL SELECT 'region', count(*) * 0 - 1, 0, 'failed',
                        'declared 1 columns, table has 2: not in the table [''r_area''], '
                        || 'not declared [''r_name'', ''r_regionkey'']' FROM region""",
)
def q_export_verify_only(spark, sf_dir):
    """Nothing is written; wrong row counts and wrong columns still fail."""
    expected = {"part": {"expected_rows": 1}, "region": {"declared_columns": ("r_area",)}}
    specs = [
        ExportSpec(t, sf_dir, convert=False, file_suffix=f"{t}.parquet", **expected.get(t, {}))
        for t in ("orders", "lineitem", "part", "region")
    ]
    report = export_tables(spark, specs).na.fill({"n_read": -1})
    return report.select("table_name", "n_read", "n_files", "status", "message")


@query(
    "export_dump_columns",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus FROM orders",
)
def q_export_dump_columns(spark, sf_dir):
    """A folder of dumped files carries the row key besides the usual system columns."""
    dump = fresh_folder(spark, "dump")
    orders = with_system_columns(table(spark, sf_dir, "orders"), "o_orderdate")
    orders = orders.withColumn("_PK_", F.col("o_orderkey").cast("string"))
    orders.drop("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority").write.parquet(dump)
    spec = ExportSpec("orders", dump, fresh_folder(spark, "dump-out"), file_suffix=".parquet")
    report = export_tables(spark, [spec]).first()
    if report.status != "ok":
        raise RuntimeError(report.message)
    return read_written(spark, spec.target, "parquet")


@query(
    "export_marker_state",
    """SELECT 'ok' AS run, count(*) AS n_rows, true AS marker, true AS trigger_row FROM orders
       UNION ALL SELECT 'failed', count(*), false, false FROM orders
       UNION ALL SELECT 'empty', count(*), false, false FROM orders""",
)
def q_export_marker_state(spark, sf_dir):
    """Marker and trigger row after a good run, and after a failed or empty one on top of it."""
    root, stamp = fresh_folder(spark, "marker"), "20240131000000"
    states = []
    for run, again in (("ok", {}), ("failed", {"expected_rows": -1}), ("empty", {"where": ("o_orderkey", "<", 0)})):
        good = ExportSpec(
            run, table_file(sf_dir, "orders"), root, format="pipe", marker=True, stamp=stamp
        )
        export_tables(spark, [good])
        if again:
            export_tables(spark, [replace(good, **again)])
        states.append(
            read_written(spark, good.target, "pipe").agg(
                F.lit(run).alias("run"),
                F.count(F.lit(1)).alias("n_rows"),
                F.lit(exists(spark, marker_uri(good.target, run))).alias("marker"),
                F.lit(exists(spark, trigger_uri(good.target, run, stamp))).alias("trigger_row"),
            )
        )
    return union_all(states)


@query(
    "export_file_details",
    """SELECT 'orders' AS table_name, count(*) AS n_rows, true AS each_has_size FROM orders
       UNION ALL SELECT 'part', count(*), true FROM part""",
)
def q_export_file_details(spark, sf_dir):
    """The files of two exports, one row each, added up again."""
    root = fresh_folder(spark, "files")
    specs = [
        ExportSpec(t, table_file(sf_dir, t), root, format=f, max_rows=1000)
        for t, f in (("orders", "parquet"), ("part", "pipe"))
    ]
    export_tables(spark, specs)
    return (
        exported_files(spark, specs)
        .groupBy("table_name")
        .agg(F.sum("n_rows").alias("n_rows"), F.min(F.col("size_bytes") > 0).alias("each_has_size"))
    )


@query(
    "export_null_rows",
    """SELECT o_orderkey AS order_key, 'status' AS column_name FROM orders
       WHERE o_orderstatus = 'F'""",
)
def q_export_null_rows(spark, sf_dir):
    """The keys behind the null cells of an export that would fail for them."""
    nulls = table(spark, sf_dir, "orders").withColumn(
        "o_orderstatus", F.nullif("o_orderstatus", F.lit("F"))
    )
    spec = ExportSpec(
        "orders",
        nulls,
        "unused",
        keys="o_orderkey",
        rename="o_orderkey:order_key,o_orderstatus:status",
        null_cells="fail",
    )
    return null_rows(spark, spec)


@query(
    "export_named",
    "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM supplier",
)
def q_export_named(spark, sf_dir):
    """The directory's name carries a prefix and a stamp."""
    root = fresh_folder(spark, "named")
    spec = ExportSpec(
        "sales/supplier", table_file(sf_dir, "supplier"), root, name_prefix="EU_", name_stamp="20240131"
    )
    export_tables(spark, [spec])
    return read_written(spark, f"{root}/sales/EU_supplier_20240131", "parquet")


@query("export_overwrite", "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM part WHERE p_size > 10")
def q_export_overwrite(spark, sf_dir):
    """A second run takes the place of the first."""
    root = fresh_folder(spark, "overwrite")
    for where in (None, ("p_size", ">", 10)):
        spec = ExportSpec("part", table_file(sf_dir, "part"), root, where=where)
        export_tables(spark, [spec])
    return read_written(spark, spec.target, "parquet")


@query(
    "export_checks",
    """SELECT 'declared' AS table_name, count(*) AS n_read, CAST(0 AS BIGINT) AS n_null_cells,
              'ok' AS status, '' AS message FROM orders
       UNION ALL
       SELECT 'sent', count(*), 0, 'failed',
              (count(*) + 1) || ' rows were sent but ' || count(*) || ' read' FROM orders
       UNION ALL
       SELECT 'warned', count(*), count(*) FILTER (WHERE o_orderstatus = 'F'), 'ok',
              'null cells: o_orderstatus ' || count(*) FILTER (WHERE o_orderstatus = 'F')
       FROM orders
       UNION ALL
       SELECT 'refused', count(*), count(*) FILTER (WHERE o_orderstatus = 'F'), 'failed',
              'null cells: o_orderstatus ' || count(*) FILTER (WHERE o_orderstatus = 'F')
       FROM orders""",
)
def q_export_checks(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    nulls = orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("F")))
    root = fresh_folder(spark, "checks")
    specs = [
        ExportSpec("declared", orders, root, declared_columns=tuple(orders.columns)),
        ExportSpec("sent", orders, root, expected_rows=orders.count() + 1),
        ExportSpec("warned", nulls, root, null_cells="warn"),
        ExportSpec("refused", nulls, root, null_cells="fail"),
    ]
    return export_tables(spark, specs).select(
        "table_name", "n_read", "n_null_cells", "status", "message"
    )


@query(
    "export_empty",
    """SELECT 'region' AS table_name, count(*) FILTER (WHERE r_regionkey < 0) AS n_read,
              CAST(0 AS BIGINT) AS n_files, 'empty' AS status FROM region
       UNION ALL SELECT 'orders', count(*) FILTER (WHERE o_orderkey < 0), 0, 'empty'
       FROM orders""",
)
def q_export_empty(spark, sf_dir):
    specs = export_specs(
        "region;orders",
        lambda t: table_file(sf_dir, t),
        fresh_folder(spark, "empty"),
        where=[("r_regionkey", "<", 0), ("o_orderkey", "<", 0)],
    )
    return export_tables(spark, specs).select("table_name", "n_read", "n_files", "status")


# ---- retention deletes ----------------------------------------------------------------


@query(
    "delete_by_filter",
    """SELECT * FROM (SELECT l_orderkey, l_linenumber, l_quantity,
                             nullif(l_returnflag, 'N') AS flag FROM lineitem)
       WHERE (flag = 'R' AND l_quantity > 20) IS NOT TRUE""",
)
def q_delete_by_filter(spark, sf_dir):
    """Rows without a flag are kept: the predicate is unknown for them."""
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.nullif("l_returnflag", F.lit("N")).alias("flag"),
    )
    return ops.retain(lineitem, ops.all_of(("flag", "=", "R"), ("l_quantity", ">", 20)))


@query(
    "delete_by_age",
    """SELECT l_orderkey, l_linenumber FROM lineitem
       WHERE l_shipdate > TIMESTAMP '2000-11-05'""",
)
def q_delete_by_age(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    old = ops.older_than(365, datetime(2001, 11, 5), "l_shipdate", "time")
    return ops.retain(lineitem, old).select("l_orderkey", "l_linenumber")


def copied(spark, df: DataFrame, name: str, *partitions: str) -> str:
    """A copy of a table to delete from."""
    uri = fresh_folder(spark, name)
    df.write.partitionBy(*partitions).parquet(uri)
    return uri


@query(
    "delete_rewrite",
    """SELECT * FROM lineitem
       WHERE NOT (l_shipdate < TIMESTAMP '1996-01-01' OR l_tax > 0.07)""",
)
def q_delete_rewrite(spark, sf_dir):
    uri = copied(spark, table(spark, sf_dir, "lineitem"), "rewrite")
    delete_from(spark, uri, ops.any_of(("l_shipdate", "<", "1996-01-01"), ("l_tax", ">", 0.07)))
    return spark.read.parquet(uri)


@query(
    "delete_partitioned",
    """SELECT * FROM orders
       WHERE NOT (o_orderstatus = 'F' OR (o_orderstatus = 'P' AND o_totalprice < 50000))""",
)
def q_delete_partitioned(spark, sf_dir):
    uri = copied(spark, table(spark, sf_dir, "orders"), "partitioned", "o_orderstatus")
    delete_from(
        spark,
        uri,
        (
            "or",
            ("o_orderstatus", "=", "F"),
            ("and", ("o_orderstatus", "=", "P"), ("o_totalprice", "<", 50000)),
        ),
    )
    return spark.read.parquet(uri)


@query(
    "delete_all",
    "SELECT count(*) AS n_deleted, CAST(0 AS BIGINT) AS n_rows FROM orders",
)
def q_delete_all(spark, sf_dir):
    uri = copied(spark, table(spark, sf_dir, "orders"), "all")
    n = delete_from(spark, uri, None)
    return row_count(spark.read.parquet(uri)).withColumn("n_deleted", F.lit(n).cast("long"))


@query(
    "delete_dry_run",
    """SELECT count(*) FILTER (WHERE o_totalprice >= 150000) AS n_deleted,
              count(*) AS n_rows FROM orders""",
)
def q_delete_dry_run(spark, sf_dir):
    path = table_file(sf_dir, "orders")
    n = delete_from(spark, path, ("o_totalprice", ">=", 150000), real_delete=False)
    return row_count(spark.read.parquet(path)).withColumn("n_deleted", F.lit(n).cast("long"))


@query(
    "delete_many",
    """SELECT 'orders' AS table_name,
              count(*) FILTER (WHERE o_orderdate <= TIMESTAMP '1999-11-05') AS n_deleted,
              'ok' AS status
       FROM orders
       UNION ALL SELECT 'part', count(*) FILTER (WHERE p_size > 25), 'ok' FROM part
       UNION ALL SELECT 'nation', count(*), 'ok' FROM nation""",
)
def q_delete_many(spark, sf_dir):
    orders = with_system_columns(table(spark, sf_dir, "orders"), "o_orderdate")
    paths = {
        "orders": copied(spark, orders, "many-orders"),
        "part": copied(spark, table(spark, sf_dir, "part"), "many-part"),
        "nation": copied(spark, table(spark, sf_dir, "nation"), "many-nation"),
    }
    specs = delete_specs(
        "orders;part;nation",
        paths.__getitem__,
        where=[None, ("p_size", ">", 25), None],
        delete_days="731;;",
        now=datetime(2001, 11, 5),
    )
    return delete_many(spark, specs).select("table_name", "n_deleted", "status")


# ---- contract -------------------------------------------------------------------------


@query(
    "flagship",
    """SELECT * RENAME (l_orderkey AS order_key) FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1999-11-05'""",
)
def flagship(spark, sf_dir):
    """Rows changed in the last two years, without system columns, renamed."""
    spec = ExportSpec(
        table="/sales/lineitem",
        source=with_system_columns(table(spark, sf_dir, "lineitem"), "l_shipdate"),
        root="unused",
        values="typed",
        days_back=("l_shipdate", 731),
        today=LINEITEM_TODAY,
        rename="l_orderkey:order_key",
    )
    return export_frame(spark, spec)


try:
    from tablehaul.llm.queries import QUERIES as LLM_QUERIES
    from tablehaul.llm.queries import SQL as LLM_SQL
except ImportError:  # that subpackage, or a library that only it needs, may be left out
    pass
else:
    _QUERIES.update(LLM_QUERIES)
    _SQL.update(LLM_SQL)
    try:
        import corpus_pipeline
    except ImportError:
        pass
    else:
        _QUERIES["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL is not None:
            _SQL["pipeline"] = corpus_pipeline.ORACLE_SQL


def entry(spark: SparkSession) -> DataFrame:
    """The flagship query on the smallest data set."""
    return flagship(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
