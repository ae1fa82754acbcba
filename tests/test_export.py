import os
from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tablehaul import ExportSpec, export_specs
from tablehaul.plans import export_frame, export_tables
from tablehaul.sinks import read_written, written_row_count
from tablehaul.sinks import writers
from tablehaul.sources import key_columns
from tablehaul.specs import broadcast_option, days_back_option
from tests.conftest import SF, pushed_filters, table


def source(name):
    return f"{SF}/{name}.parquet"


def run(spark, *specs):
    return {r.table_name: r for r in export_tables(spark, specs).collect()}


def test_export_writes_text_checks_and_marks(spark, uri):
    spec = ExportSpec(
        "/g/orders",
        source("orders"),
        uri("out"),
        env="test",
        keys="o_orderkey",
        rename="o_orderkey:order_key",
        marker=True,
        max_rows=600,
        expected_rows=1500,
    )
    row = run(spark, spec)["/g/orders"]
    assert (row.status, row.n_read, row.n_written, row.n_files) == ("ok", 1500, 1500, 3)
    assert row.keys == "order_key" and row.n_null_cells == 0
    assert row.size_mb == row.size_bytes / 1048576 > 0
    assert row.target_path == uri("out") + "/test/full-data/g/orders"
    assert (Path(row.target_path) / "_g_orders_completed").exists()
    back = spark.read.parquet(row.target_path)
    assert set(dict(back.dtypes).values()) == {"string"} and back.count() == 1500
    assert key_columns(back) == ["order_key"]


def test_binary_and_typed_values(spark, uri):
    specs = [
        ExportSpec(v, source("nation"), uri("out"), values=v) for v in ("binary", "typed")
    ]
    run(spark, *specs)
    assert dict(spark.read.parquet(uri("out/binary")).dtypes)["n_nationkey"] == "binary"
    assert spark.read.parquet(uri("out/typed")).dtypes == table(spark, "nation").dtypes


@pytest.fixture
def with_nulls(spark):
    return spark.createDataFrame([(1, "a", None), (2, None, None)], "id int, a string, b int")


def test_null_cells_fail_warn_or_pass(spark, uri, with_nulls):
    got = run(
        spark,
        *[
            ExportSpec(p, with_nulls, uri("out"), null_cells=p, marker=True)
            for p in ("fail", "warn", "ignore")
        ],
        ExportSpec("csv", with_nulls, uri("out"), format="csv"),
    )
    assert got["fail"].status == "failed" and got["fail"].message == "null cells: a 1, b 2"
    assert got["warn"].status == "ok" and got["warn"].n_null_cells == 3
    assert got["ignore"].message == "" and got["ignore"].n_null_cells is None
    assert got["csv"].status == "ok"
    assert not list(Path(uri("out/fail")).glob("_fail_completed"))
    assert list(Path(uri("out/warn")).glob("_warn_completed"))


def test_null_text(spark, uri, with_nulls):
    got = run(spark, ExportSpec("t", with_nulls, uri("out"), null_text="null"))["t"]
    assert got.n_null_cells == 3
    rows = sorted(map(tuple, spark.read.parquet(got.target_path).collect()))
    assert rows == [("1", "a", "null"), ("2", "null", "null")]


def test_wrong_counts_fail(spark, uri, monkeypatch):
    short = ExportSpec("short", source("nation"), uri("out"), expected_rows=26, marker=True)
    assert "26 rows were sent but 25 read" in run(spark, short)["short"].message
    write = writers.FORMATS["parquet"]

    def lose_rows(df, *args):
        write(df, *args)
        spark.read.parquet(args[0]).limit(20).write.parquet(uri("part"))
        write(spark.read.parquet(uri("part")), *args[:-1], "overwrite")

    monkeypatch.setitem(writers.FORMATS, "parquet", lose_rows)
    lost = ExportSpec("lost", source("nation"), uri("out"), marker=True)
    row = run(spark, lost)["lost"]
    assert (row.status, row.message) == ("failed", "read 25 rows but wrote 20")
    assert not list(Path(uri("out")).rglob("*_completed"))


def test_empty_export_leaves_the_target_alone(spark, uri):
    full = ExportSpec("t", source("region"), uri("out"), marker=True)
    none = ExportSpec("t", source("region"), uri("out"), where=("r_regionkey", "<", 0))
    run(spark, full)
    row = run(spark, none)["t"]
    assert (row.status, row.n_read, row.n_files) == ("empty", 0, 0)
    assert spark.read.parquet(uri("out/t")).count() == 5


def test_one_failure_does_not_stop_the_others(spark, uri):
    got = run(
        spark,
        ExportSpec("bad", source("region"), uri("out"), columns="nope"),
        ExportSpec("declared", source("region"), uri("out"), declared_columns=("r_name",)),
        ExportSpec("keyless", source("region"), uri("out"), keys="r_key"),
        ExportSpec("good", source("region"), uri("out")),
    )
    assert {t: r.status for t, r in got.items()} == {
        "bad": "failed",
        "keyless": "failed",
        "declared": "failed",
        "good": "ok",
    }
    assert "nope" in got["bad"].message and "r_regionkey" in got["declared"].message


def test_paths_are_checked_before_anything_is_written(spark, uri):
    good = ExportSpec("good", source("region"), uri("out"))
    with pytest.raises(ValueError, match="no table absent"):
        export_tables(spark, [good, ExportSpec("absent", uri("absent"), uri("out"))])
    with pytest.raises(ValueError, match="overlaps"):
        export_tables(spark, [good, ExportSpec("good/x", source("region"), uri("out"))])
    assert not Path(uri("out")).exists()
    table(spark, "region").write.parquet(uri("src/t"))
    with pytest.raises(ValueError, match="overlaps"):
        export_tables(spark, [ExportSpec("t", uri("src/t"), uri("src"))])
    with pytest.raises(ValueError, match="read from a target"):
        export_tables(spark, [ExportSpec("t", spark.read.parquet(uri("src/t")), uri("src"))])
    assert spark.read.parquet(uri("src/t")).count() == 5


def test_pipe_export_with_line_breaks_and_trigger(spark, uri):
    df = spark.createDataFrame([(1, "a\nb\n"), (2, "c"), (3, None)], "id int, t string")
    spec = ExportSpec("/g/t", df, uri("out"), format="pipe", stamp="20240131")
    row = run(spark, spec)["/g/t"]
    assert (row.status, row.n_read, row.n_written) == ("ok", 3, 3)
    assert Path(uri("out/g/G_T_TRIGGER_20240131.TXT")).read_text() == "G_T|20240131|3\n"
    assert read_written(spark, row.target_path, "pipe").count() == 5


@pytest.mark.parametrize("fmt", ["csv", "json", "pipe", "parquet"])
@pytest.mark.parametrize("max_rows", [None, 2])
def test_line_breaks_do_not_upset_the_counts(spark, uri, fmt, max_rows):
    df = spark.createDataFrame(
        [(1, "a\nb\n\n", b"\n", ["x\ny"]), (2, None, None, None), (3, "\r\n", b"", [])] * 3,
        "id int, `t\nu` string, b binary, l array<string>",
    ).repartition(3)
    spec = ExportSpec("t", df, uri("out"), format=fmt, max_rows=max_rows)
    row = run(spark, spec)["t"]
    assert (row.status, row.n_read, row.n_written) == ("ok", 9, 9)
    if fmt != "pipe":
        assert written_row_count(spark, row.target_path, fmt).first().n_rows == 9


def test_n_files(spark, uri):
    row = run(spark, ExportSpec("t", source("orders"), uri("out"), n_files=5))["t"]
    assert row.n_files == 5 and row.status == "ok"


def test_delta_export_pushes_its_filter(spark, uri):
    rows = [(i, 1706572800000 + i * 3_600_000) for i in range(48)]
    spark.createDataFrame(rows, "id int, _UPT_ long").write.parquet(uri("src"))
    spec = ExportSpec(
        "t",
        uri("src"),
        uri("out"),
        env="test",
        delta_date="20240131",
        days_back=("_UPT_", 0),
        today=date(2024, 1, 31),
        where=("id", "<", 30),
    )
    df = export_frame(spark, spec)
    assert df.columns == ["id"] and df.count() == 6
    assert "GreaterThanOrEqual(_UPT_,1706659200000)" in pushed_filters(df)
    assert run(spark, spec)["t"].target_path.endswith("/test/delta-data/20240131/t")


def test_option_lists():
    specs = export_specs(
        "/g/a; g/b;",
        "/data{}".format,
        "/out",
        columns="x,y;",
        skip="z",
        rename="x:y;u:v",
        days_back="day:1;",
        keys="k;u,v",
        expected_rows=[3, None],
        where=[None, ("u", "=", "1")],
        today=date(2024, 1, 31),
        marker=True,
    )
    assert [s.table for s in specs] == ["/g/a", "g/b"]
    assert [s.columns for s in specs] == ["x,y", ""]
    assert [s.skip for s in specs] == ["z", "z"]
    assert [s.days_back for s in specs] == [("day", 1), None]
    assert [s.target for s in specs] == ["/out/g/a", "/out/g/b"]
    assert [s.keys for s in specs] == ["k", "u,v"]
    assert [s.expected_rows for s in specs] == [3, None]
    assert [s.where for s in specs] == [None, ("u", "=", "1")]
    assert all(s.marker for s in specs)
    assert {s.where for s in export_specs("a;b", str, "/out", where="*:*")} == {"*:*"}
    with pytest.raises(ValueError, match="columns has 3 values for 2 tables"):
        export_specs("a;b", str, "/out", columns="x;y;z")
    assert broadcast_option("x", None, 2) == [None, None]
    with pytest.raises(ValueError):
        days_back_option("day")


@pytest.mark.parametrize(
    "bad",
    [
        {"format": "xlsx"},
        {"values": "raw"},
        {"null_cells": "maybe"},
        {"days_back": ("day", 1)},
        {"root": ""},
        {"values": "typed", "null_text": "null"},
        {"null_text": "a\nb"},
    ],
)
def test_bad_specs(bad):
    with pytest.raises(ValueError):
        ExportSpec(**{"table": "t", "source": "/s", "root": "/r", **bad})


def test_a_target_may_not_hold_another_specs_source(spark, uri):
    table(spark, "region").write.parquet(uri("out/a"))
    frame = spark.read.parquet(uri("out/a"))
    specs = [ExportSpec("a", source("nation"), uri("out")), ExportSpec("b", frame, uri("out"))]
    with pytest.raises(ValueError, match="read from a target"):
        export_tables(spark, specs)
    assert spark.read.parquet(uri("out/a")).count() == 5


def test_a_failed_run_keeps_the_earlier_rows(spark, uri):
    good = ExportSpec("nation", source("nation"), uri("out"), marker=True)
    assert run(spark, good)["nation"].status == "ok"
    bad = replace(good, expected_rows=1, where=("n_nationkey", "<", 3))
    assert run(spark, bad)["nation"].status == "failed"
    assert spark.read.parquet(good.target).count() == 25
    assert not list(Path(good.target).glob("_nation_completed"))


def test_an_export_evaluates_its_source_once(spark, uri):
    """However late the only match comes: one job writes, one counts what was written."""
    source_rows = table(spark, "lineitem").repartition(40)
    spec = ExportSpec("lineitem", source_rows, uri("out"), where=("l_orderkey", "=", 6000))
    group = "one-evaluation"
    spark.sparkContext.setJobGroup(group, group)
    try:
        run(spark, spec)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(jobs) <= 5


def test_time_columns_count_days_back(spark, uri):
    spec = ExportSpec(
        "orders", source("orders"), uri("out"), values="typed",
        days_back=("o_orderdate", 30), today=date(1999, 1, 10),
    )
    assert run(spark, spec)["orders"].status == "ok"
    want = table(spark, "orders").where("o_orderdate >= TIMESTAMP_NTZ '1998-12-11'").count()
    assert spark.read.parquet(spec.target).count() == want > 0


def test_source_folders_of_many_files(spark, uri):
    """Ten thousand files, one row per folder on the driver."""
    from tablehaul.plans.export import source_folders

    first = table(spark, "region").coalesce(1)
    first.write.parquet(uri("many/a"))
    seed = next(Path(uri("many/a")).glob("*.parquet"))
    for folder, n in (("a", 9_000), ("b", 1_000)):
        Path(uri(f"many/{folder}")).mkdir(exist_ok=True)
        for i in range(n):
            os.link(seed, Path(uri(f"many/{folder}")) / f"part-{i:05d}.parquet")
    df = spark.read.schema(first.schema).parquet(uri("many/a"), uri("many/b")).withColumn("x", F.lit(1))
    found = source_folders(df)
    assert {f.rpartition("/")[2] for f in found} == {"a", "b"}
    assert source_folders(first.groupBy("r_name").count()) and not source_folders(spark.range(3))


def test_source_folders_are_found_without_a_job(spark, uri):
    """Through joins, unions, aggregates and names with special characters; a target above or below them is refused."""
    from tablehaul.plans.export import source_folders

    for name in ("a b%é", "c"):
        table(spark, "region").withColumn("p", F.col("r_regionkey") % 2).write.partitionBy("p").parquet(uri(name))
    a, c = spark.read.parquet(uri("a b%é")), spark.read.parquet(uri("c"))
    both = a.join(c, "r_regionkey").select("r_regionkey").union(spark.range(3)).groupBy("r_regionkey").count()
    group = "source-folders"
    spark.sparkContext.setJobGroup(group, group)
    try:
        found = source_folders(both)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {Path(f.removeprefix("file:")) for f in found} >= {Path(uri("a b%é")), Path(uri("c"))}
    below = spark.read.parquet(uri("c/p=0")).select("r_regionkey")
    for frame, name, root in ((both, "c", uri("")), (both, "x", uri("c")), (below, "c", uri(""))):
        with pytest.raises(ValueError, match="read from a target"):
            export_tables(spark, [ExportSpec(name, frame, root)])
    assert c.count() == 5


def test_verify_only_counts_files_without_rows(spark, uri):
    nation = table(spark, "nation").coalesce(1)
    nation.write.parquet(uri("t"))
    nation.limit(0).write.mode("append").parquet(uri("t"))
    report = export_tables(spark, [ExportSpec("t", uri("t"), convert=False)]).first()
    assert (report.n_read, report.n_files, report.status) == (25, 2, "ok")
    nation.limit(0).write.parquet(uri("none"))
    report = export_tables(spark, [ExportSpec("t", uri("none"), convert=False)]).first()
    assert (report.n_read, report.n_files, report.status) == (0, 1, "empty")
