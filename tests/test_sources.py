import shutil

import pytest

from tablehaul.sources import (
    file_row_counts,
    is_empty,
    key_columns,
    listed_files,
    row_count,
    scan_dir,
    scan_table,
    with_keys,
)
from tablehaul.sources import scan
from tablehaul.sources.files import shared_folder
from tests.conftest import SF, read_schema, table


@pytest.fixture
def folder(spark, tmp_path):
    for name in ("one.parquet", "TWO.Parquet"):
        shutil.copy(f"{SF}/nation.parquet", tmp_path / name)
    shutil.copy(f"{SF}/region.parquet", tmp_path / "other.parquet.bak")
    (tmp_path / "_done.parquet").touch()
    (tmp_path / "sub.parquet").mkdir()
    shutil.copy(f"{SF}/nation.parquet", tmp_path / "sub.parquet" / "x.parquet")
    return tmp_path


def test_scan_dir_ignores_case_and_sub_folders(spark, folder):
    df = scan_dir(spark, str(folder))
    assert df.count() == 50 and df.columns == ["n_nationkey", "n_name", "n_regionkey"]
    assert scan_dir(spark, str(folder), "e.PARQUET").count() == 25
    (folder / "p=1").mkdir()
    shutil.copy(f"{SF}/nation.parquet", folder / "p=1" / "y.parquet")
    again = scan_dir(spark, str(folder))
    assert again.count() == 50 and "p" not in again.columns


@pytest.mark.parametrize("suffix", [".csv", "sub.parquet", "*.parquet", "[o]ne.parquet"])
def test_scan_dir_without_files_is_an_error(spark, folder, suffix):
    with pytest.raises(ValueError, match="no files"):
        scan_dir(spark, str(folder), suffix)


def test_unknown_table_is_an_error(spark):
    with pytest.raises(ValueError, match="no table"):
        scan_table(spark, f"{SF}/nothing.parquet")


def test_counts(spark, uri):
    lineitem = table(spark, "lineitem")
    lineitem.write.option("maxRecordsPerFile", 2500).parquet(uri("a b%é"))
    counts = file_row_counts(spark.read.parquet(uri("a b%é")))
    assert sorted(r.n_rows for r in counts.collect()) == [1000, 2500, 2500]
    assert all(r.size_bytes > 0 for r in counts.collect())
    assert row_count(lineitem).first().n_rows == lineitem.count()
    assert read_schema(counts) == "struct<>"
    assert read_schema(row_count(lineitem)) == "struct<>"


def test_is_empty(spark):
    region = table(spark, "region")
    assert is_empty(region.where("r_regionkey < 0")) and not is_empty(region)


class FakeSession:
    """Only what choosing the shared folder looks at."""

    def __init__(self, master, folder=None):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})
        self.conf = type("Conf", (), {"get": lambda self, key, default: folder})()


def test_shared_folder():
    assert shared_folder(FakeSession("yarn", "hdfs://x/ckpt/")) == "hdfs://x/ckpt/tablehaul/app-1"
    local = shared_folder(FakeSession("local[2]"))
    assert local == shared_folder(FakeSession("local[2]")) and local.endswith("/tablehaul/app-1")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(FakeSession("yarn"))


def test_columns_of_every_file(spark, uri):
    orders = table(spark, "orders").select("o_orderkey", "o_custkey")
    orders.drop("o_custkey").write.parquet(uri("t"))
    orders.write.mode("append").parquet(uri("t"))
    for df in (scan_table(spark, uri("t")), scan_dir(spark, uri("t"))):
        assert df.columns == ["o_orderkey", "o_custkey"] and df.count() == 3000
        assert df.where("o_custkey IS NOT NULL").count() == 1500
    given = scan_table(spark, uri("t"), schema=orders.select("o_custkey").schema)
    assert given.columns == ["o_custkey"]
    orders.select(orders.o_orderkey.cast("string")).write.mode("append").parquet(uri("t"))
    with pytest.raises(Exception, match="o_orderkey"):
        scan_table(spark, uri("t"))


def test_hidden_files_are_an_error(spark, folder):
    shutil.copy(f"{SF}/nation.parquet", folder / ".more.parquet")
    with pytest.raises(ValueError, match=".more.parquet"):
        scan_dir(spark, str(folder))


def test_key_names_may_have_dots(spark, uri):
    with_keys(table(spark, "region").withColumnRenamed("r_name", "a.b"), "a.b").write.parquet(uri("k"))
    assert key_columns(scan_table(spark, uri("k"))) == ["a.b"]


def test_local_temporary_folder_on_a_cluster_is_refused():
    with pytest.raises(RuntimeError, match="temporary folder"):
        shared_folder(FakeSession("yarn", "file:///tmp/x"))
    assert shared_folder(FakeSession("yarn", "file:///mnt/x")).startswith("file:///mnt/x/")


@pytest.mark.parametrize("partitions", [(), ("n_regionkey",)])
def test_files_without_rows_are_counted(spark, uri, partitions):
    nation = table(spark, "nation").coalesce(1)
    path = uri("a b%é")
    nation.write.partitionBy(*partitions).parquet(path)
    home = f"{path}/n_regionkey=3" if partitions else path
    nation.drop(*partitions).limit(0).write.mode("append").parquet(home)
    df = scan_table(spark, path)
    found = file_row_counts(df, listed_files(spark, path))
    assert read_schema(found) == "struct<>"
    rows = found.collect()
    assert sorted(r.n_rows for r in rows) == ([0, 5, 5, 5, 5, 5] if partitions else [0, 25])
    assert all(r.size_bytes > 0 and r.file_path.endswith(".parquet") for r in rows)
    assert file_row_counts(df).count() == len(rows) - 1


def test_listed_files_of_a_suffix(spark, folder):
    nation = table(spark, "nation")
    nation.limit(0).coalesce(1).write.parquet(str(folder / "made"))
    empty = next((folder / "made").glob("*.parquet"))
    shutil.copy(empty, folder / "three.parquet")
    shutil.rmtree(folder / "made")
    for _ in range(2):
        found = file_row_counts(scan_dir(spark, str(folder)), listed_files(spark, str(folder), ".parquet"))
        assert sorted((r.file_path.rpartition("/")[2], r.n_rows) for r in found.collect()) == [
            ("TWO.Parquet", 25), ("one.parquet", 25), ("three.parquet", 0)
        ]
        (folder / "p=1").mkdir(exist_ok=True)
        shutil.copy(f"{SF}/nation.parquet", folder / "p=1" / "y.parquet")


def test_small_files_are_counted_by_few_tasks(spark, tmp_path, monkeypatch):
    spark.range(60).repartition(30).write.option("maxRecordsPerFile", 1).parquet(str(tmp_path / "t"))
    monkeypatch.setattr(scan, "TASKS_PER_CORE", 1)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        counts = file_row_counts(spark.read.parquet(str(tmp_path / "t")))
        plan = counts._jdf.queryExecution().executedPlan().toString()
        assert "Coalesce 4" in plan
        found = counts.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r.n_rows for r in found] == [1] * 60
    assert all(r.size_bytes > 0 for r in found)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("parted", [False, True])
def test_many_small_files_are_counted_by_footers(spark, tmp_path, monkeypatch, parted):
    at = tmp_path / "t 1%20#"
    writer = spark.range(60).selectExpr("id", "id % 3 AS `a b`").repartition(5).write
    (writer.partitionBy("a b") if parted else writer).parquet(str(at))
    made = sorted(at.rglob("part-*.parquet"))
    shutil.copyfile(made[0], made[0].with_name("part %41 #é?.parquet"))
    shutil.copyfile(made[0], made[0].with_name("_hidden.parquet"))
    made[0].with_name("nothing.parquet").touch()
    spark.range(0).selectExpr("id", *([] if parted else ["id AS `a b`"])).write.parquet(str(tmp_path / "empty"))
    shutil.copyfile(next((tmp_path / "empty").glob("part-*")), made[0].with_name("empty.parquet"))
    df = spark.read.parquet(str(at))
    assert "MapInArrow" not in plan_of(file_row_counts(df))
    want = sorted(map(tuple, file_row_counts(df).collect()))
    monkeypatch.setattr(scan, "MANY_FILES", 3)
    counts = file_row_counts(df)
    assert "MapInArrow" in plan_of(counts) and "FileScan" not in plan_of(counts)
    assert counts.columns == ["file_path", "n_rows", "size_bytes"]
    assert sorted(map(tuple, counts.collect())) == want
    assert sum(r[1] for r in want) > 60 and len(want) == len(made) + 1
    listed = file_row_counts(df, listed_files(spark, str(at))).where("n_rows > 0")
    assert sorted(map(tuple, listed.collect())) == want


def test_footers_are_only_for_whole_small_local_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scan, "MANY_FILES", 1)
    at = str(tmp_path / "t")
    spark.range(60).repartition(3).write.parquet(at)
    spark.range(60).write.json(str(tmp_path / "json"))
    df = spark.read.parquet(at)
    others = [df.where("id < 9"), spark.read.parquet(at, at), spark.read.json(str(tmp_path / "json"))]
    for other in others:
        assert "MapInArrow" not in plan_of(file_row_counts(other))
    assert sum(r.n_rows for r in file_row_counts(others[0]).collect()) == 9
    assert sum(r.n_rows for r in file_row_counts(others[1]).collect()) == 120
    monkeypatch.setattr(scan, "SMALL_BYTES", 10)
    assert "MapInArrow" not in plan_of(file_row_counts(df))
