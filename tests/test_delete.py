from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablehaul import delete_specs
from tablehaul.plans import delete, delete_from, delete_many, finish_delete
from tablehaul.specs import DeleteSpec
from tests.conftest import SF, table


@pytest.fixture
def lineitem(spark, uri):
    """Six files with disjoint order keys, a null quantity in one row of each order."""
    df = table(spark, "lineitem").withColumn(
        "l_quantity", F.when(F.col("l_linenumber") != 2, F.col("l_quantity"))
    )
    df.repartitionByRange(6, "l_orderkey").write.parquet(uri("lineitem"))
    return uri("lineitem")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def names(path):
    return {p.name for p in Path(path).rglob("*.parquet")}


def test_deleted_and_kept_make_the_whole(spark, lineitem):
    before = spark.read.parquet(lineitem)
    total, want = before.count(), before.where("l_quantity <= 40 OR l_quantity IS NULL")
    want_rows = rows(want)
    n = delete_from(spark, lineitem, ("l_quantity", ">", 40))
    after = spark.read.parquet(lineitem)
    assert rows(after) == want_rows and n + after.count() == total
    assert after.where("l_quantity IS NULL").count() > 0
    assert not [p for p in Path(lineitem).iterdir() if p.is_dir()]


def test_only_folders_with_matches_change(spark, uri):
    df = table(spark, "lineitem").repartitionByRange(4, "l_orderkey")
    df.write.partitionBy("l_returnflag", "l_linestatus").parquet(uri("t"))
    old = names(uri("t"))
    kept = {p.name for p in Path(uri("t"), "l_returnflag=N").rglob("*.parquet")}
    want = rows(spark.read.parquet(uri("t")).where("NOT (l_returnflag = 'A' OR (l_returnflag = 'R' AND l_quantity > 20))"))
    pred = ("or", ("l_returnflag", "=", "A"), ("and", ("l_returnflag", "=", "R"), ("l_quantity", ">", 20)))
    delete_from(spark, uri("t"), pred)
    # One folder goes as a whole, one is replaced, one is not touched.
    assert not Path(uri("t"), "l_returnflag=A").exists() or not names(Path(uri("t"), "l_returnflag=A"))
    assert names(uri("t")) & old == kept
    assert rows(spark.read.parquet(uri("t"))) == want
    assert not Path(uri("t")).with_name("_t_delete").exists()


def test_a_schema_must_have_every_column(spark, lineitem):
    schema = spark.read.parquet(lineitem).schema
    with pytest.raises(ValueError, match="l_tax"):
        delete_from(spark, lineitem, ("l_orderkey", "<", 9), schema=type(schema)([f for f in schema if f.name != "l_tax"]))
    assert spark.read.parquet(lineitem).count() == 6000
    assert delete_from(spark, lineitem, ("l_orderkey", "<", 9), schema=schema) > 0


def test_nothing_to_delete_changes_nothing(spark, lineitem):
    old = names(lineitem)
    assert delete_from(spark, lineitem, ("l_quantity", "<", 0)) == 0
    assert names(lineitem) == old


def test_dry_run(spark, lineitem):
    old = names(lineitem)
    n = delete_from(spark, lineitem, ("l_quantity", ">", 40), real_delete=False)
    assert n == spark.read.parquet(lineitem).where("l_quantity > 40").count() > 0
    assert names(lineitem) == old
    assert delete_from(spark, f"{SF}/region.parquet", None, real_delete=False) == 5


def test_delete_all_keeps_the_schema(spark, lineitem):
    schema = spark.read.parquet(lineitem).schema
    assert delete_from(spark, lineitem, "") == 6000
    after = spark.read.parquet(lineitem)
    assert after.count() == 0 and after.schema == schema
    assert delete_from(spark, lineitem, None) == 0


def test_column_predicate(spark, lineitem):
    n = delete_from(spark, lineitem, F.col("l_returnflag").isin("A", "N"))
    after = spark.read.parquet(lineitem)
    assert {r[0] for r in after.select("l_returnflag").distinct().collect()} == {"R"}
    assert n + after.count() == 6000


def test_partitioned_table_keeps_its_folders(spark, uri):
    data = [(i, f"0{i % 3}" if i % 4 else None, i % 5) for i in range(60)]
    df = spark.createDataFrame(data, "id int, p string, v int")
    path = uri("a b%é")
    df.write.partitionBy("p").parquet(path)
    folders = {p.name for p in Path(path).iterdir() if p.is_dir()}
    assert "p=01" in folders
    typed = spark.read.parquet(path)
    assert dict(typed.dtypes)["p"] == "int"
    want = rows(typed.where("NOT (p >= 1 AND v < 3) OR p IS NULL"))
    total = typed.count()
    n = delete_from(spark, path, ("and", ("p", ">=", 1), ("v", "<", 3)))
    after = spark.read.parquet(path)
    assert rows(after) == want and n + after.count() == total
    assert {p.name for p in Path(path).iterdir() if p.is_dir()} == folders


def test_emptied_partitioned_table_can_be_filled_again(spark, uri):
    df = spark.createDataFrame([(i, f"x{i % 3}") for i in range(9)], "id int, p string")
    df.write.partitionBy("p").parquet(uri("t"))
    schema = spark.read.parquet(uri("t")).schema
    assert delete_from(spark, uri("t"), None) == 9
    after = spark.read.parquet(uri("t"))
    assert after.count() == 0 and after.schema == schema
    df.write.mode("append").partitionBy("p").parquet(uri("t"))
    assert rows(spark.read.parquet(uri("t"))) == rows(df)
    assert delete_from(spark, uri("t"), ("p", "=", "x1")) == 3


@pytest.mark.parametrize("partitions", [(), ("p",)])
def test_columns_of_some_files_only_are_kept(spark, uri, partitions):
    old = spark.createDataFrame([(i, i % 2) for i in range(10)], "id int, p int")
    new = old.select("id", "p", F.concat(F.lit("n"), "id").alias("note"))
    for df in (old.coalesce(1), new.coalesce(1)):
        df.write.mode("append").partitionBy(*partitions).parquet(uri("t"))
    assert delete_from(spark, uri("t"), ("id", ">=", 6)) == 8
    after = spark.read.option("mergeSchema", "true").parquet(uri("t"))
    want = [(i, i % 2, n) for i in range(6) for n in (None, f"n{i}")]
    assert rows(after.select("id", "p", "note")) == sorted(want, key=repr)
    assert delete_from(spark, uri("t"), None) == 12
    assert set(spark.read.parquet(uri("t")).columns) == {"id", "p", "note"}


def test_failed_write_leaves_the_table_as_it_was(spark, lineitem, monkeypatch):
    before = rows(spark.read.parquet(lineitem))
    monkeypatch.setattr(delete, "retain", lambda df, pred: df.where("l_orderkey < 0"))
    with pytest.raises(RuntimeError, match="should stay"):
        delete_from(spark, lineitem, ("l_quantity", ">", 40))
    assert rows(spark.read.parquet(lineitem)) == before


@pytest.mark.parametrize("partitions", [(), ("l_returnflag",)])
@pytest.mark.parametrize("stop_at", ["copy", "replace", "midway"])
def test_an_interrupted_delete_is_finished_or_dropped(spark, uri, monkeypatch, stop_at, partitions):
    """Before the copy is whole nothing has changed; afterwards the delete can be completed, however often it stops."""
    table(spark, "lineitem").repartition(3).write.partitionBy(*partitions).parquet(uri("t"))
    pred = ("or", ("l_returnflag", "=", "A"), ("l_quantity", ">", 40))
    before = spark.read.parquet(uri("t"))
    untouched = rows(before)
    want = rows(before.where("NOT (l_returnflag = 'A' OR l_quantity > 40)"))

    def stop(*_):
        if stop_at == "midway":  # the overwrite has removed files and written none
            for p in list(Path(uri("t")).rglob("*.parquet"))[:2]:
                p.unlink()
        raise OSError("the driver is gone")

    with monkeypatch.context() as m:
        m.setattr(delete, "retain" if stop_at == "copy" else "_replace", stop)
        with pytest.raises(OSError):
            delete_from(spark, uri("t"), pred)
        if stop_at != "copy":
            with pytest.raises(OSError):
                finish_delete(spark, uri("t"))
    if stop_at == "copy":
        assert rows(spark.read.parquet(uri("t"))) == untouched
    else:
        with pytest.raises(RuntimeError, match="unfinished"):
            delete_from(spark, uri("t"), pred)
    assert finish_delete(spark, uri("t")) == (stop_at != "copy")
    assert rows(spark.read.parquet(uri("t"))) == (untouched if stop_at == "copy" else want)
    assert not finish_delete(spark, uri("t"))


@pytest.mark.parametrize("renames", [delete.RENAMES, ()])
def test_stopped_between_two_folders(spark, uri, monkeypatch, renames):
    """Folders that were replaced before the run stopped stay replaced, the others follow; also by overwriting."""
    monkeypatch.setattr(delete, "RENAMES", renames)
    spark.range(100).selectExpr("id", "id % 5 AS p").write.partitionBy("p").parquet(uri("t"))
    put, done = delete._put, []

    def stop(spark, copy, home, codec):
        if len(done) > 1:
            raise OSError("the driver is gone")
        done.append(home)
        put(spark, copy, home, codec)

    with monkeypatch.context() as m:
        m.setattr(delete, "_put", stop)
        with pytest.raises(OSError):
            delete_from(spark, uri("t"), ("or", ("id", "<", 50), ("p", "=", 4)))
    assert finish_delete(spark, uri("t"))
    left = spark.read.parquet(uri("t"))
    assert sorted(r.id for r in left.collect()) == [i for i in range(50, 100) if i % 5 != 4]
    assert not Path(uri("t")).with_name("_t_delete").exists()


@pytest.mark.parametrize("renames", [delete.RENAMES, ()])
def test_folder_names_of_other_writers(spark, uri, monkeypatch, renames):
    """Names that Spark would write in another way are kept, and so are columns named like the copy's."""
    monkeypatch.setattr(delete, "RENAMES", renames)
    data = {"id": list(range(12)), "Copy": ["c"] * 12, "p": ["a b", "é", "x/y", "plus+"] * 3, "q": [1, 2] * 6}
    pq.write_to_dataset(pa.table(data), uri("t"), partition_cols=["p", "q"])
    folders = {str(f) for f in Path(uri("t")).rglob("*=*/*=*")}
    assert any("%20" in f for f in folders)
    want = rows(spark.read.parquet(uri("t")).where("id >= 4"))
    assert len(want) == 8 and delete_from(spark, uri("t"), ("id", "<", 4)) == 4
    assert rows(spark.read.parquet(uri("t"))) == want
    assert {str(f) for f in Path(uri("t")).rglob("*=*/*=*")} == folders


def test_a_table_of_many_small_files(spark, uri):
    df = spark.range(4000).selectExpr("id", "id % 40 AS p")
    df.repartition(50).write.partitionBy("p").parquet(uri("many"))
    assert len(list(Path(uri("many")).rglob("*.parquet"))) > 1500
    assert delete_from(spark, uri("many"), ("or", ("p", "=", 3), ("and", ("p", "=", 5), ("id", "<", 2000)))) == 150
    assert spark.read.parquet(uri("many")).count() == 3850


@given(st.lists(st.tuples(st.integers(0, 5), st.none() | st.integers(0, 9)), min_size=1))
@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
def test_any_table(spark, tmp_path_factory, data):
    path = str(tmp_path_factory.mktemp("any") / "t")
    spark.createDataFrame(data, "f int, v int").repartition(3, "f").write.parquet(path)
    n = delete_from(spark, path, ("v", ">=", 5))
    kept = [r for r in data if r[1] is None or r[1] < 5]
    assert rows(spark.read.parquet(path)) == sorted(kept, key=repr)
    assert n == len(data) - len(kept)


def test_delete_many(spark, uri):
    frames = {
        "a": spark.createDataFrame([(1, 0), (2, 1706659200000), (3, None)], "id int, _UPT_ long"),
        "b": spark.createDataFrame([(1,), (2,)], "id int"),
        "c": spark.createDataFrame([(1,), (2,)], "id int"),
    }
    for name, df in frames.items():
        df.write.parquet(uri(name))
    specs = delete_specs(
        "a;b;c",
        uri,
        where=[("id", "=", 3), ("id", "=", 2), None],
        delete_days="30;;",
        now=datetime(2024, 1, 31),
    )
    got = {r.table_name: r.n_deleted for r in delete_many(spark, specs).collect()}
    assert got == {"a": 1, "b": 1, "c": 2}
    left = {r.id for r in spark.read.parquet(uri("a")).collect()}
    assert left == {2, 3}


def test_lists_must_have_equal_length(uri):
    with pytest.raises(ValueError, match="delete_days has 1 values for 2 tables"):
        delete_specs("a;b", uri, delete_days="3")
    with pytest.raises(ValueError, match="where has 1"):
        delete_specs("a;b", uri, where=[None])
    with pytest.raises(ValueError, match="needs now"):
        delete_specs("a", uri, delete_days="3")


def test_delete_many_reports_failures(spark, uri):
    table(spark, "nation").write.parquet(uri("a"))
    specs = [DeleteSpec("absent", uri("absent")), DeleteSpec("a", uri("a"), ("n_nationkey", "<", 5))]
    got = {r.table_name: (r.n_deleted, r.status) for r in delete_many(spark, specs).collect()}
    assert got == {"absent": (None, "failed"), "a": (5, "ok")}


def test_deletes_keep_the_codec(spark, uri):
    table(spark, "orders").write.option("compression", "gzip").parquet(uri("z"))
    delete_from(spark, uri("z"), ("o_orderstatus", "=", "F"))
    files = [p.name for p in Path(uri("z")).glob("*.parquet")]
    assert files and all(".gz." in f for f in files)
