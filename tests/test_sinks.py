import gzip
import os
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablehaul.operators import stringify
from tablehaul.sinks import (
    ParquetOptions,
    marker_uri,
    read_written,
    s3a_settings,
    target_uri,
    trigger_uri,
    write_marker,
    write_table,
    write_trigger,
    written_row_count,
)
from tablehaul.sinks import writers
from tablehaul.sources import key_columns, with_keys
from tests.conftest import table

NASTY = [
    (1, None, "plain"),
    (2, "", 'q"x'),
    (3, "b|c", "y,z"),
    (4, " lead and trail ", "two\nlines"),
    (5, "back\\slash", "cr\rlf\r\n end"),
    (6, '"', "\\"),
    (7, '""', 'a\\"b'),
    (8, "é漢", "\t"),
    (9, "null", "NULL"),
    (10, "ends with \\", ","),
]


@pytest.fixture
def nasty(spark):
    return spark.createDataFrame(NASTY, "id int, a string, b string").coalesce(1)


def data_files(uri):
    return sorted(p for p in Path(uri).rglob("part-*"))


def test_csv_bytes(spark, nasty, uri):
    write_table(nasty.where("id <= 3"), uri("t"), "csv")
    text = data_files(uri("t"))[0].read_text()
    assert text == '"id","a","b"\n"1","","plain"\n"2","","q""x"\n"3","b|c","y,z"\n'


def test_csv_reads_back(spark, nasty, uri):
    write_table(nasty, uri("t"), "csv")
    back = read_written(spark, uri("t"), "csv", "id int, a string, b string")
    got = sorted((r.id, r.a or "", r.b or "") for r in back.collect())
    assert got == [(i, a or "", b or "") for i, a, b in NASTY]
    assert written_row_count(spark, uri("t"), "csv").first().n_rows == len(NASTY)


def test_csv_bytes_match_the_standard_library(spark, nasty, uri):
    import csv
    import io

    write_table(nasty, uri("t"), "csv")
    with open(data_files(uri("t"))[0], newline="") as f:
        got = f.read()
    out = io.StringIO(newline="")
    writer = csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n")
    writer.writerow(["id", "a", "b"])
    writer.writerows((str(i), a or "", b or "") for i, a, b in NASTY)
    assert got == out.getvalue()


def test_json_reads_back(spark, nasty, uri):
    write_table(nasty, uri("t"), "json")
    back = read_written(spark, uri("t"), "json", nasty.schema)
    assert sorted(map(tuple, back.collect())) == NASTY
    assert '{"id":1,"b":"plain"}' in data_files(uri("t"))[0].read_text()
    assert written_row_count(spark, uri("t"), "json").first().n_rows == len(NASTY)


def test_json_map_keys_are_text(spark, uri):
    df = spark.sql("SELECT map(DATE'2024-01-02', map(1, X'41')) AS m, 'x' AS t")
    write_table(df, uri("t"), "json")
    assert '{"m":{"2024-01-02":{"1":"QQ=="}},"t":"x"}' in data_files(uri("t"))[0].read_text()


TEXT = st.none() | st.text(st.characters(exclude_categories=["Cs"]), max_size=6) | st.text(
    "\"\\,|\n\r' \t", max_size=6
)


@given(st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=8))
@settings(max_examples=40, deadline=None)
def test_any_text_reads_back(spark, tmp_path_factory, pairs):
    folder = tmp_path_factory.mktemp("any")
    data = [(i, a, b) for i, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(data, "id int, a string, b string").coalesce(2)
    for fmt in ("csv", "json", "parquet"):
        write_table(df, str(folder / fmt), fmt)
        back = read_written(spark, str(folder / fmt), fmt, df.schema)
        want = [(i, a or "", b or "") for i, a, b in data] if fmt == "csv" else data
        got = back.na.fill("") if fmt == "csv" else back
        assert sorted(map(tuple, got.collect())) == want
        assert written_row_count(spark, str(folder / fmt), fmt).first().n_rows == len(data)


def test_pipe_text(spark, nasty, uri):
    write_table(nasty.where("id <= 3"), uri("t"), "pipe")
    assert data_files(uri("t"))[0].read_text() == '1||plain\n2||q"x\n3|b|c|y,z\n'


def test_parquet_settings(spark, uri):
    lineitem = table(spark, "lineitem")
    write_table(stringify(lineitem), uri("v2"))
    write_table(lineitem, uri("v1"), options=ParquetOptions(version="v1", dictionary=False))
    meta = {v: pq.ParquetFile(data_files(uri(v))[0]).metadata for v in ("v1", "v2")}
    for m in meta.values():
        assert m.row_group(0).column(0).compression == "GZIP"
    # A flag column fits the dictionary page of 512 bytes, an id column does not.
    column = dict(zip(lineitem.columns, range(99)))["l_returnflag"]
    assert meta["v2"].row_group(0).column(column).has_dictionary_page
    assert not meta["v1"].row_group(0).column(column).has_dictionary_page
    assert "DELTA_BYTE_ARRAY" in meta["v2"].row_group(0).column(0).encodings
    assert meta["v2"].schema.column(0).physical_type == "BYTE_ARRAY"
    with pytest.raises(ValueError):
        write_table(lineitem, uri("v3"), options=ParquetOptions(version="v3"))


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "pipe"])
def test_max_rows_and_overwrite(spark, uri, fmt):
    orders = table(spark, "orders").coalesce(1)
    for limit, files in ((400, 4), (None, 1)):
        write_table(orders, uri("t"), fmt, max_rows=limit)
        assert len(data_files(uri("t"))) == files
        assert written_row_count(spark, uri("t"), fmt).first().n_rows == orders.count()
    with pytest.raises(ValueError):
        write_table(orders, uri("t"), fmt, max_rows=0)


def test_failed_limited_write_leaves_the_earlier_rows(spark, uri, tmp_path):
    rows = spark.range(40).coalesce(1)
    write_table(rows, uri("t"), max_rows=7)
    bad = F.when(F.col("id") == 30, F.raise_error(F.lit("bad row")).cast("long")).otherwise(F.col("id"))
    with pytest.raises(Exception, match="bad row"):
        write_table(rows.select(bad.alias("id")), uri("t"), max_rows=7)
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    assert sorted(r.id for r in spark.read.parquet(uri("t")).collect()) == list(range(40))
    with pytest.raises(ValueError, match="while it is read"):
        write_table(spark.read.parquet(uri("t")), uri("t"), max_rows=7)


def test_limited_write_replaces_rows_and_cached_reads(spark, uri, tmp_path):
    write_table(spark.range(40), uri("t"), max_rows=7)
    seen = spark.read.parquet(uri("t")).cache()
    assert seen.count() == 40
    write_table(spark.range(9).repartition(2), uri("t"), max_rows=2)
    assert seen.count() == 9
    seen.unpersist()
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.suffix != ".crc" and p.name[0] == "_") == ["_SUCCESS"]
    sizes = [pq.ParquetFile(p).metadata.num_rows for p in data_files(uri("t"))]
    assert sum(sizes) == 9 and max(sizes) <= 2


def test_small_files_are_those_of_spark(spark, uri, monkeypatch):
    rows = spark.sql(
        """SELECT id, int(id) AS i, smallint(id) AS sh, tinyint(id % 100) AS b, float(id) AS f, nullif(id % 7, 3) / 2D AS d,
                  nullif(string(id % 9), '4') AS s, binary('a' || id) AS bi, id > 3 AS bo, date_add(DATE'1400-01-01', int(id)) AS dt,
                  timestamp_ntz'1500-01-02 03:04:05.678901' AS t, string(null) AS nothing FROM range(250)"""
    ).coalesce(1)
    rows = with_keys(rows, "id, s").withColumnRenamed("s", "a.b ,%")
    for options in (None, ParquetOptions(version="v1"), ParquetOptions("zstd", dictionary=False), ParquetOptions("none")):
        write_table(rows, uri("small file%20"), options=options, max_rows=60)
        with monkeypatch.context() as patch:
            patch.setattr(writers, "fits", lambda *a: False)
            write_table(rows, uri("spark"), options=options, max_rows=60)
        small, big = ([pq.ParquetFile(p) for p in data_files(uri(d))] for d in ("small file%20", "spark"))
        assert [f.metadata.num_rows for f in small] == [60] * 4 + [10]
        assert {f.metadata.created_by[:17] for f in small} == {"parquet-cpp-arrow"}
        for a, b in zip(small, big, strict=True):
            assert a.schema.equals(b.schema) and a.metadata.metadata == b.metadata.metadata and a.read().equals(b.read())
            kinds = [[f.metadata.row_group(0).column(i).compression for i in range(12)] for f in (a, b)]
            assert kinds[0] == kinds[1]
        assert {p.stat().st_mode for p in data_files(uri("small file%20"))} == {p.stat().st_mode for p in data_files(uri("spark"))}
        back = spark.read.parquet(uri("small file%20"))
        assert key_columns(back) == ["id", "a.b ,%"]
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    encodings = {c.path_in_schema: c.encodings for c in map(small[0].metadata.row_group(0).column, range(12))}
    assert "DELTA_BINARY_PACKED" in encodings["id"] and "RLE_DICTIONARY" in encodings["a.b ,%"]


@pytest.mark.parametrize("kind", ["nested", "timestamp", "many rows", "session"])
def test_other_files_are_left_to_spark(spark, uri, kind):
    value = {"nested": "array(id)", "timestamp": "TIMESTAMP'2024-01-01 00:00:00'"}.get(kind, "id")
    rows = spark.range(40).coalesce(1).selectExpr("id", f"{value} AS v")
    if kind == "session":
        spark.conf.set("parquet.bloom.filter.enabled", "true")
    try:
        write_table(rows, uri("t"), max_rows=5000 if kind == "many rows" else 7)
    finally:
        spark.conf.unset("parquet.bloom.filter.enabled")
    files = [pq.ParquetFile(p) for p in data_files(uri("t"))]
    assert {f.metadata.created_by[:10] for f in files} == {"parquet-mr"}
    assert len(files) == (1 if kind == "many rows" else 6)


def test_small_files_of_other_attempts_are_left_out(spark, uri, tmp_path, monkeypatch):
    rename, home = os.rename, []

    def rename_after_a_lost_attempt(old, new):
        """Between the last result and the closing, an attempt without a result has left its mark and a file."""
        if str(old).endswith("_attempts"):
            home.append(Path(old).parent)
            (Path(old) / "999999").touch()
            made = next(home[0].glob("part-*"))
            (home[0] / "part-00000-lost-999999-c000.gz.parquet").write_bytes(made.read_bytes())
        rename(old, new)

    monkeypatch.setattr(os, "rename", rename_after_a_lost_attempt)
    write_table(spark.range(40).repartition(3), uri("t"), max_rows=7)
    assert home and not home[0].exists()
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    assert sorted(r.id for r in spark.read.parquet(uri("t")).collect()) == list(range(40))
    assert {p.name for p in (tmp_path / "t").iterdir() if not p.name.startswith(("part-", "."))} == {"_SUCCESS"}


@pytest.mark.parametrize("frame", ["range", "no partitions", "some empty partitions"])
def test_limited_write_of_no_rows(spark, uri, frame):
    rows = spark.createDataFrame([], "id long") if frame == "no partitions" else spark.range(0, 1000, 1, 4)
    rows = rows.where("id >= 990") if frame == "some empty partitions" else rows.where("id < 0")
    write_table(rows, uri("t"), max_rows=7)
    back = spark.read.parquet(uri("t"))
    assert back.columns == ["id"] and back.count() == (10 if frame == "some empty partitions" else 0)
    assert all(pq.ParquetFile(p).metadata.num_rows <= 7 for p in data_files(uri("t")))


def test_unknown_format_and_missing_avro(spark, nasty, uri):
    with pytest.raises(ValueError, match="unknown format"):
        write_table(nasty, uri("t"), "xlsx")
    try:
        write_table(nasty, uri("t"), "avro", table="/g/t")
    except RuntimeError as e:
        assert "spark-avro" in str(e)
    else:
        assert written_row_count(spark, uri("t"), "avro").first().n_rows == len(NASTY)


def test_targets():
    assert target_uri("s3a://b/x/", "/g/t/") == "s3a://b/x/g/t"
    assert target_uri("/x", "g/t", "prod") == "/x/prod/full-data/g/t"
    assert target_uri("/x", "t", "prod", "20240131") == "/x/prod/delta-data/20240131/t"
    with pytest.raises(ValueError):
        target_uri("/x", "t", delta_date="20240131")
    assert marker_uri("/x/g/t", "/g/t") == "/x/g/t/_g_t_completed"
    assert trigger_uri("/x/g/t", "/g/t", "1") == "/x/g/G_T_TRIGGER_1.TXT"
    assert s3a_settings()["fs.s3a.encryption.algorithm"] == "AES256"
    assert s3a_settings("http://h:9000")["fs.s3a.path.style.access"] == "true"


def test_marker_is_hidden_and_goes_with_an_overwrite(spark, nasty, uri):
    write_table(nasty, uri("t"))
    marker = write_marker(spark, uri("t"), "/g/t")
    assert Path(marker).read_bytes() == b""
    assert spark.read.parquet(uri("t")).count() == len(NASTY)
    write_table(nasty, uri("t"))
    assert not Path(marker).exists()


def test_trigger(spark, uri):
    path = write_trigger(spark, uri("g/t"), "/g/t", "20240131", 12)
    assert Path(path).read_text() == "G_T|20240131|12\n"
    assert Path(path).name == "G_T_TRIGGER_20240131.TXT"
    write_trigger(spark, uri("g/t"), "/g/t", "20240131", 12, prefix="SALES")
    assert Path(path).read_text() == "SALES|20240131|12\n"


def test_gzip_is_not_used_for_text(spark, nasty, uri):
    write_table(nasty, uri("t"), "pipe")
    with pytest.raises(gzip.BadGzipFile):
        gzip.open(data_files(uri("t"))[0]).read()


def test_csv_rows_are_counted_by_lines(spark, uri):
    df = spark.createDataFrame(
        [("a\nb", 'q"x\n\n'), (None, ""), ("c", "d")], 'one string, "t\nwo" string'.replace('"', "`")
    )
    write_table(df.repartition(2), uri("c"), "csv")
    assert written_row_count(spark, uri("c"), "csv", df).first().n_rows == 3
    assert written_row_count(spark, uri("c"), "csv").first().n_rows == 3
