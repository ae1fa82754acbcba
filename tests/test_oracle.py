"""Every registered query against its SQL, on the smallest data set."""

import math
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from tests.conftest import SF


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in entry_module.TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def optional():
    """Queries of the subpackage that may be left out; its own tests cover them."""
    return [q for q in entry_module.queries() if q == "pipeline" or q.startswith("op")]


def rows(pdf):
    def plain(v):
        missing = v is None or (isinstance(v, float) and math.isnan(v))
        return None if missing else v

    columns = sorted(pdf.columns)
    found = pdf[columns].itertuples(index=False, name=None)
    return columns, sorted((tuple(plain(v) for v in r) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(set(entry_module.oracle_sql()) - set(optional())))
def test_query_matches_sql(spark, duck, name):
    got = rows(entry_module.queries()[name](spark, SF).toPandas())
    want = rows(duck.sql(entry_module.oracle_sql()[name]).df())
    assert got == want


def test_entry(spark):
    df = entry_module.entry(spark)
    assert "order_key" in df.columns and "_UPT_" not in df.columns
    assert df.count() > 0


def test_every_query_has_sql():
    assert set(entry_module.queries()) - set(optional()) <= set(entry_module.oracle_sql())


def test_entry_without_the_optional_subpackage():
    code = (
        "import sys; sys.modules['tablehaul.llm'] = sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 60 and set(e.queries()) == set(e.oracle_sql())"
    )
    root = Path(entry_module.__file__).parent
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


@pytest.mark.parametrize("absent", ["zstandard", "xxhash", "public_tokenizers", "corpus_pipeline"])
def test_entry_without_an_optional_library(absent):
    code = (
        f"import sys; sys.modules[{absent!r}] = None\n"
        "import __spark_entry__ as e\n"
        "assert len([q for q in e.queries() if not q.startswith('op') and q != 'pipeline']) > 70"
    )
    root = Path(entry_module.__file__).parent
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
