
import pytest

from tests.conftest import SF

LONG = "lorem ipsum dolor sit amet consetetur. " * 4000
MINUTE = "One two three four five six seven eight nine ten."

#: doc_id, text, lang, source: nulls everywhere, empty and long texts, ties and repeated rows.
ROWS = [
    (1, "The cat sat on the mat and the dog lay down.", "en", "a"),
    (2, "The cat sat on the mat and the dog lay down.", "en", "b"),
    (2, "The cat sat on the mat and the dog lay down.", "en", "b"),
    (3, None, "en", "a"),
    (4, "", None, None),
    (5, "   \n\t ", "en", None),
    (6, "12 34 !! ??", "en", "a"),
    (7, LONG, "la", "c"),
    (8, LONG + "end", "la", "c"),
    (None, "No id here, only words.", "en", "a"),
    (None, None, None, None),
    (9, "Ünïcödé 日本語 😀 ▁ \x00 " + "é" * 70, "xx", "ä"),
    (10, MINUTE, "en", "b"),
    (10, MINUTE + " Eleven.", "en", "b"),
    (11, "x" * 50_000, None, "c"),
]
#: Columns whose names an operator might use itself.
EXTRA = (
    "id string, fp string, kept string, size string, row string, row_key string, target string,"
    " wanted_id string, copies string, fingerprint string, score string, label string, spans string"
)


@pytest.fixture(scope="session")
def edges(spark):
    n = EXTRA.count(",") + 1
    rows = [(*r, None if r[1] is None else len(r[1]), *["own"] * n) for r in ROWS]
    schema = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {EXTRA}"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.where("false")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


