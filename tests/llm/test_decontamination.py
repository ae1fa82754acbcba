import hashlib
import re

import pytest

from tablehaul.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def windows_of(items, width=10):
    out = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            out.setdefault(tuple(w[i : i + width]), set()).update([] if item is None else [str(item)])
    return out


def slow(rows, items, width=10):
    windows = windows_of(items, width)
    lengths = {len(w) for w in windows}
    out = []
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for at in range(len(w) - n + 1):
                if (key := tuple(w[at : at + n])) in windows:
                    hit.update(range(at, at + n))
                    found |= windows[key]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def got(df):
    columns = ["id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")


ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven"),
    (2, "The DOG lay"),
    (2, "lorem"),
    (30, "six seven eight nine ten"),
    (4, None),
    (5, " ...?! "),
    (None, "cat sat"),
    (6, "日本語"),
    (7, "one two three four five six seven eight nine ten eleven"),
    (8, "é" * 70),
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(*r, "own") for r in ITEMS], "item_id int, text string, window string")


@pytest.mark.parametrize("most_bytes", [D.MOST_BYTES, 10_000])
def test_like_brute_force(docs, texts, benchmark, most_bytes):
    """Also where the windows are too many for one broadcast."""
    rows = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    assert got(D.contaminated(docs, benchmark, most_bytes=most_bytes)) == slow(texts.items(), rows)


def test_edges(edges, nothing, items):
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()]
    found = got(D.contaminated(edges, items))
    assert found == slow(rows, ITEMS)
    assert any(r[-1] for r in found) and not all(r[-1] for r in found)
    assert D.contaminated(nothing, items).count() == 0
    clean = got(D.contaminated(edges, items.where("false")))
    assert clean == slow(rows, [])


@pytest.mark.parametrize("width", [1, 2, 5])
def test_other_widths(edges, items, width):
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()]
    assert got(D.contaminated(edges, items, width=width)) == slow(rows, ITEMS, width)


def test_documents_with_hits_go(edges, items):
    out = D.without_contaminated(edges, items)
    assert out.columns == edges.columns
    want = [r["text"] for r in edges.collect() if not slow([(0, r["text"])], ITEMS)[0][-1]]
    assert sorted(map(str, (r["text"] for r in out.collect()))) == sorted(map(str, want))


def test_passages_are_cut_out(spark, items):
    texts = {
        1: "Say: one two, three four-five six seven EIGHT nine\nten eleven! And more.",
        2: "six seven eight nine ten six seven eight nine ten",
        3: "A cat sat; the dog lay down, the cat sat.",
        4: "nothing to see",
        5: None,
        6: "...lorem ipsum... lorem",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    out = {r["doc_id"]: r["text"] for r in D.without_passages(df, items).collect()}
    assert out == {
        1: "Say: ! And more.",
        2: "",
        3: "A  down, the .",  # stretches that touch are one
        4: "nothing to see",
        5: None,
        6: "... ipsum... ",
    }


def test_plan_has_no_python(docs, benchmark):
    plan = D.contaminated(docs, benchmark)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
