import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablehaul.llm import exact_dedup as X


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=300), st.binary(max_size=300))
def test_fingerprints_compose(a, b):
    assert X.combine(X.fingerprint(a), X.fingerprint(b)) == X.fingerprint(a + b)


@pytest.mark.parametrize("n", [0, 1, 4095, 4096, 4097, 3 * 4096, 7 * 4096 + 5])
def test_fingerprint_is_the_polynomial(n):
    data = bytes(i * 7 % 251 for i in range(n))
    for base, p, found in zip(X.BASES, X.MODULI, X.fingerprint(data), strict=False):
        want = 0
        for byte in data:
            want = (want * base + byte) % p
        assert found == want


def want(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return groups


def check(found, rows):
    groups = want(rows)
    of_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert len(found) == len(rows)
    kept = defaultdict(list)
    for r in found:
        ids = of_sha[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
        if r["kept"]:
            kept[r["text_sha256"]].append(r["id"])
    assert {s: ids[0] for s, ids in kept.items()} == {
        s: max((i for i in ids if i is not None), default=None) for s, ids in of_sha.items()
    }
    assert all(len(ids) == 1 for ids in kept.values())


def test_groups_like_brute_force(docs, texts):
    check(X.exact_duplicates(docs).collect(), list(texts.items()))


def test_edges(edges, nothing):
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()]
    check(X.exact_duplicates(edges).collect(), rows)
    assert X.exact_duplicates(nothing).count() == 0


def test_hot_groups_are_spread(monkeypatch, docs, texts):
    monkeypatch.setattr(X, "HOT_ROWS", 2)
    check(X.exact_duplicates(docs).collect(), list(texts.items()))


@pytest.mark.parametrize("salts", [(0, 0), (1, 2)])
def test_different_texts_under_one_fingerprint_are_found(spark, salts):
    """Also where the salts of a hot group keep them apart in the first round."""
    rows = [(5, 2, s, 0, t, t.encode()) for s, t in zip(salts, ("ab", "cd"), strict=True)]
    rows += [(6, 2, s, 0, "ef", b"ef") for s in salts]
    chunks = spark.createDataFrame(rows, X.CHUNK_SCHEMA)
    assert [tuple(r) for r in X._collided(chunks).collect()] == [(5, 2)]


def test_filter_bits(spark):
    assert [X.filter_bits(n) for n in (0, 1, 1 << 12, 1 << 24, (1 << 24) + 1)] == [16, 16, 16, 28, 29]
    low = (1 << 20) - 1
    values = [0, 1, 32767, 32768, low, low << 5 | 3]
    bitmap = X._bitmap(spark.createDataFrame([(v,) for v in values], "fingerprint bigint"), 20)
    bits = np.frombuffer(bitmap, np.uint8)
    assert all(X._has(bits, v) for v in values)
    assert int(np.bitwise_count(bits).sum()) == len({v & low for v in values})


def test_very_many_groups_are_picked_by_a_join(monkeypatch, edges):
    monkeypatch.setattr(X, "MOST_BITS", 4)
    check(X.exact_duplicates(edges).collect(), [(r["doc_id"], r["text"]) for r in edges.collect()])


@pytest.mark.parametrize("share", [0.001, 0.01, 0.3])
def test_streams_of_a_hot_group_are_even(share):
    rng = random.Random(1)
    streams = Counter()
    for task in range(200):
        for row in range(1, 5001):
            if rng.random() < share:
                streams[X.spread(task, row) % max(1, round(share * 1000))] += 1
    assert max(streams.values()) <= 2 * streams.total() / max(1, round(share * 1000))


def test_streams_follow_the_size_of_the_group(spark, monkeypatch):
    monkeypatch.setattr(X, "HOT_ROWS", 100)
    rows = [(i, "hot" if i % 3 == 0 else "warm" if i % 100 == 1 else str(i % 7000)) for i in range(30_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    shared = X.fingerprints(df).groupBy("fingerprint", "n_bytes").count().where("count > 1")
    chunks = X._compared_texts(df, shared, 30_000, "doc_id", "text").where("n_bytes >= 3 AND salt > 0")
    found = {(bytes(r["chunk"]), r["salt"]): r["count"] for r in chunks.groupBy("chunk", "salt").count().collect()}
    for text, n in ((b"hot", 10_000), (b"warm", 200)):
        mine = [c for (t, _), c in found.items() if t == text]
        assert sum(mine) == n and len(mine) == n // 100 and max(mine) <= 2 * 100


def test_one_row_of_each_group_stays(edges, nothing):
    out = X.without_copies(edges)
    assert out.columns == edges.columns
    found = sorted((r["text"] or "") for r in out.collect())
    assert found == sorted({(r["text"] or "") for r in edges.collect()})
    assert X.without_copies(nothing).count() == 0
