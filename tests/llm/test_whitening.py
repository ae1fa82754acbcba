import math
import random
from collections import Counter

import numpy as np
import pytest

from tablehaul.llm import whitening as W

SF = "/root/testdata/sf0.001"


def slow_polynomial(matrix):
    """Faddeev and LeVerrier's way, in whole numbers."""
    a = np.array(matrix, object)
    d, m, out = len(a), np.zeros_like(a), [1]
    for k in range(1, d + 1):
        m = a @ m + out[-1] * np.eye(d, dtype=int).astype(object)
        out.append(-int(np.trace(a @ m)) // k)
    return out[::-1]


def scatter(rng, d, n, size=50):
    x = [[rng.randint(-size, size) for _ in range(d)] for _ in range(n)]
    sums = [sum(c) for c in zip(*x, strict=True)]
    return [[n * sum(r[i] * r[j] for r in x) - sums[i] * sums[j] for j in range(d)] for i in range(d)]


MATRICES = [
    [[5]],
    [[0, 0], [0, 0]],
    [[2, 0, 0], [0, 2, 0], [0, 0, 1]],
    [[4, 2, 0], [2, 1, 0], [0, 0, 0]],
    [[7 if i == j else 3 for j in range(5)] for i in range(5)],
    *[scatter(random.Random(s), d, n) for s, (d, n) in enumerate([(2, 9), (6, 3), (9, 40), (13, 100)])],
]


@pytest.mark.parametrize("matrix", MATRICES)
def test_characteristic_polynomial(spark, matrix):
    assert W.characteristic_polynomial(spark, matrix) == slow_polynomial(matrix)


@pytest.mark.parametrize("matrix", MATRICES)
def test_roots_and_components(matrix):
    polynomial = slow_polynomial(matrix)
    roots = W.largest_roots(polynomial, 4)
    want = [e for e in np.linalg.eigvalsh(np.array(matrix, float))[::-1][:4] if e > 1e-6]
    got = [(2 * r.low + 1) / (1 << (r.bits + 1)) for r in roots]
    assert got == pytest.approx(want, rel=1e-9)
    v = np.array([[float(x) for x in c] for c in W.components(matrix, roots)]).reshape(-1, len(matrix))
    assert np.abs(v @ v.T - np.eye(len(v))).max(initial=0) < 1e-14
    assert np.abs(v @ np.array(matrix, float) - np.array(got)[:, None] * v).max(initial=0) <= 1e-12 * max([1, *want])
    assert W.identity_error(matrix, v, np.array(got)) < 1e-12


def test_close_roots_are_told_apart():
    a, b = 10**30, 10**30 + 1
    polynomial = [a * b, -(a + b), 1]
    assert W.squarefree(polynomial) and not W.squarefree([a * a, -2 * a, 1])
    assert [r.low >> r.bits for r in W.largest_roots(polynomial, 2)] == [b - 1, a - 1]


def test_primes():
    assert [n for n in range(60) if W.is_prime(n)] == [n for n in range(2, 60) if all(n % k for k in range(2, n))]
    assert W.primes_below(100, 97 * 89) == [97, 89, 83]


@pytest.mark.parametrize("size", [5, 1 << 21, 1 << 40, (1 << 63) - 1])
def test_products_are_exact(size):
    rng = random.Random(size)
    x = [[rng.randint(-size, size) for _ in range(3)] for _ in range(20)]
    want = [[sum(r[i] * r[j] for r in x) for j in range(3)] for i in range(3)]
    assert W.products(np.array(x, np.int64)).tolist() == want
    assert all(sum(p << W.LIMB * k for k, p in W._limbs(v)) == v for v in (0, 1, -1, 3**90, -(3**90)))


def check(found, rows, id_of=lambda r: r[0]):
    """Results against numpy, for rows (id, vector); None if they have no fit."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = Counter(len(v) for _, v in good)
    if sizes:
        d = max(sizes, key=lambda n: (sizes[n], n))
        good = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in good if len(v) == d]
    fit = sorted({tuple(v) for _, v in good})
    if len(fit) < 2:
        assert not found
        return
    n, x = len(fit), np.array(fit, float)
    sums = [sum(c) for c in zip(*fit, strict=True)]
    centred = x - x.mean(axis=0)
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    k = min(4, int((e > 1e-9).sum()))
    e, axes = e[::-1][:k], axes[:, ::-1][:, :k]
    assert len(found) == k * len(good)
    total = (centred**2).sum() / n
    by_component = [sorted((r for r in found if r["component"] == c + 1), key=repr) for c in range(k)]
    for c, part in enumerate(by_component):
        assert {r["n"] for r in part} == {n}
        assert all(r["explained"] == pytest.approx(e[c] / total, rel=1e-9) and r["identity_error"] < 1e-9 for r in part)
    want = Counter((i, sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True))) for i, v in good)
    assert Counter((r["id"], r["deviation"]) for r in by_component[0]) == want
    gaps = np.abs(np.diff(np.linalg.eigvalsh(centred.T @ centred / n)[::-1][: k + 1]))
    if len(gaps) < k or gaps.min() > 1e-6:
        for c in range(k):
            w = (np.array([v for _, v in good], float) - x.mean(axis=0)) @ axes[:, c] / math.sqrt(e[c])
            got = sorted((r["whitened"] for r in by_component[c]))
            assert got == pytest.approx(sorted(w), abs=1e-9) or got == pytest.approx(sorted(-w), abs=1e-9)


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    check(W.whitened(df).collect(), [(r["vec_id"], r["embedding"]) for r in df.collect()])


SCHEMA = "vec_id bigint, embedding array<float>, vector string, id string, n int"
EDGES = [
    (1, [0.5, 0.25, 0.0]), (1, [0.5, 0.25, 0.0]), (2, [0.5, 0.25, -0.0]), (3, None), (4, []), (5, [1.0, None, 0.0]),
    (6, [float("nan"), 0.0, 0.0]), (7, [float("inf"), 0.0, 0.0]), (8, [1.0, 2.0]), (None, [-0.3, 0.1, 0.7]),
    (9, [0.001, 0.9, 0.2]), (10, [-1.0, -0.004, 0.3]), (11, [0.0, 0.0, 0.0]),
]


def edge_frame(spark, rows):
    return spark.createDataFrame([(*r, "own", "own", 0) for r in rows], SCHEMA).repartition(3)


def test_edges(spark):
    check(W.whitened(edge_frame(spark, EDGES)).collect(), EDGES)


@pytest.mark.parametrize("rows", [[], EDGES[:3], EDGES[3:8], [(1, [1.0]), (2, [2.0]), (3, [4.5])]])
def test_few_rows(spark, rows):
    check(W.whitened(edge_frame(spark, rows)).collect(), rows)


def test_huge_entries(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [5.0, 2.0])]
    found = W.whitened(edge_frame(spark, rows)).collect()
    assert len(found) == 6 and {r["deviation"] for r in found if r["id"] in (1, 2)} == {None}
    assert all(math.isfinite(r["whitened"]) for r in found)
