import math
import pickle
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tablehaul.llm import quality_classifier as C
from tablehaul.llm import quality_rules as R
from tablehaul.llm.text_stats import FIELDS, repeated_words, text_stats
from tests.conftest import SF


def slow_base(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words by their definitions."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def check(found, rows):
    got, want = [], []
    for r in found:
        got.append((r["id"], *(r[c] for c in BASE), r["base_failed"]))
        assert not (r["kept"] and r["base_failed"]) and 0 <= r["p_good"] <= 1
    for i, t in rows:
        base = slow_base(t)
        want.append((i, *base, base[0] < 20 or 100 * base[4] > 30 * base[0]))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_base_like_brute_force(docs, texts):
    check(R.judged(docs).collect(), list(texts.items()))


def test_edges(edges, nothing):
    check(R.judged(edges).collect(), [(r["doc_id"], r["text"]) for r in edges.collect()])
    assert R.judged(nothing).count() == 0


def test_repeated_words_of_small_alphabets():
    rng = random.Random(4)
    for n in [*range(12), 40, 90]:
        for _ in range(30):
            words = [rng.choice("ab") for _ in range(n)]
            assert repeated_words([w.encode() for w in words]) == slow_base(" ".join(words))[4]


@pytest.mark.parametrize(("folder", "lost"), [(SF, 0), ("/root/testdata/sf0.01", 0.01)])
def test_posterior_finds_the_labels(spark, folder, lost):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = R.judged(docs).join(labels.withColumnRenamed("doc_id", "id"), "id").collect()
    rows = [r for r in rows if not r["base_failed"]]
    good = [r["kept"] for r in rows if r["quality"] == 1]
    assert good.count(False) <= lost * len(good)
    assert all(not r["kept"] for r in rows if r["quality"] == 0)


def test_verdict_is_not_that_all_rules_must_pass(spark):
    """On a whole table: kept in spite of bad votes, dropped by votes that each alone would not do, and, by the
    labels, right at least as often."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    names = [f"vote_{r.name}" for r in R.RULES]
    judged = R.judged(docs)
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = [r for r in judged.collect() if not r["base_failed"]]
    against = lambda r: frozenset(c for c in names if r[c] < 0)
    spared = [r for r in rows if r["kept"] and against(r)]
    alone = {next(iter(against(r))) for r in spared if len(against(r)) == 1}
    together = [r for r in rows if not r["kept"] and len(against(r)) > 1 and against(r) <= alone]
    right = lambda verdict: sum(verdict(r) == bool(known[r["id"]]) for r in rows if known.get(r["id"]) is not None)
    by_posterior, by_all = right(lambda r: r["kept"]), right(lambda r: not against(r))
    print(len(spared), len(together), by_posterior, by_all, len(rows))
    assert len(spared) >= 10 and by_posterior >= by_all


def drawn(rng, n, w):
    """Patterns of n texts drawn from the model, with a tenth of votes missing."""
    votes = Counter()
    for kind in rng.choices(range(len(w.shares)), w.shares, k=n):
        votes[tuple(0 if rng.random() < 0.1 else (-1 if rng.random() < b else 1) for b in w.bad[kind])] += 1
    return sorted(votes.items())


def test_expectation_maximisation_finds_the_rates():
    w = R.belief()
    shares = np.array([0.85, 0.06, 0.04, 0.05])
    bad = np.where(w.bad >= 0.5, 0.75, 0.03)
    bad[0] = 0.004
    found = R.estimate(drawn(random.Random(1), 60_000, R.Weights(shares, bad)))
    assert found.shares == pytest.approx(shares, abs=0.01)
    assert found.bad == pytest.approx(bad, abs=0.06)


@pytest.mark.parametrize("wrong", [0.2, 0.3])
def test_a_rule_that_errs_on_good_texts_is_found_out(wrong):
    w = R.belief()
    bad = np.where(w.bad >= 0.5, 0.75, 0.03)
    bad[0] = [wrong if j == 4 else 0.004 for j in range(len(R.RULES))]
    found = R.estimate(drawn(random.Random(5), 40_000, R.Weights(np.array([0.85, 0.06, 0.04, 0.05]), bad)))
    assert found.bad[0, 4] == pytest.approx(wrong, abs=0.03)
    one_against = np.array([-1 if j == 4 else 1 for j in range(len(R.RULES))])
    assert found.posterior(one_against)[0] > 0.9


def test_estimate_without_texts():
    w = R.estimate([])
    assert w.good == R.GOOD and w.posterior(np.zeros(len(R.RULES)))[0] == pytest.approx(R.GOOD)


def test_column_and_plain_posterior_agree(spark):
    w = R.estimate(drawn(random.Random(3), 500, R.belief()))
    rng = random.Random(2)
    rows = [tuple(rng.choice((-1, 0, 1)) for _ in R.RULES) for _ in range(50)]
    frame = spark.createDataFrame(rows, ", ".join(f"vote_{r.name} int" for r in R.RULES))
    for r in frame.withColumn("p", R.posterior(w)).collect():
        assert r["p"] == pytest.approx(w.posterior(np.array(r[:-1]))[0])


def test_counts_of_an_empty_text():
    assert text_stats(None) == text_stats("") == (0,) * len(FIELDS)


def test_scores_are_the_log_density_difference():
    rng = np.random.default_rng(3)
    sums = {}
    for k in (0, 1):
        x = rng.normal(k, 1 + k, (500, 4))
        sums[k] = (500.0, x.sum(0), x.T @ x)
    model = C.fit(sums, 0.1, 0.02)
    x = rng.normal(0.5, 1.5, (20, 4))
    odds = np.full(20, model.bias)
    for sign, mean, factor in zip((-1, 1), model.means, model.factors, strict=True):
        covariance = factor @ factor.T
        off = x - mean
        odds += sign * -0.5 * (
            np.einsum("ij,jk,ik->i", off, np.linalg.inv(covariance), off) + np.log(np.linalg.det(covariance))
        )
    assert model.scores(x) == pytest.approx(1 / (1 + np.exp(-odds)))


def test_factors_are_inverted_once(monkeypatch):
    """However many batches are scored, also after the model was sent to a worker."""
    rng, sums = np.random.default_rng(8), {}
    for k in (0, 1):
        x = rng.normal(k, 1, (200, 3))
        sums[k] = (200.0, x.sum(0), x.T @ x)
    model = pickle.loads(pickle.dumps(C.fit(sums, 0.1, 0.02)))
    calls, inv = [], np.linalg.inv
    monkeypatch.setattr(np.linalg, "inv", lambda f: calls.append(1) or inv(f))
    x = rng.normal(0, 1, (40, 3))
    parts = [model.scores(x[i : i + 7]) for i in range(0, 40, 7)]
    assert len(calls) == 2 and np.concatenate(parts) == pytest.approx(model.scores(x))
    assert len(model.scores(x[:0])) == 0


def test_held_out_labels_are_predicted(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    out = C.quality_scores(docs, labels)
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    held = [(r["predicted"], known[r["id"]]) for r in rows if r["held_out"] and r["id"] in known]
    assert np.mean([p == q for p, q in held]) > 0.95


def test_classifier_edges(spark, edges, nothing):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (7, 1), (8, 0), (9, None), (None, 1), (3, 7), (10, 1), (10, 0)], "doc_id bigint, quality int"
    )
    for known in (labels, labels.where("quality = 1"), labels.where("false")):
        rows = C.quality_scores(edges, known).collect()
        assert len(rows) == edges.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in C.quality_scores(edges, labels.where("false")).collect()} == {0.5}
    assert C.quality_scores(nothing, labels).count() == 0


def test_scores_from_raw_rows(spark):
    """Features, class covariances, shrinkage and densities computed anew from the labelled texts."""
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = {r["id"]: r["score"] for r in C.quality_scores(docs, labels).collect()}
    at = {name: i for i, name in enumerate(FIELDS)}

    def row(text):
        s = text_stats(text)
        share = lambda of, by: math.log(s[at[of]] / max(s[at[by]], 1) + 0.01)
        return [
            math.log1p(s[at["n_words"]]),
            math.log(s[at["word_chars"]] / max(s[at["n_words"]], 1) + 1),
            share("n_symbols", "n_words"), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words"),
            share("n_adjacent", "n_words"), share("n_distinct", "n_words"), share("n_upper", "word_chars"),
            share("n_exclaim", "n_words"), share("n_marks", "n_words"), share("n_digits", "word_chars"),
            share("n_lines", "n_words"),
        ]

    x = {r["doc_id"]: row(r["text"]) for r in docs.collect()}
    learned = {0: [], 1: []}
    for r in labels.collect():
        if r["quality"] in (0, 1) and r["doc_id"] in x and zlib.crc32(str(r["doc_id"]).encode()) % 5:
            learned[r["quality"]].append(x[r["doc_id"]])
    part = {k: np.array(v) for k, v in learned.items()}
    own = {k: np.cov(v.T, bias=True) for k, v in part.items()}
    n = {k: len(v) for k, v in part.items()}
    pooled = sum(n[k] * own[k] for k in (0, 1)) / (n[0] + n[1])
    density = {}
    for k in (0, 1):
        c = 0.9 * own[k] + 0.1 * pooled
        c = 0.98 * c + 0.02 * max(np.trace(c) / 12, 1e-6) * np.eye(12)
        off = np.array(list(x.values())) - part[k].mean(axis=0)
        density[k] = -0.5 * (np.einsum("ij,jk,ik->i", off, np.linalg.inv(c), off) + np.linalg.slogdet(c)[1])
    share = (n[1] + 0.5) / (n[0] + n[1] + 1)
    odds = math.log(share / (1 - share)) + density[1] - density[0]
    want = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
    assert [found[i] for i in x] == pytest.approx(want.tolist(), abs=1e-6)
