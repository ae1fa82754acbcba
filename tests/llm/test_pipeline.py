"""run() against a brute-force version of every stage."""

from collections import defaultdict

import public_tokenizers
import pytest

import corpus_pipeline
from tablehaul.llm import language_id as L
from tablehaul.llm import sentence_pieces as S
from tests.conftest import SF
from tests.llm.test_mixing import slow_targets, words
from tests.llm.test_simhash import groups, slow_fingerprint


@pytest.fixture(scope="module")
def survivors(docs):
    """Rows (doc_id, text, source) before the mix."""
    classifier = L.Classifier(L.learned(docs, "doc_id", "text", "lang", 4, 2))
    rows = []
    for r in docs.collect():
        lang, _, margin = classifier.predict(r["text"])
        if lang != "und" and margin >= L.MARGIN:
            rows.append((r["doc_id"], r["text"], r["source"]))
    last = {}
    for row in sorted(rows):
        last[row[1]] = row
    rows = sorted(last.values())
    of = groups([slow_fingerprint(t) for _, t, _ in rows], lambda a, b: (a ^ b).bit_count() <= 3)
    return [row for i, row in enumerate(rows) if of[i] == i]


def test_stages_keep_the_columns(spark, docs, edges):
    for frame in (docs, edges, edges.where("false")):
        at = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            at = stage(spark, at, SF)
            assert at.columns == frame.columns
            at.count()
        assert corpus_pipeline.STAGES[-1][1](spark, at, SF).columns[0] == "doc_id"


def test_run_like_brute_force(spark, survivors):
    found = corpus_pipeline.run(spark, SF).collect()
    texts = {i: t for i, t, _ in survivors}
    assert {r["doc_id"] for r in found} <= set(texts)
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        encoder = S.Encoder(S.load_pieces(f.read()))
    times = defaultdict(int)
    for r in found:
        times[r["doc_id"]] += 1
        assert r["ids"] == encoder.encode([texts[r["doc_id"]]])[0].tolist()
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, t, s in survivors:
        sizes[s] += words(t)
        taken[s] += words(t) * times[i]
        largest[s] = max(largest[s], words(t))
    for s, target in slow_targets(sizes).items():
        assert abs(taken[s] - target) <= largest[s] / 2 + 1e-6
    assert max(times.values()) <= 2
