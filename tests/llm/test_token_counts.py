import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablehaul.llm import token_counts as T

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "a<|endoftext|>b <|endoftext|>",
    "  \n\n x\x1c\x1d y\x85z w",
    "'s 't's don't I'LL",
    " ",
    "=-" * 400 + "é" * 300,
    "١٢٣ ½²Ⅷ",
    "😀👍🏽",
    "\x00\x01",
    "x" * 5000,
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def counts():
    with open(PATH, encoding="utf-8") as f:
        spec = f.read()
    return T._Counts(spec, T.whole_tokens(spec))


def test_whole_tokens_are_proven(counts, library):
    assert len(counts.whole) > 40_000
    assert all(library(t) == 1 for t in sorted(counts.whole)[::97])


def test_odd_texts(counts, library):
    assert [counts.of_text(t) for t in ODD] == [library(t) for t in ODD]


def test_every_character(counts, library):
    for cp in [*range(0x3000), *range(0xA000, 0xAC00), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800)]:
        text = f"a{chr(cp)} {chr(cp)}{chr(cp)}1 {chr(cp)}b"
        assert counts.of_text(text) == library(text), hex(cp)


def test_like_the_library(docs, edges, nothing, texts, library):
    for frame in (docs, edges):
        source = sorted((r["doc_id"] is None, r["doc_id"], r["text"] or "") for r in frame.collect())
        rows = T.token_counts(frame, PATH).collect()
        found = sorted((r["id"] is None, r["id"], r["n_tokens"], r["n_bytes"], r["over_limit"]) for r in rows)
        want = sorted(
            (n, i, library(t), len(t.encode()), library(t) > 512) for n, i, t in source
        )
        assert found == want
    assert T.token_counts(nothing, PATH).count() == 0
