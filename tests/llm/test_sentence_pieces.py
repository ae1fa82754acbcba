import random
import time

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from tablehaul.llm import double_array as D
from tablehaul.llm import sentence_pieces as S

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "",
    " ",
    "  a  b ",
    "日本語 テスト 😀",
    "a\nb\n\n c\t",
    "▁x ▁",
    "\x00\x01",
    "é" * 60,
    "x" * 300,
    "        indented",
    "ﷺ​",
]


@pytest.fixture(scope="module")
def pieces():
    with open(PATH, "rb") as f:
        return S.load_pieces(f.read())


@pytest.fixture(scope="module")
def library(pieces):
    """The library's own unigram Viterbi over the same pieces and scores."""
    with open(PATH, "rb") as f:
        spec = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    spec.trainer_spec.model_type = 1
    for i, piece in enumerate(spec.pieces):
        if piece.type == 1:
            piece.score = float(pieces.scores[i])
    return SentencePieceProcessor(model_proto=spec.SerializeToString())


def total(ids, p):
    return sum(float(p.scores[i]) for i in ids)


def test_double_array_holds_its_strings():
    strings = {w: i for i, w in enumerate([b"a", b"ab", b"abc", b"b\xff", b"\x00", b"\xe2\x96\x81", b"\xe2"])}
    trie = D.build(strings)

    def find(word):
        state = D.ROOT
        for c in word:
            to = int(trie.base[state]) + c
            if trie.check[to] != state:
                return -1
            state = to
        return int(trie.value[state])

    assert {w: find(w) for w in strings} == strings
    assert [find(w) for w in (b"", b"abcd", b"b", b"c", b"\xe2\x96")] == [-1] * 5


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_like_the_library(pieces, library, text):
    ids = S.Encoder(pieces).encode([text])[0].tolist()
    assert ids == library.encode(text)
    assert S.decode(ids, pieces) == library.decode(ids)
    assert "▁" in text or S.decode(ids, pieces) == text


def test_documents_like_the_library(pieces, library, texts):
    """Equal up to ties, which single precision breaks differently in long texts."""
    source = list(texts.values())
    found = S.Encoder(pieces).encode(source)
    same = 0
    for text, ids in zip(source, found, strict=True):
        want = library.encode(text)
        same += want == ids.tolist()
        assert total(ids.tolist(), pieces) == pytest.approx(total(want, pieces), rel=1e-6)
    assert same > 0.9 * len(source)


def one_by_one(unit, p):
    """The best pieces of a unit, place after place, in the whole-number scores of long units."""
    n, chars = len(unit), S._character_lengths(np.frombuffer(unit, np.uint8)).tolist()
    best, back = [0] + [None] * n, [None] * (n + 1)

    def meet(i, j, number, score):
        sum_ = best[i] + int(np.rint(np.float64(np.float32(score)) * S.SHARES))
        if best[j] is None or sum_ > best[j]:
            best[j], back[j] = sum_, (i, number)

    for i in range(n):
        if not chars[i]:
            continue
        state, unknown = D.ROOT, True
        for j in range(i, n):
            to = int(p.trie.base[state]) + unit[j]
            if p.trie.check[to] != state:
                break
            state, number = to, int(p.trie.value[to])
            if number >= 0:
                unknown = unknown and j + 1 - i != chars[i]
                meet(i, j + 1, number, p.score(np.array([number]), j + 1 - i)[0])
        if unknown:
            meet(i, i + chars[i], -1, p.unknown)
    out, at = [], n
    while at:
        i, number = back[at]
        out.append([number] if number >= 0 else p.bytes_at[list(unit[i:at])].tolist())
        at = i
    return [x for part in reversed(out) for x in part]


def test_one_and_many_side_by_side_agree(pieces, texts):
    units = sorted({u.encode() for t in list(texts.values())[:30] for u in S.UNIT.findall(t.replace(" ", S.MARK))})
    many = [m.tolist() for m in S.encode_units(units, pieces)]
    one = [one_by_one(u, pieces) for u in units]
    assert [total(m, pieces) for m in many] == pytest.approx([total(o, pieces) for o in one], rel=1e-6)
    # Only where sums tie does single precision choose otherwise.
    assert sum(m != o for m, o in zip(many, one, strict=True)) <= 0.01 * len(units)


RNG = random.Random(3)
LONG_UNITS = {
    "latin": "".join(RNG.choice(["the", "ing", "re", "qu", "xyz", "a", "tion", "er", "z", "Q9"]) for _ in range(700)),
    "chinese": "".join(
        chr(RNG.randint(0x4E00, 0x4FFF)) if RNG.random() < 0.3 else RNG.choice("的一是不了人我在有他这中国文学生大")
        for _ in range(700)
    ),
    "base64": "".join(RNG.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=1500)),
    "repeated": "x" * 1500,
    "periodic": "ab" * 500,
    "signs": "=" * 700 + "-" * 300,
    "markers": "▁" * 400,
    "emoji": "😀é" * 200,
    "no pieces": "\U0001f9ff" * 300,
}


@pytest.mark.parametrize(("own", "slab"), [(1024, 1 << 17), (200, 5000), (60, 1 << 17)])
def test_long_units_like_one_by_one(monkeypatch, pieces, own, slab):
    """Also where the sums of runs do not agree and are continued, as in repetitive units."""
    monkeypatch.setattr(S, "OWN", own)
    monkeypatch.setattr(S, "SLAB", slab)
    units = [u.encode() for u in LONG_UNITS.values()] + [LONG_UNITS["latin"][:n].encode() for n in (1, 49, 300)]
    continued, again = [], S._continued
    monkeypatch.setattr(S, "_continued", lambda *a: (continued.append(1), again(*a)))
    assert [x.tolist() for x in S.encode_long(units, pieces)] == [one_by_one(u, pieces) for u in units]
    assert own == 1024 or continued


def test_long_units_take_linear_time(pieces):
    """Chinese, Latin and base64 without spaces: far from the square of the length."""
    for name in ("latin", "chinese", "base64"):
        unit, took = LONG_UNITS[name].encode(), []
        for times in (40, 160):
            start = time.process_time()
            S.encode_long([unit * times], pieces)
            took.append(time.process_time() - start)
        assert took[1] < 8 * took[0] + 0.5, (name, took)


def test_forgetting_changes_nothing(monkeypatch, pieces, texts):
    source = list(texts.values())[:40]
    want = [x.tolist() for x in S.Encoder(pieces).encode(source)]
    monkeypatch.setattr(S, "REMEMBERED", 10)
    encoder = S.Encoder(pieces)
    assert [encoder.encode([t])[0].tolist() for t in source] == want


def test_frames(pieces, edges, nothing):
    out = S.encoded(edges, PATH)
    found = sorted((tuple(r) for r in out.select("id", "ids", "n_pieces", "lossless").collect()), key=repr)
    encoder = S.Encoder(pieces)
    want = []
    for r in edges.collect():
        ids = encoder.encode([r["text"]])[0].tolist()
        want.append((r["doc_id"], ids, len(ids), "▁" not in (r["text"] or "")))
    assert found == sorted(want, key=repr)
    back = S.decoded(out, PATH, "id").collect()
    clean = lambda t: (t or "").replace("▁", " ")
    assert sorted(((r["id"], r["text"]) for r in back), key=repr) == sorted(
        ((r["doc_id"], clean(r["text"])) for r in edges.collect()), key=repr
    )
    assert S.encoded(nothing, PATH).count() == 0
