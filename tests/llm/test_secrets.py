import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from tablehaul.llm import secrets as S

#: The patterns as stated; failing matches are dropped, nothing is retried.
PATTERNS = {
    "assign": (
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m[2]) >= 8,
    ),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
}
ODD = [
    None,
    "",
    "password: hunter2hunter2",
    'API_KEY = "abcdefgh", apikey=\'short\'',
    "secret=token=abcdefgh1 toKen  :   12345678",
    "ſecret=abcdefghij toKen=abcdefghij",
    "AKIAAKIA12345 xAKIA" + "Z" * 12 + " AKIA123456789012",
    "0" * 31 + " " + "a" * 32 + "g" + "deadbeef" * 5,
    "token=" + "0123456789abcdef" * 3,
    "password" + " " * 5000 + "x",
]


def slow(text):
    found = []
    for kind, (pattern, ok) in PATTERNS.items():
        found += [(kind, *m.span()) for m in re.finditer(pattern, text or "") if ok(m)]
    return sorted(found, key=lambda s: (s[1], S.KINDS.index(s[0]), s[2]))


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def check(found, rows):
    got = sorted(((r["id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in found), key=repr)
    want = []
    for i, t in rows:
        spans = slow(t)
        counts = [sum(k == kind for k, _, _ in spans) for kind in S.KINDS[:3]]
        want.append((i, *counts, hashlib.sha256(joined(spans).encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_base_spans():
    assert [S.base_spans(t or "") for t in ODD] == [slow(t) for t in ODD]


def test_like_brute_force(docs, texts):
    check(S.secret_digest(docs).collect(), list(texts.items()))


def test_edges(spark, edges, nothing):
    check(S.secret_digest(edges).collect(), [(r["doc_id"], r["text"]) for r in edges.collect()])
    assert S.secret_digest(nothing).count() == 0
    odd = spark.createDataFrame(list(enumerate(ODD)), "doc_id bigint, text string")
    check(S.secret_digest(odd).collect(), list(enumerate(ODD)))


@pytest.mark.parametrize("name", sorted(S.ALPHABETS))
def test_random_tokens_have_even_p_values(name):
    rng = random.Random(7)
    letters = S.ALPHABETS[name]
    p = [S.randomness("".join(rng.choices(letters, k=48)), name) for _ in range(1500)]
    for share in (0.05, 0.25, 0.5):
        assert np.mean(np.array(p) < share) == pytest.approx(share, abs=0.06)


def test_writing_is_not_random(texts):
    p = []
    for text in texts.values():
        joined_words = "".join(w.capitalize() for w in re.findall("[A-Za-z]+", text))
        p += [S.randomness(joined_words[i : i + 40], "base62") for i in range(0, len(joined_words) - 40, 500)]
    assert np.quantile(p, 0.95) < 0.01


def test_encodings():
    assert S.encoding("deadbeef01") == S.encoding("DEADBEEF01") == "hex"
    assert S.encoding("MZXW6YTBOI") == "base32"
    assert S.encoding("aZ09") == "base62"
    assert S.encoding("aZ+/") == S.encoding("aZ-_") == "base64"
    assert S.encoding("0123456789") is None and S.encoding("a+b-") is None


def test_thresholds_control_the_false_discovery_rate():
    """By hand: the least bin b with p(b) * tokens <= rate * tokens at b or above."""
    rng = random.Random(9)
    normal = {("x", b): rng.randint(0, 400) if b < 25 else 0 for b in range(S.BINS)}
    tokens = {("x", b): rng.randint(0, 3) for b in range(S.BINS)} | {("y", 40): 5}
    least = S.thresholds(tokens, normal, 0.02)
    windows, total = sum(normal.values()), sum(n for (c, _), n in tokens.items() if c == "x")
    good = [
        b
        for b in range(S.BINS)
        if sum(tokens["x", k] for k in range(b, S.BINS))
        and (1 + sum(normal["x", k] for k in range(b, S.BINS))) / (1 + windows) * total
        <= 0.02 * sum(tokens["x", k] for k in range(b, S.BINS))
    ]
    assert least == {"x": min(good)}


def test_planted_tokens_are_found(spark):
    rng = random.Random(11)
    rows, planted = [], {}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    for i, text in docs.collect():
        if i % 4 == 0:
            token = "".join(rng.choices(S.BASE62, k=40))
            planted[i] = (len(text) + 1, len(text) + 1 + len(token))
            text = f"{text} {token}"
        rows.append((i, text))
    found = S.find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    spans = {r["id"]: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == "random"] for r in found}
    hit = [i for i, at in planted.items() if at in spans[i]]
    assert len(hit) >= 0.8 * len(planted)
    assert not any(s for i, s in spans.items() if i not in planted)


def slow_ordinary(texts):
    """Distinct consecutive windows of every length over each whole stream, by (class, bin)."""
    met = set()
    for text in texts:
        text = S.writing(text or "")
        words = re.split("[^A-Za-z0-9]+", text)
        joined_words = "".join(w.capitalize() for w in words)
        streams = {
            "hex": re.sub("[^0-9a-f]", "", text),
            "base32": re.sub("[0189]", "", "".join(words).upper()),
            "base62": joined_words,
            "base64": joined_words,
        }
        for name, stream in streams.items():
            for n in S.LENGTHS:
                met |= {(name, n, stream[i : i + n]) for i in range(0, len(stream) - n + 1, n)}
    return Counter((f"{k}:{S.length_class(n)}", S.p_bin(S.randomness(w, k))) for k, n, w in met)


@pytest.mark.parametrize("piece", [480, 480 * 128])
def test_every_window_of_the_writing_counts_once(spark, texts, monkeypatch, piece):
    """Exactly in the upper bins, within five standard errors of the sketch below."""
    monkeypatch.setattr(S, "PIECE", piece)
    some = [*list(texts.values())[:12], None, "", "ünï Ⅳ " * 30, "abcdef " * 400, "Zq7 xK2 Lm9 rT4 " * 3]
    want = slow_ordinary(some)
    seen = [np.stack([c, h.view(np.int64)]) for c, h in S.tested_windows([*some, *some[:5]])]
    exact = Counter((np.unique(np.concatenate(seen, axis=1), axis=1)[0]).tolist())
    cell = lambda kind, b: S._first_cell(kind[:-2], int(kind[-1])) + b
    assert exact == {cell(*k): n for k, n in want.items()}
    frame = spark.createDataFrame(list(enumerate([*some, *some[:5] * 40])), "doc_id bigint, text string")
    found = S.ordinary(frame.repartition(5))
    assert set(found) == set(want)
    for (kind, b), n in want.items():
        upper = b >= S.EXACT[int(kind[-1])]
        assert found[kind, b] == n if upper else abs(found[kind, b] - n) <= max(3, 5 * 0.033 * n)


@pytest.mark.parametrize("n", [0, 1, 30, 1000, 2500, 100_000])
def test_sketches_merge_and_keep_their_error(n):
    rng = np.random.default_rng(n)
    hashes = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64)
    parts = []
    for some in (hashes[: n // 2], hashes[n // 3 :], hashes[:10]):
        registers = S._registers()
        S.sketch(registers, np.full(len(some), 5), some)
        parts.append(registers)
    merged = np.maximum.reduce(parts).reshape(-1, 1 << S.SKETCH_BITS)
    assert not merged[:5].any() and not merged[6:].any()
    assert S.estimated(merged[5]) == pytest.approx(n, rel=4 * 0.033, abs=1)


LETTERS = {**S.ALPHABETS, "HEX": "0123456789ABCDEF"}


@pytest.fixture(scope="module")
def recall(spark):
    """Share of planted tokens found, by encoding and length, and spans beside them."""
    rng = random.Random(21)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    kinds = [(name, n) for name in sorted(LETTERS) for n in (20, 24, 32, 40)]
    rows, planted = [], {}
    for k, (i, text) in enumerate(docs.collect()):
        if k % 2:
            name, n = kinds[k // 2 % len(kinds)]
            planted[i] = (name, n, (len(text) + 1, len(text) + 1 + n))
            text = f"{text} {''.join(rng.choices(LETTERS[name], k=n))}"
        rows.append((i, text))
    found = S.find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    spans = {r["id"]: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] != "assign"] for r in found}
    tried, hit = Counter(), Counter()
    for i, (name, n, at) in planted.items():
        tried[name, n] += 1
        hit[name, n] += at in spans[i]
    others = sum(len(s) for i, s in spans.items() if i not in planted)
    return {k: hit[k] / tried[k] for k in kinds}, others


@pytest.mark.parametrize("name", sorted(LETTERS))
def test_recall_by_length_and_encoding(recall, name):
    share, _ = recall
    print(share)
    assert all(share[name, n] >= 0.8 for n in (24, 32, 40)), share
    assert share[name, 20] >= 0.6, share


def test_little_else_is_reported(recall):
    assert recall[1] <= 10


def test_what_is_found_is_left_out_of_the_writing():
    token = "q7Xk2LmP9rTb4VnW8sYc1ZdF"
    text = f"some words password=hunter2hunter2 then {token} and {'ab12' * 10} end"
    assert S.writing(text) == "some words   then   and   end"
    assert S.writing("nothing here") == "nothing here"


TOKEN40 = "q7Xk2LmP9rTb4VnW8sYc1ZdFh5GjK3uR6aEoB0iS"
AWS = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"


@pytest.mark.parametrize(
    ("text", "token"),
    [
        (f"export DB_PASS={TOKEN40} now", TOKEN40),
        (f"AWS_SECRET_ACCESS_KEY={AWS}", AWS),
        (f"see example.com/get?a=1&sig={TOKEN40}== end", f"{TOKEN40}=="),
        (f"my-app/v1/{TOKEN40}", TOKEN40),
        (f"prod_access_{TOKEN40}", TOKEN40),
        (f"config-main-{AWS}", AWS),
        (f"/srv/data/{TOKEN40}_{TOKEN40[::-1]}/file", f"{TOKEN40}_{TOKEN40[::-1]}"),
        (f"{TOKEN40}=", f"{TOKEN40}="),
    ],
)
def test_tokens_joined_to_other_things_have_their_own_span(text, token):
    everything = {f"{name}:{k}": 0 for name in S.ALPHABETS for k in range(len(S.LENGTHS))}
    spans = S.chosen(S.candidates(text, S.base_spans(text)), everything)
    assert token in [text[s:e] for s, e in spans]


def test_joined_planted_tokens_are_found(spark):
    rng = random.Random(12)
    rows, planted = [], {}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    for i, text in docs.collect():
        if i % 4 == 0:
            token = "".join(rng.choices(S.BASE62, k=40))
            text += (" DB_PASS=", " my-app/v1/", " prod_access_", " ?a=1&sig=")[i // 4 % 4] + token
            planted[i] = (len(text) - len(token), len(text))
        rows.append((i, text))
    found = S.find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    spans = {r["id"]: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == "random"] for r in found}
    assert sum(at in spans[i] for i, at in planted.items()) >= 0.8 * len(planted)
    assert not any(s for i, s in spans.items() if i not in planted)
