"""Secrets in texts: patterns of known kinds, and a battery of randomness tests for the rest.

The patterns find assignments to secret names, access key ids and long hexadecimal strings. Any
other long run of token characters is cut at inner "=" and tested for being random, whole and
in its parts between the signs "/", "_", "-" and "+" that may join it to words; of parts that
lie in each other the longest without words is reported. The encoding (hexadecimal, base32, base62, base64) is
inferred, and over that alphabet a chi-squared test of uniformity, the same over the kinds of symbols (capitals,
small letters, digits, signs), a runs test about the middle of the alphabet and a test of lag-one serial
correlation give four p-values, combined by Fisher's method.

How random ordinary writing of the same length and alphabet looks is measured, not assumed:
the writing of every whole text, without the spans and tokens found in it, is cut into
consecutive windows of every length class, which are tested in the same way. Equal windows
count once, however many texts repeat them. In the upper bins, where thresholds lie, they are
counted by their shuffled 64-bit hashes. In the others a task enters them into a sketch of a fixed size
(HyperLogLog, a standard error of 3.3 % of the count), and sketches merge by maximum, so
neither a task's memory nor, but for the few upper windows, what is shuffled grows with the text. A token's
p-value is the share of such windows, of its length class and alphabet, that look as random;
within each class the false discovery rate is controlled at ``rate`` (Benjamini-Hochberg). The counts are a table
of classes by BINS, bounded whatever the input.

Defined results: a null text counts as empty and has no spans. Texts of any length are searched
whole. Offsets are code points, ends exclusive; spans are ordered by start, then by kind as in
KINDS, then by end. Rows are searched each for itself, except that the classes' thresholds come
from all rows. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.llm.common import durable, id_and_text, map_arrow, map_texts

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
# A run of the class is taken whole or not at all, so the least length may stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")

LEAST = 20
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
#: Lower ends of the length classes.
LENGTHS = (20, 24, 32, 48, 80)
#: Logarithmic classes of the combined p-value: four to a power of ten.
BINS = 41
#: Windows are tested so many characters at a time; a multiple of all of LENGTHS, so none is torn.
PIECE = 480 * 256
#: By length class, the bin from which windows are counted exactly. Of writing in any script seen so far a few
#: per cent lie there, and a threshold lies where ``rate`` of it does. A task hands on GATHER hashes at once.
EXACT, GATHER = (37, 35, 30, 20, 20), 1 << 20
#: Below, by sketches of 2^SKETCH_BITS registers: a standard error of 1.04 / 2^(SKETCH_BITS / 2), 3.3 %.
SKETCH_BITS = 10

LOWER = "abcdefghijklmnopqrstuvwxyz"
DIGITS = "0123456789"
BASE62 = LOWER.upper() + LOWER + DIGITS
ALPHABETS = {
    "hex": DIGITS + "abcdef",
    "base32": LOWER.upper() + "234567",
    "base62": BASE62,
    "base64": BASE62 + "+/",
}
_VALUE = {name: {c: i for i, c in enumerate(letters)} for name, letters in ALPHABETS.items()}
#: Where the kinds of symbols of an alphabet (capitals, small letters, digits, signs) end.
SORTS = {"hex": (10, 16), "base32": (26, 32), "base62": (26, 52, 62), "base64": (26, 52, 62, 64)}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the known kinds, ordered."""
    out = []
    lower = text.lower()
    if any(name in lower for name in NAMES):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def encoding(token: str) -> str | None:
    """The smallest alphabet that holds the token; None for digits alone and for mixtures."""
    letters = set(token)
    if letters <= set(DIGITS):
        return None
    if letters <= set(ALPHABETS["hex"]) or letters <= set(DIGITS + "ABCDEF"):
        return "hex"
    for name in ("base32", "base62", "base64"):
        if letters <= set(ALPHABETS[name]):
            return name
    return "base64" if letters <= set(BASE62 + "-_") else None


def _values(token: str, name: str) -> list[int]:
    if name == "hex":
        token = token.lower()
    value = _VALUE[name]
    return [value[c] for c in token.replace("-", "+").replace("_", "/")]


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def uniformity(values: list[int], k: int) -> float:
    """Chi-squared test that all k symbols are equally likely (Wilson-Hilferty approximation)."""
    n = len(values)
    x = sum(c * c for c in Counter(values).values()) * k / n - n
    df = k - 1
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)) if x > 0 else -5.0
    return 0.5 * math.erfc(z / math.sqrt(2))


def runs(values: list[int], k: int) -> float:
    """Test of the number of runs above and below the middle of the alphabet."""
    high = [2 * v >= k for v in values]
    n, a = len(high), sum(high)
    b = n - a
    if not a or not b:
        return 2.0 ** (1 - n)
    mean = 2 * a * b / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    count = 1 + sum(x != y for x, y in zip(high, high[1:], strict=False))
    return _two_sided((count - mean) / math.sqrt(var)) if var > 0 else 1.0


def serial(values: list[int]) -> float:
    """Test of the correlation between neighbouring symbols."""
    n = len(values)
    mean = sum(values) / n
    off = [v - mean for v in values]
    spread = sum(o * o for o in off)
    if not spread:
        return 0.0
    r = sum(x * y for x, y in zip(off, off[1:], strict=False)) / spread
    return _two_sided((r + 1 / n) * math.sqrt(n))


def _chi_tail(x: float, df: int) -> float:
    """Chance that a chi-squared value of one to three degrees of freedom exceeds x."""
    x = max(x, 0.0)
    if df == 2:
        return math.exp(-x / 2)
    return math.erfc(math.sqrt(x / 2)) + (math.sqrt(2 * x / math.pi) * math.exp(-x / 2) if df == 3 else 0.0)


def sorts(values: list[int], name: str) -> float:
    """Chi-squared test that each kind of symbol is as frequent as it is in the alphabet.

    It has power where a token is too short for the alphabet's single symbols.
    """
    ends, n = SORTS[name], len(values)
    counts = Counter(bisect_right(ends, v) for v in values)
    x = sum(counts[i] ** 2 * ends[-1] / (e - s) for i, (s, e) in enumerate(zip((0, *ends), ends, strict=False))) / n - n
    return _chi_tail(x, len(ends) - 1)


def randomness(token: str, name: str) -> float:
    """Combined p-value of the battery: small for tokens that are not random."""
    values, k = _values(token, name), len(ALPHABETS[name])
    parts = (uniformity(values, k), sorts(values, name), runs(values, k), serial(values))
    half = -sum(math.log(max(p, 1e-300)) for p in parts)
    return math.exp(-half) * (1 + half + half * half / 2 + half**3 / 6)


def p_bin(p: float) -> int:
    """Class of a combined p-value: BINS - 1 looks most random."""
    return max(0, BINS - 1 + math.ceil(4 * math.log10(p))) if p > 1e-12 else 0


def length_class(n: int) -> int:
    return sum(n >= least for least in LENGTHS) - 1


_VALUE_PART, _ATOM = re.compile("[^=]+"), re.compile("[^/_+-]+")
#: Where a run is cut, besides at "=": not at all, or at so many signs that may join words.
_CUTS = (_VALUE_PART, *(re.compile(f"[^{signs}]+") for signs in ("/", "/+", "_-", "/_-", "/_+-")))
_WORD_ATOM = re.compile("[A-Za-z]?[a-z]{2,}|[A-Z]{3,}|[vV][0-9]{1,4}")


def _parts(piece: str) -> list[tuple[bool, int, int, str]]:
    """(whether words are joined to it, start, end, alphabet) of a piece's parts, best first.

    A part is the piece, what lies between signs of one kind, or a stretch without words.
    """
    spans = {m.span() for cut in _CUTS for m in cut.finditer(piece) if m.end() - m.start() >= LEAST}
    atoms = [(m.start(), m.end(), bool(_WORD_ATOM.fullmatch(m[0]))) for m in _ATOM.finditer(piece)]
    words, at = [0], None
    for s, e, word in [*atoms, (len(piece), len(piece), True)]:
        words.append(words[-1] + word)
        if word and at is not None:
            spans.add((at, last))
            at = None
        elif not word and at is None:
            at = s
        last = e
    starts, out = [s for s, _, _ in atoms], []
    for s, e in spans:
        name = encoding(piece[s:e]) if e - s >= LEAST else None
        if name is not None:
            i, j = bisect_left(starts, s), bisect_left(starts, e)
            out.append((j - i > 1 and words[j] > words[i], s, e, name))
    return sorted(out, key=lambda x: (x[0], x[1] - x[2], x[1]))


def _tested(text: str, taken: list[tuple[str, int, int]]) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, part, alphabet) of long parts of runs, clear of what the patterns have found.

    Parts of one piece may lie in each other; the better ones come first. "=" at the end of a
    run belongs to its last part.
    """
    ends = list(accumulate((e for _, _, e in taken), max))
    begins = [s for _, s, _ in taken]
    for m in TOKEN.finditer(text):
        run = m[0].rstrip("=")
        for piece in _VALUE_PART.finditer(run) if len(run) >= LEAST else ():
            if piece.end() - piece.start() < LEAST:
                continue
            for _, s, e, name in _parts(piece[0]):
                part, s, e = piece[0][s:e], m.start() + piece.start() + s, m.start() + piece.start() + e
                e = m.end() if e == m.start() + len(run) else e
                before = bisect_left(begins, e)
                if not before or ends[before - 1] <= s:
                    yield s, e, part, name


def candidates(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[int, int, str, int]]:
    """(start, end, class, bin) of long parts of tokens that no pattern has found."""
    return [
        (s, e, f"{name}:{length_class(len(part))}", p_bin(randomness(part, name)))
        for s, e, part, name in _tested(text, taken)
    ]


def chosen(found: Iterable[tuple[int, int, str, int]], least: dict[str, int]) -> list[tuple[int, int]]:
    """Spans of the candidates that pass, without those that meet a better one."""
    kept: list[tuple[int, int]] = []
    for s, e, kind, b in found:
        if b >= least.get(kind, BINS):
            i = bisect_left(kept, (e, 0))
            if not i or kept[i - 1][1] <= s:
                kept.insert(i, (s, e))
    return kept


def _value_table(letters: str, fold=str) -> np.ndarray:
    """Value by byte, of the letters as they are folded; 255 for other bytes."""
    out = np.full(256, 255, np.uint8)
    for b in range(128):
        if chr(b).isalnum() and fold(chr(b)) in letters:
            out[b] = letters.index(fold(chr(b)))
    return out


_HEX_VALUE = _value_table(ALPHABETS["hex"])
_BASE32_VALUE = _value_table(ALPHABETS["base32"], str.upper)
_FIRST_VALUE, _NEXT_VALUE = _value_table(BASE62, str.upper), _value_table(BASE62, str.lower)
_OTHER = {
    id(t): bytes(np.flatnonzero(t == 255).astype(np.uint8)) for t in (_HEX_VALUE, _BASE32_VALUE)
}
#: The alphabets that each stream of ``streams`` is tested over.
STREAMS = (("hex",), ("base32",), ("base62", "base64"))


def streams(text: str) -> list[np.ndarray]:
    """The writing as values of each alphabet of STREAMS.

    These are the text's own hexadecimal characters, its letters in capitals, and its words run
    together with capitals.
    """
    raw = text.encode("ascii", "replace")
    out = [
        np.frombuffer(raw.translate(table.tobytes(), _OTHER[id(table)]), np.uint8)
        for table in (_HEX_VALUE, _BASE32_VALUE)
    ]
    codes = np.frombuffer(raw, np.uint8)
    value = _NEXT_VALUE[codes]
    inside = value != 255
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    value[first] = _FIRST_VALUE[codes[first]]
    return [*out, value[inside]]


def writing(text: str) -> str:
    """The text with a blank for each span of a known kind and each candidate."""
    spans = base_spans(text)
    cut = sorted([(s, e) for _, s, e in spans] + [(s, e) for s, e, _, _ in _tested(text, spans)])
    out, last = [], 0
    for s, e in cut:
        if s > last:
            out.append(text[last:s])
        last = max(last, e)
    return " ".join([*out, text[last:]]) if cut else text


@cache
def _uniform_half(n: int, k: int) -> np.ndarray:
    """-log of the p-value of ``uniformity`` by the sum of squared counts."""
    out = np.zeros(n * n + 1)
    for squares in range(n, n * n + 1):
        x, df = squares * k / n - n, k - 1
        z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)) if x > 0 else -5.0
        out[squares] = -math.log(max(0.5 * math.erfc(z / math.sqrt(2)), 1e-300))
    return out


@cache
def _runs_half(n: int) -> np.ndarray:
    """-log of the p-value of ``runs`` by the number of high symbols and of changes."""
    out = np.full((n + 1, n), -math.log(2.0 ** (1 - n)))
    for a in range(1, n):
        mean = 2 * a * (n - a) / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        for changes in range(n):
            p = _two_sided((changes + 1 - mean) / math.sqrt(var)) if var > 0 else 1.0
            out[a, changes] = -math.log(max(p, 1e-300))
    return out


@cache
def _tails() -> np.ndarray:
    return np.array([-math.log(max(_two_sided(i / 1000), 1e-300)) for i in range(12_002)])


def _serial_half(z: np.ndarray) -> np.ndarray:
    """-log of two-sided p-values, between points a thousandth apart (right to 1e-6)."""
    at = np.minimum(z * 1000, 12_000.0)
    i = at.astype(np.int64)
    low = _tails()[i]
    return low + (at - i) * (_tails()[i + 1] - low)


@cache
def _sorts_half(df: int) -> np.ndarray:
    return np.array([-math.log(max(_chi_tail(i / 32, df), 1e-300)) for i in range(32 * 600)])


def _sorts(counts: list[np.ndarray], n: int, name: str) -> np.ndarray:
    """-log of the p-value of ``sorts`` by the symbols below each end but the last."""
    ends = SORTS[name]
    x, before = np.full(len(counts[0]), -float(n)), 0
    for s, e, upto in zip((0, *ends), ends, [*counts[: len(ends) - 1], n], strict=False):
        x += (upto - before) ** 2 * (ends[-1] / (e - s) / n)
        before = upto
    at = np.clip(x * 32, 0, 32 * 600 - 2)
    i = at.astype(np.int64)
    table = _sorts_half(len(ends) - 1)
    return table[i] + (at - i) * (table[i + 1] - table[i])


_MULTIPLIER = 0x9E3779B97F4A7C15
_SYMBOLS = np.array([int.from_bytes(hashlib.blake2b(bytes([i]), digest_size=8).digest()) for i in range(256)], np.uint64)


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, modulo 2^64."""
    inverse = pow(_MULTIPLIER, -1, 1 << 64)
    return tuple(
        np.cumprod(np.array([1] + [m] * (size - 1), np.uint64), dtype=np.uint64) for m in (_MULTIPLIER, inverse)
    )


def _sums(values: np.ndarray, kind) -> np.ndarray:
    out = np.zeros(len(values) + 1, kind)
    np.cumsum(values, out=out[1:], dtype=kind)
    return out


def windows(pieces: list[np.ndarray], stream: int) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """For each length: its class, the bin of each consecutive window of each piece by alphabet, and their hashes."""
    pieces = [p for p in pieces if len(p) >= LEAST]
    if not pieces:
        return
    values, sizes = np.concatenate(pieces), np.array([len(p) for p in pieces])
    offsets = np.cumsum(sizes) - sizes
    powers, inverses = (p[: len(values)] for p in _powers(1 << (len(values) - 1).bit_length()))
    wide = values.astype(np.int32)
    total, squares = _sums(wide, np.int32), _sums(wide * wide, np.int32)
    lagged = _sums(wide[:-1] * wide[1:], np.int32)
    hashed = _sums(_SYMBOLS[values] * powers, np.uint64)
    halves, k = {}, len(ALPHABETS[STREAMS[stream][-1]])
    below = [_sums(values < e, np.int32) for e in SORTS[STREAMS[stream][-1]][:-1]]
    for name in STREAMS[stream]:
        high = 2 * wide >= len(ALPHABETS[name])
        halves[name] = _sums(high, np.int32), _sums(high[1:] != high[:-1], np.int32)
    for n in LENGTHS:
        counts = sizes // n
        before = np.cumsum(counts) - counts
        at = np.repeat(offsets - n * before, counts) + n * np.arange(counts.sum())
        if not len(at):
            continue
        end = at + n
        cells = np.lib.stride_tricks.sliding_window_view(values, n)[at] + k * np.arange(len(at))[:, None]
        often = np.bincount(cells.ravel(), minlength=k * len(at)).reshape(-1, k)
        same = np.einsum("ij,ij->i", often, often)
        s, mean = total[end] - total[at], (total[end] - total[at]) / n
        spread = n * (squares[end] - squares[at]) - s * s
        product = lagged[end - 1] - lagged[at] - mean * (2 * s - wide[at] - wide[end - 1]) + (n - 1) * mean * mean
        z = (product * n / np.maximum(spread, 1) + 1 / n) * math.sqrt(n)
        serial_half = np.where(spread > 0, _serial_half(np.abs(z)), 300 * math.log(10))
        upto, bins = [b[end] - b[at] for b in below], []
        for name in STREAMS[stream]:
            high, changes = halves[name]
            half = serial_half + _uniform_half(n, len(ALPHABETS[name]))[same] + _sorts(upto, n, name)
            half += _runs_half(n)[high[end] - high[at], changes[end - 1] - changes[at]]
            p = np.exp(-half) * (1 + half + half * half / 2 + half**3 / 6)
            bins.append(np.maximum(0, BINS - 1 + np.ceil(4 * np.log10(np.maximum(p, 1e-12)))).astype(np.int64))
        key = (hashed[end] - hashed[at]) * inverses[at]
        key ^= key >> np.uint64(29)
        key *= np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(32)
        yield length_class(n), bins, key


def tested_windows(texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cells and hashes of all windows of the texts' writing, some PIECE of characters at a time.

    A window is in the cell of its alphabet, length class and bin, one for each alphabet of its stream.
    """

    def cells(held):
        for stream, pieces in enumerate(held):
            for size, bins, hashes in windows(pieces, stream):
                for name, b in zip(STREAMS[stream], bins, strict=True):
                    yield _first_cell(name, size) + b, hashes

    held, size = [[] for _ in STREAMS], 0
    for text in texts:
        for stream, values in enumerate(streams(writing(text or ""))):
            for at in range(0, len(values), PIECE):
                held[stream].append(values[at : at + PIECE])
                size += len(held[stream][-1])
                if size >= PIECE:
                    yield from cells(held)
                    held, size = [[] for _ in STREAMS], 0
    yield from cells(held)


def _first_cell(name: str, size: int) -> int:
    return (list(ALPHABETS).index(name) * len(LENGTHS) + size) * BINS


# ---- distinct windows -------------------------------------------------------------------


def _registers() -> np.ndarray:
    return np.zeros(len(ALPHABETS) * len(LENGTHS) * BINS << SKETCH_BITS, np.uint8)


def sketch(registers: np.ndarray, cells: np.ndarray, hashes: np.ndarray) -> None:
    """Enter hashes: a register keeps the longest run of leading zeros among those that it gets."""
    rest = (hashes >> np.uint64(SKETCH_BITS)).astype(np.float64)
    zeros = 65 - SKETCH_BITS - np.frexp(rest)[1]
    at = (cells << SKETCH_BITS) | (hashes & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)
    np.maximum.at(registers, at, zeros.astype(np.uint8))


def estimated(registers: np.ndarray) -> float:
    """How many distinct hashes a sketch of one cell has seen."""
    m = len(registers)
    found = 0.7213 / (1 + 1.079 / m) * m * m / np.exp2(-registers.astype(np.float64)).sum()
    empty = int((registers == 0).sum())
    return m * math.log(m / empty) if found <= 2.5 * m and empty else float(found)


def _seen(df: DataFrame) -> DataFrame:
    """What a task has seen: a sketch per cell, and the distinct hashes of the upper bins themselves."""

    def run(parts):
        registers, held, size, least = _registers(), [], 0, np.array(EXACT)

        def exact():
            rows = np.unique(np.concatenate(held, axis=1), axis=1)
            columns = [pa.array(rows[0].astype(np.int32)), pa.array(rows[1]), pa.nulls(rows.shape[1], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["cell", "hash", "registers"])

        for cells, hashes in tested_windows(t.as_py() for part in parts for t in part.column(0)):
            upper = cells % BINS >= least[cells // BINS % len(LENGTHS)]
            sketch(registers, cells[~upper], hashes[~upper])
            if upper.any():
                held.append(np.stack([cells[upper], hashes[upper].view(np.int64)]))
                size += held[-1].shape[1]
            if size >= GATHER:
                yield exact()
                held, size = [], 0
        if held:
            yield exact()
        sketches = registers.reshape(-1, 1 << SKETCH_BITS)
        used = np.flatnonzero(sketches.any(axis=1))
        blobs = pa.array([zlib.compress(sketches[c].tobytes(), 1) for c in used], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.nulls(len(used), pa.int64()), blobs], ["cell", "hash", "registers"]
        )

    return map_arrow(df.select("text"), run, "cell int, hash bigint, registers binary")


def _merged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The estimate of each cell from its tasks' sketches, register by register the larger."""
    found: dict[int, np.ndarray] = {}
    for part in parts:
        for cell, blob in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            registers = np.frombuffer(zlib.decompress(blob), np.uint8)
            found[cell] = np.maximum(found[cell], registers) if cell in found else registers
    values = [round(estimated(r)) for r in found.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(values, pa.int64())], ["cell", "n"])


def ordinary(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """How random the writing itself looks: distinct windows of the whole table by (class, bin).

    Exact from the bins EXACT up, estimated below.
    """
    seen = durable(_seen(id_and_text(df, id_col, text_col)), "secret-windows")
    exact = seen.where("hash IS NOT NULL").select("cell", "hash").distinct().groupBy("cell").agg(F.count("*").alias("n"))
    sketches = seen.where("registers IS NOT NULL").select("cell", "registers").repartition("cell")
    out = {}
    for r in exact.unionByName(map_arrow(sketches, _merged, "cell int, n bigint")).collect():
        kind, b = divmod(r["cell"], BINS)
        name, size = divmod(kind, len(LENGTHS))
        out[f"{list(ALPHABETS)[name]}:{size}", b] = r["n"]
    return out


def scanned(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, base spans and candidates of each row."""

    def made(texts):
        base, found = [], []
        for text in texts:
            text = text or ""
            spans = base_spans(text)
            base.append([{"kind": k, "start": s, "end": e} for k, s, e in spans])
            found.append(
                [{"start": s, "end": e, "class": c, "bin": b} for s, e, c, b in candidates(text, spans)]
            )
        return {"base": base, "found": found}

    return map_texts(
        id_and_text(df, id_col, text_col),
        made,
        "base array<struct<kind:string,start:bigint,end:bigint>>,"
        " found array<struct<start:bigint,end:bigint,class:string,bin:int>>",
    )


def thresholds(tokens: dict, normal: dict, rate: float) -> dict[str, int]:
    """Per class the least bin to report, by Benjamini-Hochberg within the class.

    ``tokens`` and ``normal`` count (class, bin). A class without ordinary windows reports none.
    """
    out = {}
    for kind in {c for c, _ in tokens}:
        windows = sum(n for (c, _), n in normal.items() if c == kind)
        total = sum(n for (c, _), n in tokens.items() if c == kind)
        as_random = reported = 0
        for b in range(BINS - 1, -1, -1):
            as_random += normal.get((kind, b), 0)
            reported += tokens.get((kind, b), 0)
            p = (1 + as_random) / (1 + windows)
            if reported and p * total <= rate * reported:
                out[kind] = b
    return out


def _counts(rows: DataFrame) -> dict:
    """Candidates by (class, bin): at most classes times BINS rows."""
    each = rows.select(F.explode("found").alias("x")).select("x.*")
    counted = each.groupBy("class", "bin").agg(F.count("*").alias("total"))
    return {(r["class"], r["bin"]): r["total"] for r in counted.collect()}


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def find_secrets(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.01
) -> DataFrame:
    """Per row: id, base (spans of the known kinds), spans (those and random tokens)."""
    rows = durable(scanned(df, id_col, text_col), "secret-spans")
    tokens = _counts(rows)
    least = thresholds(tokens, ordinary(df, id_col, text_col), rate) if tokens else {}
    plain = T.StructType.fromDDL("spans array<struct<start:bigint,at:bigint,end:bigint,kind:string>>")
    schema = T.StructType([*rows.select("id", "base").schema.fields, *plain.fields])

    def run(parts):
        from pyspark.sql.pandas.types import to_arrow_schema

        for part in parts:
            spans = []
            for base, found in zip(*(part.column(c).to_pylist() for c in ("base", "found")), strict=True):
                each = [(x["kind"], x["start"], x["end"]) for x in base]
                each += [("random", *x) for x in chosen((tuple(x.values()) for x in found), least)]
                each.sort(key=lambda x: (x[1], KINDS.index(x[0]), x[2]))
                spans.append([{"start": s, "at": KINDS.index(k) + 1, "end": e, "kind": k} for k, s, e in each])
            arrow = to_arrow_schema(schema)
            arrays = [part.column("id"), part.column("base"), pa.array(spans, arrow.field("spans").type)]
            yield pa.RecordBatch.from_arrays(
                [a.cast(f.type) for a, f in zip(arrays, arrow, strict=True)], schema=arrow
            )

    return map_arrow(rows, run, schema)


def secret_digest(df: DataFrame, **options) -> DataFrame:
    """Per row: id, counts of the known kinds, base_sha256 and spans as text."""
    found = find_secrets(df, **options)
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "id",
        *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
