"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

White space is written as the marker U+2581, with one marker before the text. The best
segmentation maximises the sum of the pieces' log scores; characters without a piece fall back
to their bytes. Decoding joins the pieces, reads runs of byte pieces as UTF-8 (what is not
valid becomes U+FFFD), turns markers into spaces and drops the first.

Pieces and scores come from a ``.model`` file with identity normalisation. A unigram file's
scores are log probabilities and used as they are. A file of merges has ranks instead; there a
piece of rank r gets the log probability of Zipf's law, -log(r + 1) less a constant. Pieces
defined by the user (runs of markers) are always preferred, as in the library.

No piece has another character before a marker or holds a line break, which is checked, so the best
segmentation of a text is that of its units between such places. Units are encoded once per
batch, many side by side, and remembered; a text is then a gather over its units.

A long unit (text without spaces) is cut into runs that overlap. The trie is walked from all places at once, and the
runs' lattices advance side by side over the matches alone, in whole numbers. A run is right where, over the
longest piece before it, its sums differ from those of the run before it by a constant, for then
all choices after that are the same. A run that fails this is continued from the sums of the run before it.

Defined results: a null or empty text has no pieces and decodes to an empty text. Texts of any
length are encoded whole. A text that holds the marker itself decodes with spaces in its place
(``lossless`` is false). Repeated rows are encoded alike; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablehaul.llm.common import id_and_text, map_texts
from tablehaul.llm.double_array import ROOT, DoubleArray, build

MARK = "▁"
UNIT = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
#: Below the worst piece, so that an unknown character is the last resort.
UNKNOWN_PENALTY = 10.0
#: Units up to this many bytes are encoded whole, longer ones in runs.
SIDE_BY_SIDE = 48
#: Bytes that a run of a long unit answers for, and bytes of runs that advance side by side.
OWN, SLAB = 1024, 1 << 17
#: Scores in runs are multiples of 2^-24, so that sums are exact; sums below are of no path.
SHARES, NO_PATH = float(1 << 24), -(1 << 60)
#: Units that a worker remembers before it starts afresh.
REMEMBERED = 300_000


@dataclass(frozen=True)
class Pieces:
    """What a vocabulary file says, in arrays of a size fixed by the file."""

    trie: DoubleArray
    scores: np.ndarray
    defined: np.ndarray
    best: float
    unknown: float
    bytes_at: np.ndarray
    surface: list[bytes]
    is_byte: np.ndarray
    longest: int

    def score(self, numbers: np.ndarray, lengths) -> np.ndarray:
        preferred = np.float32(lengths * self.best - 0.1)
        return np.where(self.defined[numbers], preferred, self.scores[numbers])


def zipf_scores(ranks: np.ndarray) -> np.ndarray:
    """Log probabilities of Zipf's law for ranks from 0."""
    return (-np.log(ranks + 1.0) - math.log(np.sum(1.0 / (np.arange(len(ranks)) + 1)))).astype(np.float32)


def load_pieces(model: bytes) -> Pieces:
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto.FromString(model)
    if spec.normalizer_spec.name != "identity" or spec.normalizer_spec.remove_extra_whitespaces:
        raise ValueError("the vocabulary normalises texts, which is not supported")
    if not spec.trainer_spec.byte_fallback:
        raise ValueError("the vocabulary has no byte pieces")
    processor = SentencePieceProcessor(model_proto=model)
    n = processor.get_piece_size()
    kinds = np.array([p.type for p in spec.pieces])
    normal, defined = kinds == 1, kinds == 4
    text = [processor.id_to_piece(i) for i in range(n)]
    for i in np.flatnonzero(normal | defined):
        if re.search(f"[^{MARK}]{MARK}|\n", text[i]):
            raise ValueError(f"piece {text[i]!r} crosses units")
    raw = np.array([processor.get_score(i) for i in range(n)], np.float32)
    scores = np.zeros(n, np.float32)
    if spec.trainer_spec.model_type == 1:
        scores[normal] = raw[normal]
    else:
        scores[normal] = zipf_scores(np.argsort(np.argsort(-raw[normal], kind="stable")))
    byte_ids = [i for i in range(n) if processor.is_byte(i)]
    bytes_at = np.zeros(256, np.int32)
    for i in byte_ids:
        bytes_at[int(text[i][3:5], 16)] = i
    surface = [text[i].encode() for i in range(n)]
    for i in byte_ids:
        surface[i] = bytes([int(text[i][3:5], 16)])
    spelled = {surface[i]: int(i) for i in np.flatnonzero(normal | defined)}
    return Pieces(
        build(spelled),
        scores,
        defined,
        float(scores[normal].max()),
        float(scores[normal].min()) - UNKNOWN_PENALTY,
        bytes_at,
        surface,
        np.isin(np.arange(n), byte_ids),
        max(4, *map(len, spelled)),
    )


def _character_lengths(data: np.ndarray) -> np.ndarray:
    """Bytes of the character that starts at each byte; 0 inside a character."""
    return np.select([data < 0x80, data < 0xC0, data < 0xE0, data < 0xF0], [1, 0, 2, 3], 4)


def encode_units(units: list[bytes], p: Pieces) -> list[np.ndarray]:
    """Piece numbers of each unit: the lattices of all units advance together.

    Equal sums keep the segmentation found first, whose last piece starts earliest.
    """
    lengths = np.array([len(u) for u in units])
    width = int(lengths.max())
    padded = b"".join(u.ljust(width + 1, b"\0") for u in units)
    data = np.frombuffer(padded, np.uint8).reshape(len(units), width + 1)
    chars = _character_lengths(data)
    best = np.full((len(units), width + 1), -np.inf, np.float32)
    best[:, 0] = 0
    start = np.zeros((len(units), width + 1), np.int32)
    piece = np.full((len(units), width + 1), -1, np.int32)
    for i in range(width):
        rows = np.flatnonzero((chars[:, i] > 0) & (i < lengths))
        if not len(rows):
            continue
        here, single = best[rows, i], chars[rows, i]
        unknown = np.ones(len(rows), bool)
        alive, states, depth = np.arange(len(rows)), np.full(len(rows), ROOT), 0
        while len(alive):
            inside = i + depth < lengths[rows[alive]]
            alive, states = alive[inside], states[inside]
            if not len(alive):
                break
            states = p.trie.step(states, data[rows[alive], i + depth])
            depth += 1
            found = states >= 0
            alive, states = alive[found], states[found]
            numbers = p.trie.value[states]
            ends = numbers >= 0
            at, numbers = alive[ends], numbers[ends]
            unknown[at[single[at] == depth]] = False
            sums = here[at] + p.score(numbers, depth)
            better = sums > best[rows[at], i + depth]
            to = rows[at[better]]
            best[to, i + depth], start[to, i + depth] = sums[better], i
            piece[to, i + depth] = numbers[better]
        at = np.flatnonzero(unknown)
        ends, sums = i + single[at], here[at] + np.float32(p.unknown)
        better = sums > best[rows[at], ends]
        to, ends = rows[at[better]], ends[better]
        best[to, ends], start[to, ends], piece[to, ends] = sums[better], i, -1
    return _traced(units, lengths, start, piece, p)


def _traced(units, lengths, start, piece, p: Pieces) -> list[np.ndarray]:
    """Follow the best pieces back from the end of each unit."""
    at, rows = lengths.copy(), np.arange(len(units))
    steps = []
    while len(rows):
        steps.append((rows, piece[rows, at[rows]], at[rows]))
        at[rows] = start[rows, at[rows]]
        rows = rows[at[rows] > 0]
    count = np.zeros(len(units), np.int64)
    for rows, _, _ in steps:
        count[rows] += 1
    first = np.cumsum(count) - count
    flat, ends = np.empty(count.sum(), np.int32), np.empty(count.sum(), np.int64)
    place = first + count
    for rows, numbers, end in steps:
        place[rows] -= 1
        flat[place[rows]], ends[place[rows]] = numbers, end
    out = [flat[a : a + n] for a, n in zip(first.tolist(), count.tolist(), strict=True)]
    for row in np.unique(np.searchsorted(first, np.flatnonzero(flat < 0), side="right") - 1).tolist():
        stops = ends[first[row] : first[row] + count[row]].tolist()
        numbers, whole, last = [], units[row], 0
        for number, stop in zip(out[row].tolist(), stops, strict=True):
            numbers += [number] if number >= 0 else p.bytes_at[list(whole[last:stop])].tolist()
            last = stop
        out[row] = np.array(numbers, np.int32)
    return out


def matches(data: np.ndarray, ends: np.ndarray, p: Pieces) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, piece numbers) of all pieces at all places; -1 for a character without a piece.

    ``ends`` says for each place where its unit or run ends.
    """
    chars = _character_lengths(data)
    places = np.flatnonzero(chars)
    alive, states, length = places, np.full(len(places), ROOT), 0
    unknown, out = chars > 0, []
    while len(alive):
        inside = alive + length < ends[alive]
        alive, states = alive[inside], states[inside]
        states = p.trie.step(states, data[alive + length])
        length += 1
        found = states >= 0
        alive, states = alive[found], states[found]
        numbers = p.trie.value[states]
        piece = numbers >= 0
        if piece.any():
            out.append((length, alive[piece], numbers[piece]))
            unknown[alive[piece][chars[alive[piece]] == length]] = False
    for n in range(1, 5):
        at = places[unknown[places] & (chars[places] == n)]
        if len(at):
            out.append((n, at, np.full(len(at), -1, np.int32)))
    return out


@dataclass
class Run:
    """A stretch of a unit: it starts to sum at ``lo`` and answers for what ends in (a, b]."""

    unit: int
    lo: int
    a: int
    b: int
    lengths: np.ndarray | None = None
    numbers: np.ndarray | None = None
    before: np.ndarray | None = None
    last: np.ndarray | None = None


def _lattices(chunks: list[bytes], p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Scores and numbers of the pieces that end at each place of each chunk, the longest first."""
    sizes = np.array([len(c) for c in chunks])
    offsets = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(chunks)), sizes)
    found = matches(np.frombuffer(b"".join(chunks), np.uint8), (offsets + sizes)[row], p)
    most = max(n for n, _, _ in found)
    shape = (int(sizes.max()) + 1, most, len(chunks))
    scores, numbers = np.full(shape, 2 * NO_PATH, np.int64), np.full(shape, -1, np.int32)
    for n, at, which in found:
        score = np.where(which >= 0, p.score(which, n), np.float32(p.unknown)).astype(np.float64)
        to = (at - offsets[row[at]] + n, most - n, row[at])
        scores[to], numbers[to] = np.rint(score * SHARES), which
    return scores, numbers


def _advance(runs: list[Run], chunks: list[bytes], p: Pieces) -> None:
    """Sum the runs' lattices side by side; equal sums keep the piece that starts earliest."""
    scores, numbers = _lattices(chunks, p)
    steps, most, width = scores.shape
    best = np.full((most + steps, width), 4 * NO_PATH, np.int64)
    best[most] = 0
    lengths, chosen = np.zeros((steps, width), np.int32), np.full((steps, width), -1, np.int32)
    rows = np.arange(width)
    for t in range(1, steps):
        sums = best[t : t + most] + scores[t]
        k = sums.argmax(axis=0)
        top = sums[k, rows]
        best[most + t] = np.where(top > NO_PATH, top, 4 * NO_PATH)
        lengths[t], chosen[t] = most - k, numbers[t, k, rows]
    for r, run in enumerate(runs):
        own = slice(run.a - run.lo + 1, run.b - run.lo + 1)
        run.lengths, run.numbers = lengths[own, r].copy(), chosen[own, r].copy()
        sums = best[most:, r]
        run.before = sums[max(0, run.a - run.lo + 1 - p.longest) : run.a - run.lo + 1].copy()
        run.last = sums[max(0, run.b - run.lo + 1 - p.longest) : run.b - run.lo + 1].copy()


def _agree(before: Run, run: Run) -> bool:
    """Whether the sums of a run differ from those of the run before it by a constant."""
    n = min(len(before.last), len(run.before))
    a, b = before.last[len(before.last) - n :], run.before[len(run.before) - n :]
    path = a > NO_PATH
    return bool((path == (b > NO_PATH)).all()) and len(set((a - b)[path].tolist())) <= 1


def _continued(before: Run, run: Run, unit: bytes, p: Pieces) -> None:
    """The run again, from the sums of the run before it."""
    known = len(before.last)
    lo = run.a + 1 - known
    scores, numbers = (x[:, :, 0].tolist() for x in _lattices([unit[lo : run.b]], p))
    most = len(scores[0])
    best = [4 * NO_PATH] * most + before.last.tolist()
    for t in range(known, run.b - lo + 1):
        top, kept = 4 * NO_PATH, 0
        for k, score in enumerate(scores[t]):
            if best[t + k] + score > top:
                top, kept = best[t + k] + score, k
        best.append(top if top > NO_PATH else 4 * NO_PATH)
        at = t - known
        run.lengths[at], run.numbers[at] = most - kept, numbers[t][kept]
    run.last = np.array(best[-p.longest :], np.int64)


def encode_long(units: list[bytes], p: Pieces) -> list[np.ndarray]:
    """Piece numbers of long units."""
    runs: list[Run] = []
    warm = 4 * p.longest
    for u, unit in enumerate(units):
        a = 0
        while a < len(unit):
            b = a + OWN if len(unit) - a > 2 * OWN else len(unit)
            while b < len(unit) and unit[b] & 0xC0 == 0x80:
                b += 1
            lo = max(0, a - warm)
            while unit[lo] & 0xC0 == 0x80:
                lo += 1
            runs.append(Run(u, lo, a, b))
            a = b
    slab: list[Run] = []
    for run in [*sorted(runs, key=lambda r: r.b - r.lo), None]:
        if slab and (run is None or (run.b - run.lo) * (len(slab) + 1) > SLAB):
            _advance(slab, [units[r.unit][r.lo : r.b] for r in slab], p)
            slab = []
        if run is not None:
            slab.append(run)
    of_unit: list[list[Run]] = [[] for _ in units]
    for run in runs:
        mine = of_unit[run.unit]
        if mine and not _agree(mine[-1], run):
            _continued(mine[-1], run, units[run.unit], p)
        mine.append(run)
    return [_followed(unit, mine, p) for unit, mine in zip(units, of_unit, strict=True)]


def _followed(unit: bytes, runs: list[Run], p: Pieces) -> np.ndarray:
    """The chosen pieces, found from the end of the unit back."""
    stops, at = [], len(unit)
    for run in reversed(runs):
        lengths, a = run.lengths.tolist(), run.a
        while at > a:
            stops.append(at)
            at -= lengths[at - a - 1]
    stops = np.array(stops[::-1])
    chosen = np.concatenate([r.numbers for r in runs])[stops - 1]
    if (chosen >= 0).all():
        return chosen
    pieces = zip(chosen.tolist(), [0, *stops[:-1].tolist()], stops.tolist(), strict=True)
    spelled = [[n] if n >= 0 else p.bytes_at[list(unit[s:e])].tolist() for n, s, e in pieces]
    return np.array([n for piece in spelled for n in piece], np.int32)


class Encoder:
    """Encodes batches of texts; remembers units between batches."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def learn(self, units: list[str]) -> None:
        """Encode new units and append them to what is known."""
        data = sorted((len(d), d, u) for u in units for d in [u.encode("utf-8")])
        made: list[np.ndarray] = []
        short = [d for n, d, _ in data if n <= SIDE_BY_SIDE]
        for at in range(0, len(short), 4096):  # sorted, so a slice has units of like lengths
            made += encode_units(short[at : at + 4096], self.pieces)
        made += encode_long([d for n, d, _ in data if n > SIDE_BY_SIDE], self.pieces)
        for i, (_, _, u) in enumerate(data):
            self.known[u] = len(self.start) + i
        counts = np.array([len(m) for m in made], np.int64)
        starts = len(self.flat) + np.cumsum(counts) - counts
        self.start, self.count = np.concatenate([self.start, starts]), np.concatenate([self.count, counts])
        self.flat = np.concatenate([self.flat, *made])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.forget()
        split = [UNIT.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if new := list({u for units in split for u in units if u not in self.known}):
            self.learn(new)
        out = []
        for units in split:
            at = np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))
            counts = self.count[at]
            shift = np.repeat(self.start[at] - (np.cumsum(counts) - counts), counts)
            out.append(self.flat[shift + np.arange(len(shift))])
        return out


def decode(numbers, p: Pieces) -> str:
    """The text of piece numbers."""
    text = b"".join([p.surface[i] for i in numbers]).decode("utf-8", "replace").replace(MARK, " ")
    return text[1:] if text.startswith(" ") else text


_STATE: dict[str, Encoder] = {}


def _encoder(key: str, sent) -> Encoder:
    if key not in _STATE:
        _STATE[key] = Encoder(sent.value)
    return _STATE[key]


def _sent(df: DataFrame, model_path: str):
    with open(model_path, "rb") as f:
        model = f.read()
    return hashlib.sha256(model).hexdigest(), df.sparkSession.sparkContext.broadcast(load_pieces(model))


def encoded(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ids (array of piece numbers), n_pieces, decoded_sha256 and lossless.

    The last two are of the text that the pieces decode to.
    """
    key, sent = _sent(df, model_path)

    def made(texts):
        encoder = _encoder(key, sent)
        ids = encoder.encode(texts)
        back = [decode(x.tolist(), encoder.pieces) for x in ids]
        counts = [len(x) for x in ids]
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        values = np.concatenate([*ids, np.zeros(0, np.int32)])
        return {
            "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
            "n_pieces": counts,
            "decoded_sha256": [
                hashlib.sha256(b.encode("utf-8", "surrogatepass")).hexdigest() for b in back
            ],
            "lossless": [b == (t or "") for b, t in zip(back, texts, strict=True)],
        }

    fields = "ids array<int>, n_pieces bigint, decoded_sha256 string, lossless boolean"
    return map_texts(id_and_text(df, id_col, text_col), made, fields, batches=256)


def decoded(df: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id and text, from an array of piece numbers (null gives an empty text)."""
    from pyspark.sql import functions as F

    from tablehaul.llm.common import map_arrow, quoted

    key, sent = _sent(df, model_path)
    rows = df.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(ids_col)).alias("ids"))

    def run(parts):
        for part in parts:
            pieces = _encoder(key, sent).pieces
            texts = [decode(x.as_py() or (), pieces) for x in part.column("ids")]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    return map_arrow(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, text string")
