"""Counts of a text that quality rules and the quality classifier build on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tablehaul.llm.common import id_and_text, map_texts

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
WINDOW = 8

FIELDS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_adjacent",
    "n_distinct",
    "n_upper",
    "n_exclaim",
    "n_marks",
    "n_digits",
)


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of WINDOW words that are found twice or more, the first included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    # Windows with distinct hashes are distinct; only texts with equal hashes are looked at exactly.
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = sum(hashes[i : i + n] * np.uint64(2 * i * i + 3 * i + 1) for i in range(WINDOW))
    mixed.sort()
    if not (mixed[1:] == mixed[:-1]).any():
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    width = 1
    while width < WINDOW:  # numbers of twice as long windows, from pairs of numbers
        pairs = ids[: len(ids) - width] * (ids.max() + 1) + ids[width:]
        ids = np.unique(pairs, return_inverse=True)[1]
        width *= 2
    again = np.bincount(ids)[ids] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += again
    edge[WINDOW:] -= again
    return int((np.cumsum(edge[:-1]) > 0).sum())


def upper_letters(text: str) -> int:
    """Code points that lower-casing changes."""
    lower = text.lower()
    if lower == text:
        return 0
    if len(lower) != len(text):  # a few letters become two
        return sum(c.lower() != c for c in text)
    a, b = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (text, lower))
    return int((a != b).sum())


def text_stats(text: str | None) -> tuple[int, ...]:
    """The counts named in FIELDS; a null text counts as empty."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
        sum(map(bytes.__eq__, words, words[1:])),
        len(set(words)),
        upper_letters(text),
        text.count("!"),
        text.count(".") + text.count(","),
        sum(map(text.count, "0123456789")),
    )


def with_stats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and the counts of each row."""

    def made(texts):
        rows = [text_stats(t) for t in texts]
        return {f: [r[i] for r in rows] for i, f in enumerate(FIELDS)}

    return map_texts(id_and_text(df, id_col, text_col), made, ", ".join(f"{f} bigint" for f in FIELDS))
