"""Token counts of byte-level BPE texts by the whole-token shortcut.

Most pre-tokens are a single vocabulary entry. ``whole_tokens`` proves once, on the driver,
which vocabulary strings encode alone as one token: it runs the merges over each of them. A
pre-token among those counts one; only the others are merged. Pre-tokens are independent, so
nothing else of a text matters.

The vocabulary is a ``tokenizers`` JSON file with a byte-level BPE model whose pre-tokeniser
splits by PATTERN. Its added tokens are cut out of the texts first, as the library does by
default. Nothing is added, truncated or padded. The library's model does the merges of the rest.

Defined results: a null text counts as empty and has no tokens; texts of any length are counted
whole; rows are counted each for itself, so repeated rows and other columns do not matter. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import json

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import id_and_text, map_texts

#: Splits a text before the merges. White space is spelled out as the Unicode property.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Distinct merged pre-tokens that a worker remembers before it starts afresh.
REMEMBERED = 400_000


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), 256)]
    table = {b: chr(b) for b in plain}
    for b in range(256):
        table.setdefault(b, chr(256 + len(table) - len(plain)))
    return [table[b] for b in range(256)]


class Merges:
    """The merges of one vocabulary file, its added tokens and the proven whole tokens."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(spec).model
        self.added = [t["content"] for t in json.loads(spec)["added_tokens"]]
        self.characters = byte_characters()

    def count(self, pretoken: str) -> int:
        """Tokens left after all merges of one pre-token."""
        stand_in = self.characters
        return len(self.model.tokenize("".join([stand_in[b] for b in pretoken.encode("utf-8")])))


def whole_tokens(spec: str) -> frozenset[str]:
    """The vocabulary strings that are proven to encode alone as one token."""
    merges, pattern, out = Merges(spec), regex.compile(PATTERN), []
    byte_of = {c: b for b, c in enumerate(merges.characters)}
    for token in json.loads(spec)["model"]["vocab"]:
        if not set(token) <= byte_of.keys():
            continue
        try:
            text = bytes(byte_of[c] for c in token).decode("utf-8")
        except UnicodeDecodeError:  # part of a character, never a pre-token
            continue
        if pattern.fullmatch(text) and merges.count(text) == 1:
            out.append(text)
    return frozenset(out)


class _Counts(dict):
    """Tokens of a pre-token, merged when first seen."""

    def __init__(self, spec: str, whole: frozenset[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.merges, self.whole = Merges(spec), whole
        self.pattern = regex.compile(PATTERN)
        added = sorted(self.merges.added, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, added))) if added else None

    def __missing__(self, pretoken: str) -> int:
        n = self.merges.count(pretoken)
        if len(pretoken) <= 64:
            self[pretoken] = n
        return n

    def trim(self) -> None:
        if len(self) > len(self.whole) + REMEMBERED:
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))

    def of_text(self, text: str) -> int:
        """Tokens of a whole text."""
        pieces, n = [text], 0
        if self.cut is not None and any(t in text for t in self.merges.added):
            pieces = self.cut.split(text)
            n = len(pieces) - 1
        get, split = self.__getitem__, self.pattern.findall
        return n + sum(sum(map(get, split(piece))) for piece in pieces)


_STATE: dict[str, _Counts] = {}


def token_counts(
    df: DataFrame, vocabulary_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, n_bytes, n_tokens and over_limit (more tokens than ``limit``)."""
    with open(vocabulary_path, encoding="utf-8") as f:
        spec = f.read()
    # A vocabulary file is of a fixed size, about 2 MB here.
    sent = df.sparkSession.sparkContext.broadcast((spec, whole_tokens(spec)))
    key = hashlib.sha256(spec.encode()).hexdigest()

    def made(texts):
        if key not in _STATE:
            _STATE[key] = _Counts(*sent.value)
        counts = _STATE[key]
        counts.trim()
        return {
            "n_bytes": [len((t or "").encode("utf-8")) for t in texts],
            "n_tokens": [counts.of_text(t) if t else 0 for t in texts],
        }

    out = map_texts(id_and_text(df, id_col, text_col), made, "n_bytes bigint, n_tokens bigint")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
