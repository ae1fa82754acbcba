"""Language by compression: the language whose dictionary makes a text smallest.

Each language has a raw-content zstandard dictionary, made of text samples of that language. A
text is cut into blocks, so that dictionaries matter to its end; every block is compressed with
every dictionary, and the sizes are summed over the whole text. The smallest sum wins; where the
second is hardly larger, the text is rejected.

Dictionaries are learned from a bounded sample: SAMPLES texts of each language outside the held
out fold, the first of each hash bucket, SAMPLED characters of each from its middle. Language,
source and id are no inputs of a prediction.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and rejected; so
is every text if nothing could be learned. Rows with null language or text are not learned from.
Equal sizes go to the language with most texts to learn from, then by code point. With one language nothing is
rejected for its margin. Repeated rows get equal predictions; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import filter_texts, fold, id_and_text, map_texts, quoted

UNDETERMINED = "und"
SAMPLES = 128
SAMPLED = 800
BLOCK = 500
LEVEL = 12
#: Relative size difference by which the odds of the best language grow by a factor of e.
SCALE = 0.01
#: A text is rejected if the second language is larger by less than this share.
MARGIN = 0.001

_OTHER = re.compile(r"[\W\d_]+")


def normalised(text: str) -> str:
    """Letters in lower case, words with single spaces between them."""
    return _OTHER.sub(" ", text).lower()


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def learned(
    df: DataFrame, id_col: str, text_col: str, lang_col: str, folds: int, held_out: int
) -> dict[str, bytes]:
    """Dictionary content per language: at most SAMPLES pieces of SAMPLED characters of each.

    Languages with more texts come first.
    """
    ids, text = F.col(quoted(id_col)), F.col(quoted(text_col)).cast("string")
    middle = F.greatest(F.lit(1), (F.length(text) - SAMPLED) / 2).cast("int")
    rows = df.where(
        (fold(ids, folds) != held_out) & F.col(quoted(lang_col)).isNotNull() & text.isNotNull()
    ).select(
        F.col(quoted(lang_col)).cast("string").alias("lang"),
        F.xxhash64(ids.cast("string")).alias("h"),
        F.substring(text, middle, F.lit(SAMPLED)).alias("piece"),
    )
    # One piece per language and bucket of hashes, picked before anything is shuffled.
    picked = (
        rows.groupBy("lang", F.pmod("h", F.lit(SAMPLES)).alias("bucket"))
        .agg(F.min(F.struct("h", "piece")).alias("x"), F.count("*").alias("n"))
        .select("lang", "bucket", "x.piece", "n")
        .collect()
    )
    pieces: dict[str, list] = {}
    texts: Counter = Counter()
    for r in sorted(picked, key=lambda r: (r["lang"], r["bucket"])):
        pieces.setdefault(r["lang"], []).append(normalised(r["piece"]))
        texts[r["lang"]] += r["n"]
    order = sorted(pieces, key=lambda lang: (-texts[lang], lang))
    return {lang: " ".join(pieces[lang]).encode("utf-8") for lang in order}


class Classifier:
    """Compressors with one raw-content dictionary each."""

    def __init__(self, contents: dict[str, bytes]):
        self.compressors = []
        for lang, content in contents.items():
            if len(content) < 8:  # too little to be a dictionary
                continue
            made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(level=LEVEL)
            compressor = zstandard.ZstdCompressor(
                dict_data=made,
                write_checksum=False,
                write_content_size=False,
                write_dict_id=False,
            )
            self.compressors.append((lang, compressor))

    def sizes(self, text: str) -> list[int]:
        """Bytes of the whole text under each dictionary, block by block."""
        data = normalised(text).encode("utf-8")
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        return [sum([len(c.compress(b)) for b in blocks]) for _, c in self.compressors]

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, margin of the second language as a share of the best)."""
        if not text or not self.compressors or not has_letter(text):
            return UNDETERMINED, 0.0, 0.0
        sizes = self.sizes(text)
        best = min(sizes)
        odds = [math.exp((best - s) / (SCALE * best)) for s in sizes]
        at = sizes.index(best)
        rest = [s for i, s in enumerate(sizes) if i != at]
        margin = (min(rest) - best) / best if rest else 1.0
        return self.compressors[at][0], 1 / sum(odds), margin


_STATE: dict[int, Classifier] = {}


def _classifier(key: int, sent) -> Classifier:
    if key not in _STATE:
        _STATE[key] = Classifier(sent.value)
    return _STATE[key]


def languages(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 4,
    held_out: int = 2,
    margin: float = MARGIN,
    contents: dict[str, bytes] | None = None,
) -> DataFrame:
    """Per row: id, held_out, lang_pred, score, margin and rejected.

    ``contents`` gives dictionaries learned elsewhere.
    """
    if contents is None:
        contents = learned(df, id_col, text_col, lang_col, folds, held_out)
    # At most SAMPLES * SAMPLED characters a language.
    sent = df.sparkSession.sparkContext.broadcast(contents)
    key = hash(tuple(contents.items()))

    def made(texts):
        found = [_classifier(key, sent).predict(t) for t in texts]
        return dict(zip(("lang_pred", "score", "margin"), map(list, zip(*found, strict=True)), strict=True))

    fields = "lang_pred string, score double, margin double"
    out = map_texts(id_and_text(df, id_col, text_col), made, fields)
    return out.select(
        "id",
        F.coalesce(fold(F.col("id"), folds) == held_out, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        "margin",
        ((F.col("lang_pred") == UNDETERMINED) | (F.col("margin") < margin)).alias("rejected"),
    )


def identified(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 4,
    held_out: int = 2,
    margin: float = MARGIN,
) -> DataFrame:
    """The rows that are not rejected, with all their columns."""
    contents = learned(df, id_col, text_col, lang_col, folds, held_out)
    sent = df.sparkSession.sparkContext.broadcast(contents)
    key = hash(tuple(contents.items()))

    def keep(texts):
        found = [_classifier(key, sent).predict(t) for t in texts]
        return [lang != UNDETERMINED and not by < margin for lang, _, by in found]

    return filter_texts(df, text_col, keep)
