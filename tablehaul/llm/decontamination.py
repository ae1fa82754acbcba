"""Documents that hold passages of a benchmark, in built-in functions only.

Words are lower-cased runs of digits, letters a to z and characters beyond ASCII. A window is
``width`` consecutive words of a benchmark item; an item with fewer words is one window. The hashes of the
distinct windows are broadcast, the windows of every whole text are looked up in that set, and a
hit counts only if the words themselves are equal. Document words inside any window found are hit.

Only windows of the benchmark are broadcast. Where they take more than ``most_bytes``, they are
dealt into parts of that size by hash, and the texts are scanned once per part, so that the broadcast is
bounded and nothing but hits is ever shuffled. A document's hits are gathered in one row, which its
own length bounds; the items of a document are at most those of the benchmark.

``contaminated`` describes each document; ``without_contaminated`` drops documents with hits and
``without_passages`` cuts the hit words out of the texts.

Defined results: a null or wordless text has no words and no hits, a null or wordless item has
no window. Equal ids of several items are one id; an item without an id marks words but is in
neither n_items nor the digest. Equal windows of several items count for all of them. Repeated
rows are looked at each for itself, texts of any length whole. An empty benchmark hits nothing, an empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import durable, free_name, id_and_text, quoted, with_row_key

WIDTH = 10
#: Bytes of windows that are broadcast at once.
MOST_BYTES = 64 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What lies between words, once A to Z are lower-cased; and stretches of either kind before that.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
STRETCH = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
STARTS_WITH_WORD = r"^[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.array_remove(F.split(lower, BETWEEN, -1), "")


def benchmark_windows(
    benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", width: int = WIDTH
) -> tuple[DataFrame, DataFrame]:
    """The distinct windows (w, hash, window, n words in it), and which items have them (w, item)."""
    items = benchmark.select(
        F.col(quoted(item_col)).cast("string").alias("item"), words(F.col(quoted(text_col)).cast("string")).alias("words")
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (width - 1), F.lit(1)))
    each = durable(
        items.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, width))).alias("window")),
        "benchmark-windows",
    )
    distinct = each.select("window").distinct()
    windows = durable(
        distinct.select(
            F.monotonically_increasing_id().alias("w"),
            F.xxhash64("window").alias("hash"),
            "window",
            F.size("window").alias("n"),
        ),
        "benchmark-distinct",
    )
    members = each.where("item IS NOT NULL").distinct().join(windows, "window").select("w", "item")
    return windows, durable(members, "benchmark-members")


def _hashes(lengths: list[int]) -> Column:
    """Hashes of all windows of a text, length by length, after a null that stands for the text itself."""

    def of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.col("n_words") - (n - 1))
        hashed = F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, n)))
        return F.when(F.col("n_words") >= n, hashed).otherwise(F.array().cast("array<long>"))

    return F.concat(F.array(F.lit(None).cast("long")), *map(of, lengths))


def _place(lengths: list[int]) -> tuple[Column, Column]:
    """Number of words, and first word counted from 1, of the window at ``pos`` among ``_hashes``."""
    n, at, before = F.lit(0), F.lit(1), F.lit(1)
    for length in lengths:
        here = F.col("pos") >= before
        n = F.when(here, length).otherwise(n)
        at = F.when(here, F.col("pos") - before + 1).otherwise(at)
        before = before + F.greatest(F.col("n_words") - (length - 1), F.lit(0))
    return n.cast("int"), at.cast("int")


def _looked_up(texts: DataFrame, windows: DataFrame, lengths: list[int], with_all: bool) -> DataFrame:
    """A row for each hit (at, n, w) and, if wanted, one without a hit for each text."""
    tokens = texts.select("row", "id", words(F.col("text")).alias("words"))
    tokens = tokens.select("*", F.size("words").alias("n_words"))
    each = tokens.select("*", F.posexplode(_hashes(lengths)).alias("pos", "hash"))
    n, at = _place(lengths)
    known = F.broadcast(windows.select("w", F.col("hash").alias("known"), "window"))
    same = (F.col("hash") == F.col("known")) & (F.slice("words", at, n) == F.col("window"))
    found = each.join(known, same, "left" if with_all else "inner")
    hit = F.when(F.col("w").isNotNull(), F.struct(at.alias("at"), n.alias("n"), "w"))
    return found.where("w IS NOT NULL OR hash IS NULL").select("row", "id", "n_words", hit.alias("hit"))


#: Words covered by windows ordered by their first word, and the stretches they make together.
_COVERED = """
aggregate(hits, named_struct('last', 0, 'n', 0L),
  (s, x) -> named_struct('last', greatest(s.last, x.at + x.n - 1),
                         'n', s.n + greatest(0, x.at + x.n - 1 - greatest(s.last, x.at - 1))),
  s -> s.n)
"""
_STRETCHES = """
aggregate(hits, named_struct('from', 0, 'to', 0, 'done', cast(array() AS array<struct<from: int, to: int>>)),
  (s, x) -> CASE
    WHEN s.to = 0 THEN named_struct('from', x.at, 'to', x.at + x.n - 1, 'done', s.done)
    WHEN x.at <= s.to + 1 THEN named_struct('from', s.from, 'to', greatest(s.to, x.at + x.n - 1), 'done', s.done)
    ELSE named_struct('from', x.at, 'to', x.at + x.n - 1,
                      'done', array_append(s.done, named_struct('from', s.from, 'to', s.to))) END,
  s -> CASE WHEN s.to = 0 THEN s.done ELSE array_append(s.done, named_struct('from', s.from, 'to', s.to)) END)
"""


def _hits(
    df: DataFrame, windows: DataFrame, id_col: str, text_col: str, most_bytes: int
) -> DataFrame:
    """Per row: row, id, n_words and its hits, ordered by their first word."""
    facts = windows.groupBy("n").agg(F.sum(F.octet_length(F.array_join("window", " ")) + 64).alias("bytes"))
    sizes = {r["n"]: r["bytes"] for r in facts.collect()}  # one row per length, WIDTH at most
    lengths, parts = sorted(sizes, reverse=True), max(1, ceil(sum(sizes.values()) / most_bytes))
    texts = id_and_text(df, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    if parts > 1:  # scanned again and again, so the row numbers are written down
        texts = durable(texts, "benchmark-texts")
    of_part = F.pmod(F.col("hash"), F.lit(parts))
    scans = [
        _looked_up(texts, windows.where(of_part == i) if parts > 1 else windows, lengths, i == 0)
        for i in range(parts)
    ]
    found = reduce(DataFrame.unionByName, scans)
    hits = F.array_sort(F.collect_list("hit")).alias("hits")
    return durable(found.groupBy("row", "id", "n_words").agg(hits), "benchmark-hits")


def contaminated(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """Per row: id, n_words, n_hit, n_items, items_sha256, contaminated and the hit stretches of words.

    A stretch is (from, to), counted from 1, ``to`` included; items_sha256 is over the ids of the
    items found, sorted as strings and joined by commas.
    """
    windows, members = benchmark_windows(benchmark, item_col, item_text_col, width)
    hits = _hits(df, windows, id_col, text_col, most_bytes)
    found = hits.where(F.size("hits") > 0)
    each = found.select("row", F.explode(F.array_distinct(F.expr("transform(hits, x -> x.w)"))).alias("w"))
    of_row = each.join(members, "w").groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    described = lambda rows, items: rows.select(
        "id",
        F.col("n_words").cast("long").alias("n_words"),
        F.expr(_COVERED).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        F.expr(_STRETCHES).alias("stretches"),
    )
    none = F.array().cast("array<string>")
    clean = described(hits.where(F.size("hits") == 0), none)
    return clean.unionByName(described(found.join(of_row, "row", "left"), F.coalesce("items", none)))


def _stretches_of(df: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, **options):
    """The frame with its row key in a new column, that column's name, and the keys with hits."""
    keyed, key = with_row_key(df, id_col, text_col)
    found = contaminated(keyed, benchmark, key, text_col, **options).where("contaminated")
    names = {"id": key, "stretches": free_name(keyed, "stretches")}
    found = durable(found.select("id", "stretches").dropDuplicates(["id"]), "benchmark-found")
    return keyed, key, found.withColumnsRenamed(names), names["stretches"]


def without_contaminated(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The rows without any hit, with all their columns."""
    keyed, key, found, _ = _stretches_of(df, benchmark, id_col, text_col, **options)
    return keyed.join(found.select(key), key, "left_anti").select(*[F.col(quoted(c)) for c in df.columns])


def without_passages(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """All rows; hit stretches of words are cut out of their texts, with what lies inside them."""
    keyed, key, found, stretches = _stretches_of(df, benchmark, id_col, text_col, **options)
    text = F.col(quoted(text_col)).cast("string")
    pieces = F.regexp_extract_all(text, F.lit(STRETCH), F.lit(0))
    # Words and what lies between them take turns: word k is piece 2k - 1, or 2k after a gap.
    gap = F.when(F.rlike(text, F.lit(STARTS_WITH_WORD)), 1).otherwise(0)
    rest = F.aggregate(
        F.col(stretches),
        F.struct(F.lit(1).alias("next"), F.array().cast("array<string>").alias("parts")),
        lambda s, x: F.struct(
            (2 * x["to"] - gap + 1).cast("int").alias("next"),
            F.concat(s["parts"], F.slice(pieces, s["next"], 2 * x["from"] - gap - s["next"])).alias("parts"),
        ),
        lambda s: F.array_join(F.concat(s["parts"], F.slice(pieces, s["next"], F.size(pieces))), ""),
    )
    cut = F.when(F.col(stretches).isNull(), text).otherwise(rest)
    columns = [cut.alias(c) if c == text_col else F.col(quoted(c)) for c in df.columns]
    return keyed.join(found, key, "left").select(*columns)
