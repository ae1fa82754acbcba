"""Mixing sources to target weights by pivotal dependent rounding, in built-in functions only.

A source's target divided by its size says how often each of its documents is wanted, a whole
number of copies and a fraction. The fractions of a source are rounded together: two documents
are paired, words move from one to the other at random until one of them has a whole number of
copies, and the other meets the next. Which way the words move is drawn so that every document
keeps its expected copies, and the words of the pair stay the same, so a source misses its
target by half of one row at most.

Rows that agree in id, source and size are one item. Of its m rows a fixed number get one copy more,
as many as m fractions make up in whole; only what remains, less than one row's copy, is rounded with the others.

Pairing is a reduction tree. A source's documents fall into blocks of about FAN; each block is
folded to rounded documents and one residual, FAN residuals make a block of the next level, and
the last residual of a source is rounded to the nearer whole number. Within a block the largest
documents go first, so what is left over is small. A hot source has more blocks, never a larger
one.

Sources in code-point order, null last, get the weights in turn. Targets share ``share`` times
all sizes; none exceeds ``most`` times its source's size, and what that leaves over is shared
again among the others by weight.

Defined results: a null text has size 0; documents of size 0 take no words and get the whole
part of their copies. The rows of an item differ by one copy at most. Texts of any length are counted whole.
Blocks break ties of size by hash. A null source is a source. An empty table gives no rows. Draws are
hashes of the seed and the item, so reruns agree. Other columns are not read.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import WORD, durable, free_name, quoted, ranked, with_row_key

FAN = 64
#: Rows of an item that are made as one group.
PORTION = 50_000
WEIGHTS = (3.0, 1.0, 2.0)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(items: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source: n items to round, source_size and target."""
    sources = durable(
        items.groupBy("source").agg(
            F.count("*").alias("n"), F.sum(F.col("size") * F.col("m")).alias("source_size")
        ),
        "mix-sources",
    )
    sources = ranked(sources.withColumn("absent", F.col("source").isNull()), [], ["absent", "source"], "turn")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("turn") - 1) % len(weights) + 1).cast("int"))
    sources = durable(
        sources.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(most)),
        "mix-weights",
    )
    total, all_weights = sources.agg(F.sum("source_size") * F.lit(share), F.sum("weight")).first()
    # Words per unit of weight rise until the same sources are capped twice running.
    level, capped = (total or 0.0) / (all_weights or 1.0), -1
    while True:
        full = F.col("most") <= F.col("weight") * F.lit(level)
        n, words, free = sources.agg(
            F.count_if(full),
            F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == capped or not free:
            break
        level, capped = max(level, (total - words) / free), n
    target = F.least(F.col("most"), F.col("weight") * F.lit(level))
    return sources.select("source", "n", "source_size", target.alias("target"))


def _uniform(seed: int, level: int, *of: str) -> Column:
    """A number in [0, 1) fixed by the seed, the level and the columns."""
    h = F.xxhash64(F.lit(seed), F.lit(level), *map(F.col, of))
    return F.shiftrightunsigned(h, 11) / F.lit(float(1 << 53))


#: One step of the fold: the carried document s meets the document y. ``toward`` is whether
#: words move to the carried one; its chance is such that expected copies stay as they are.
_TOWARD = (
    "y.u * (least(s.w * (1 - s.p), y.w * y.p) + least(s.w * s.p, y.w * (1 - y.p)))"
    " < least(s.w * s.p, y.w * (1 - y.p))"
)


def _step(at: str, p: str, w: str, final: str, up: int) -> str:
    return (
        f"named_struct('at', {at}, 'p', greatest(0D, least(1D, {p})), 'w', {w},"
        f" 'done', array_append(s.done, named_struct('at', {final}, 'up', {up})))"
    )


_FOLD = f"""
aggregate(
  transform(block_items, (x, i) -> named_struct('at', i, 'p', x.p, 'w', x.w, 'u', x.u)),
  named_struct('at', -1, 'p', 0D, 'w', 0D, 'done', cast(array() AS array<struct<at: int, up: int>>)),
  (s, y) -> CASE
    WHEN s.at < 0 THEN named_struct('at', y.at, 'p', y.p, 'w', y.w, 'done', s.done)
    WHEN {_TOWARD} THEN CASE
      WHEN s.w * (1 - s.p) <= y.w * y.p THEN {_step("y.at", "y.p - s.w * (1 - s.p) / y.w", "y.w", "s.at", 1)}
      ELSE {_step("s.at", "s.p + y.w * y.p / s.w", "s.w", "y.at", 0)} END
    WHEN s.w * s.p <= y.w * (1 - y.p) THEN {_step("y.at", "y.p + s.w * s.p / y.w", "y.w", "s.at", 0)}
    ELSE {_step("s.at", "s.p - y.w * (1 - y.p) / s.w", "s.w", "y.at", 1)} END
)
"""

_GROUP = ["source", "source_size", "target", "blocks", "block"]


def _folded(level: DataFrame, k: int, seed: int) -> DataFrame:
    """Each block's rounded items, and the item that is left over with its new fraction."""
    item = F.struct(
        (-F.col("w")).alias("order"),
        F.xxhash64("id", "size").alias("tie"),
        *["id", "size", "m", "whole", "sure", "p", "w"],
        _uniform(seed, k, "id", "size", "source").alias("u"),
    )
    blocks = level.groupBy(*_GROUP).agg(F.sort_array(F.collect_list(item)).alias("block_items"))
    blocks = blocks.withColumn("fold", F.expr(_FOLD))
    pick = "named_struct('id', x.id, 'size', x.size, 'm', x.m, 'whole', x.whole, 'more', x.sure + {})"
    done = "transform(fold.done, d -> transform(array(block_items[d.at]), x -> " + pick.format("d.up") + ")[0])"
    return blocks.select(
        *_GROUP,
        F.expr(done).alias("done"),
        F.expr("block_items[fold.at]").alias("rest"),
        F.expr("fold.p").alias("p"),
    )


def copies(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 2,
) -> DataFrame:
    """One row per item: id, source, size, m (rows of the item), source_size, target, whole, more.

    Each row of the item gets ``whole`` copies, and ``more`` of them one in addition.
    """
    rows = df.select(
        F.col(quoted(id_col)).alias("id"),
        F.col(quoted(source_col)).cast("string").alias("source"),
        word_count(F.col(quoted(text_col)).cast("string")).alias("size"),
    )
    items = durable(rows.groupBy("id", "source", "size").agg(F.count("*").alias("m")), "mix-items")
    targets = durable(source_targets(items, weights, share, most), "mix-targets")
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # The source table is read from files, so Spark broadcasts it only where its size allows.
    start = (
        items.join(targets, items.source.eqNullSafe(targets.source))
        .drop(targets.source)
        .withColumn("whole", F.floor(wanted).cast("int"))
        .withColumn("fractions", F.col("m") * (wanted - F.col("whole")))
        .withColumn("sure", F.when(F.col("size") > 0, F.floor("fractions")).otherwise(F.lit(0)).cast("long"))
        .withColumn("p", F.col("fractions") - F.floor("fractions"))
        .withColumn("w", F.col("size").cast("double"))
        .withColumn("blocks", F.ceil(F.col("n") / FAN).cast("long"))
        .withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "id", "size"), F.col("blocks")))
    )
    needed = (F.col("p") > 0) & (F.col("w") > 0)
    out_columns = ["id", "source", "size", "m", "source_size", "target", "whole"]
    rounded = [start.where(~needed).select(*out_columns, F.col("sure").alias("more"))]
    most_blocks = targets.agg(F.max(F.ceil(F.col("n") / FAN))).first()[0] or 1
    level, k = start.where(needed).select("id", "size", "m", "whole", "sure", "p", "w", *_GROUP), 0
    while True:
        folded = durable(_folded(level, k, seed), "mix-level")
        rounded.append(
            folded.select(*_GROUP, F.explode("done").alias("d")).select(
                "d.id", "source", "d.size", "d.m", "source_size", "target", "d.whole", "d.more"
            )
        )
        level = folded.select(
            *[F.col(f"rest.{c}").alias(c) for c in ("id", "size", "m", "whole", "sure")],
            "p",
            F.col("rest.w").alias("w"),
            *_GROUP[:3],
            F.ceil(F.col("blocks") / FAN).cast("long").alias("blocks"),
            F.floor(F.col("block") / FAN).cast("long").alias("block"),
        )
        if most_blocks <= 1:
            break
        most_blocks, k = ceil(most_blocks / FAN), k + 1
    nearest = F.col("sure") + F.when(F.col("p") >= 0.5, 1).otherwise(0)
    rounded.append(level.select(*out_columns, nearest.alias("more")))
    out = rounded[0]
    for part in rounded[1:]:
        out = out.unionByName(part)
    return out


def mixed(df: DataFrame, **options) -> DataFrame:
    """Per row: id, source, size, source_size, target, copies and taken (words the mix takes)."""
    items = durable(copies(df, **options), "mix-rounded")
    first = F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / PORTION))
    portions = items.select("*", F.explode(first).alias("portion"))
    if (items.agg(F.max("m")).first()[0] or 0) > PORTION:  # the rows of a hot item are made in many tasks
        portions = portions.repartition("id", "source", "size", "portion")
    begin = F.col("portion") * PORTION
    place = F.explode(F.sequence(begin + 1, F.least(begin + PORTION, F.col("m"))))
    rows = portions.select("*", place.alias("place"))
    rows = rows.withColumn("copies", F.col("whole") + F.when(F.col("place") <= F.col("more"), 1).otherwise(0))
    return rows.select(
        "id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixture(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows as often as the mix takes them, with all their columns."""
    keyed, key = with_row_key(df, id_col, text_col)
    items = durable(
        copies(keyed, key, text_col, source_col, **options)
        .where("whole > 0 OR more > 0")
        .select(F.col("id").alias("wanted_id"), F.col("source").alias("wanted_source"), "whole", "more", "m"),
        "mix-copies",
    )
    names = {c: free_name(keyed, c) for c in [*items.columns, "row", "place"]}
    items = items.withColumnsRenamed({c: names[c] for c in items.columns})
    whole, more, m, row, place = (names[c] for c in ("whole", "more", "m", "row", "place"))
    source = F.col(quoted(source_col)).cast("string")
    same = (F.col(key) == F.col(names["wanted_id"])) & source.eqNullSafe(F.col(names["wanted_source"]))
    columns = [F.col(quoted(c)) for c in df.columns]

    def repeated(rows: DataFrame, times: Column) -> DataFrame:
        each = F.explode(F.sequence(F.lit(1), times.cast("int")))
        return rows.where(times > 0).select(*columns, each.alias(place)).select(*columns)

    once = repeated(keyed.join(items.where(F.col(m) == 1), same), F.col(whole) + F.col(more))
    several = items.where(F.col(m) > 1)
    if several.isEmpty():
        return once
    # Rows of one item take turns: the first ``more`` of them get a copy in addition.
    rows = durable(keyed.join(several, same).withColumn(row, F.monotonically_increasing_id()), "mix-repeated")
    turns = ranked(rows.select(names["wanted_id"], names["wanted_source"], row), [names["wanted_id"], names["wanted_source"]], [row], place)
    rows = rows.join(turns.select(row, place), row)
    return once.unionByName(repeated(rows, F.col(whole) + F.when(F.col(place) <= F.col(more), 1).otherwise(0)))
