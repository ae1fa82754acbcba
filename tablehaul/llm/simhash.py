"""Near duplicates by SimHash over 3-word shingles, linked through popcount embeddings.

A fingerprint is mapped to the bit counts of its 32 two-bit segments. The Manhattan distance of
two such vectors never exceeds the Hamming distance, so fingerprints within RADIUS bits are
within Manhattan distance RADIUS. The segments form GROUPS groups; at that distance at most
RADIUS groups differ, so two linked fingerprints share a unit cell of one of the grids that
leave RADIUS groups out. Candidates of a cell pass the Manhattan bound over all segments first
and are then verified on the bits.

A cell of two is one candidate. Larger cells yield a spanning forest of their links, which is
all that components need. Cells of more than LIMIT fingerprints are not gathered but divided: their
members agree in the groups the grid fixes, so the segments of the others are grouped anew, and again
two linked fingerprints agree in all but RADIUS of these finer groups. Each member lies in as many
finer cells as there are ways to leave RADIUS of them out, whatever the cell's size.

The members of finer cells that still exceed LIMIT are joined through midpoints. Two fingerprints
within 3 bits have a point within 1 bit of one and 2 bits of the other; whatever lies around one point
is linked to a fingerprint within 1 bit of it, so the links grow with the members and none is lost.

Defined results: null and wordless texts have fingerprint zero and link like any other; texts of
one or two words have one shingle. A component's id is its smallest id (null if all are null).
Repeated rows share a fingerprint. Texts of any length are hashed whole. An empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import durable, id_and_text, map_arrow, map_texts, one_of_each, with_row_key
from tablehaul.llm.components import components

SHINGLE = 3
SEED = 42
RADIUS = 3
#: Groups of segments; a grid cell fixes GROUPS - RADIUS of them.
GROUPS = 6
LIMIT = 8192
LOW = 0x5555555555555555


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint, as a signed number."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: only A-Z and ASCII spaces
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(SHINGLE, len(words))
    h = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    hashes = np.fromiter((h(joined[s:e], SEED) for s, e in spans), np.uint64, len(words) - k + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].view(np.uint8)
        counts += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fp of each row."""
    return map_texts(
        id_and_text(df, id_col, text_col), lambda texts: {"fp": [fingerprint(t) for t in texts]}, "fp bigint"
    )


def _joined(segments: Iterable[int]) -> int:
    """A mask of two-bit segments."""
    return sum(3 << (2 * s) for s in segments)


def _groups(segments: list[int]) -> list[list[int]]:
    """Runs of these segments, as even as their number allows."""
    edges = [round(len(segments) * g / GROUPS) for g in range(GROUPS + 1)]
    return [segments[a:b] for a, b in pairwise(edges)]


def _fixed(segments: list[int]) -> list[list[int]]:
    """The segments that each grid over these keeps: all groups but RADIUS."""
    return [[s for g in groups for s in g] for groups in combinations(_groups(segments), GROUPS - RADIUS)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def grid_masks() -> list[int]:
    """What each grid keeps of an embedding."""
    return [_signed(_joined(kept)) for kept in _fixed(list(range(32)))]


def finer_masks() -> list[list[int]]:
    """What the grids that divide a cell of each grid keep: its segments, and groups of the others."""
    out = []
    for kept in _fixed(list(range(32))):
        others = [s for s in range(32) if s not in kept]
        out.append([_signed(_joined(kept + more)) for more in _fixed(others)])
    return out


def embedding(fp: Column) -> Column:
    """Bit counts of the two-bit segments, each in the place of its segment."""
    low, high = fp.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(LOW))
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def manhattan(a: Column, b: Column) -> Column:
    """Manhattan distance of two embeddings."""
    x = embedding(a).bitwiseXOR(embedding(b))
    low, high = x.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(x, 1).bitwiseAND(F.lit(LOW))
    # counts 1 and 2 differ in both bits of a segment, yet only by one
    return F.bit_count(low) + 2 * F.bit_count(high.bitwiseAND(F.bitwise_not(low)))


def _embedded(fps: np.ndarray) -> np.ndarray:
    low, high = fps & np.uint64(LOW), (fps >> np.uint64(1)) & np.uint64(LOW)
    return (low ^ high) | ((low & high) << np.uint64(1))


def _close(fps: np.ndarray, embedded: np.ndarray, fp: np.uint64, e: np.uint64) -> np.ndarray:
    """Which of the fingerprints link to fp: first by the Manhattan bound, then by the bits."""
    x = embedded ^ e
    low, high = x & np.uint64(LOW), (x >> np.uint64(1)) & np.uint64(LOW)
    # the counts are small unsigned bytes
    maybe = np.bitwise_count(low) + 2 * np.bitwise_count(high & ~low) <= RADIUS
    at = np.flatnonzero(maybe)
    return at[np.bitwise_count(fps[at] ^ fp) <= RADIUS]


def spanning_links(fps: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the links among these distinct fingerprints connect."""
    left, out = fps.view(np.uint64), []
    embedded = _embedded(left)
    while len(left):
        reached, left = [(left[0], embedded[0])], left[1:]
        embedded = embedded[1:]
        while reached and len(left):
            fp, e = reached.pop()
            hits = _close(left, embedded, fp, e)
            if len(hits):
                out += [(fp, h) for h in left[hits]]
                reached += zip(left[hits], embedded[hits], strict=True)
                left, embedded = np.delete(left, hits), np.delete(embedded, hits)
    return np.array(out, np.uint64).view(np.int64).reshape(-1, 2).tolist()


def _cell_links(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        links = []
        for cell in part.column("members"):
            links += spanning_links(cell.values.to_numpy())
        a, b = zip(*links, strict=True) if links else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _ball(radius: int) -> np.ndarray:
    """Masks of at most so many bits."""
    masks = [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(64), r)]
    return np.array(masks, np.uint64).view(np.int64)


def _around(fps: DataFrame, radius: int) -> DataFrame:
    """Every point within so many bits of each fingerprint."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ball = _ball(radius)
        for part in parts:
            values = part.column("fp").to_numpy()
            for at in range(0, len(values), 64):
                some = values[at : at + 64]
                points = (some[:, None] ^ ball[None, :]).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(points), pa.array(np.repeat(some, len(ball)))], ["point", "fp"]
                )

    return map_arrow(fps, run, "point bigint, fp bigint")


def _midpoint_links(fps: DataFrame) -> DataFrame:
    """Links of distinct fingerprints of any number, through midpoints."""
    centre = _around(fps, RADIUS // 2).groupBy("point").agg(F.min("fp").alias("b"))
    near = _around(fps, RADIUS - RADIUS // 2).withColumnRenamed("fp", "a")
    return near.join(centre, "point").where("a <> b").select("a", "b")


def _cells(fps: DataFrame) -> DataFrame:
    """fp, grid, cell: the cells each fingerprint lies in."""
    keys = [
        F.struct(F.lit(i).alias("grid"), embedding(F.col("fp")).bitwiseAND(F.lit(m)).alias("cell"))
        for i, m in enumerate(grid_masks())
    ]
    return fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.grid", "k.cell")


def _finer_cells(cells: DataFrame) -> DataFrame:
    """fp, grid, cell of the grids that divide these cells."""
    masks = F.array(*[F.array(*map(F.lit, of_grid)) for of_grid in finer_masks()])
    each = cells.select("fp", "grid", F.posexplode(F.get(masks, F.col("grid"))).alias("i", "mask"))
    grid = F.col("grid") * len(grid_masks()) + F.col("i")
    return each.select("fp", grid.alias("grid"), embedding(F.col("fp")).bitwiseAND(F.col("mask")).alias("cell"))


def _links_within(cells: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Links a, b found in cells of up to ``limit`` fingerprints, and the rows of larger cells, if there are any."""
    counted = durable(
        cells.groupBy("grid", "cell")
        .agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .where("n > 1"),
        "simhash-cells",
    )
    pairs = counted.where("n = 2").select("a", "b")
    pairs = pairs.where(manhattan(F.col("a"), F.col("b")) <= RADIUS)
    pairs = pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)
    key = ["grid", "cell"]
    members = (
        cells.join(counted.where((F.col("n") > 2) & (F.col("n") <= limit)).select(*key), key)
        .groupBy(*key)
        .agg(F.collect_list("fp").alias("members"))
        .select("members")
    )
    links = pairs.unionByName(map_arrow(members, _cell_links, "a bigint, b bigint"))
    hot = counted.where(F.col("n") > F.greatest(F.lit(limit), F.lit(2))).select(*key)
    if hot.isEmpty():
        return links, None
    return links, durable(cells.join(hot, key, "left_semi"), "simhash-hot")


def near_links(fps: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Links a, b among the distinct fingerprints of column fp.

    They connect exactly what all links within RADIUS bits connect.
    """
    links, crowded = _links_within(_cells(fps), limit)
    if crowded is not None:
        finer, crowded = _links_within(_finer_cells(crowded), limit)
        links = links.unionByName(finer)
    if crowded is not None:
        links = links.unionByName(_midpoint_links(crowded.select("fp").distinct()))
    return links


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT
) -> DataFrame:
    """Per row: id, fingerprint (hexadecimal) and component_id."""
    rows = durable(fingerprints(df, id_col, text_col), "simhash-rows")
    classes = durable(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-classes")
    found = components(near_links(classes.select("fp"), limit))
    linked = classes.join(found.withColumnRenamed("node", "fp"), "fp")
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = linked.join(least, "component").select("fp", F.struct("component_id").alias("in"))
    labels = durable(
        classes.join(linked, "fp", "left").select(
            "fp",
            F.when(F.col("in").isNull(), F.col("least"))
            .otherwise(F.col("in.component_id"))
            .alias("component_id"),
        ),
        "simhash-labels",
    )
    hexadecimal = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(labels, "fp").select("id", hexadecimal, "component_id")


def without_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, that of its smallest id, with all its columns."""
    keyed, key = with_row_key(df, id_col, text_col)
    found = near_duplicates(keyed, key, text_col)
    decisions = found.select("id", (F.col("id") == F.col("component_id")).alias("kept"))
    return one_of_each(df, decisions, id_col, text_col)
