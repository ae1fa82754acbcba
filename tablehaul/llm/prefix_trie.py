"""Prefix trie of conversations in balanced parentheses, shard by shard.

A conversation is the path of its turns' keys, hashes of role and text. Conversations sorted by
path, then id, come in the preorder of the trie, so a shard, a run of that order of at most ``limit`` nodes, is
a tree of its own: one parenthesis pair per node, whose closing one is found with a range min-max
tree of excess. The size of a subtree, its leaves (pairs that close at once) and, from cumulative
arrays, its conversations and what sharing them saves follow from that. Only nodes on the first and last path
of a shard may go on in another. These spines, with what the shard found beside them, are sorted and
built into shards again until one shard holds all, so that a hot node is merged from one row per shard.

Texts never leave the scan; turns are dealt out by range. A path is cut every ``step`` turns: what follows hangs under the
node it was cut at, by a hash of the turns so far. Cuts that only one
conversation reaches make no trie: their nodes are rows by themselves, so that a conversation of any length is
spread like others. The ids of conversations that end at a node are hashed in order, by one stream over packed ids where
they lie in several shards.

Defined results: turns are ordered by their number, null first, then by key. A null role or text counts as
empty; turns without a conversation id are dropped; repeated rows are turns of their own. Texts of any length
are hashed whole. An empty table gives no nodes, not even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tablehaul.llm.common import durable, map_arrow, quoted, ranked
from tablehaul.llm.parentheses import Parentheses

#: Characters of a key: 128 bits of SHA-256.
KEY = 32
STEP, LIMIT = 256, 1 << 17
#: Turns of a conversation that are joined with it as one group.
PORTION = 100_000
#: Ids packed into one row.
PACKED = 500
ROOT = "0" * KEY
NO_ENDS = hashlib.sha256(b"").hexdigest()
NONE = np.iinfo(np.int64).max

NODE, SPINE, TOP, ENDS = range(4)
#: ITEM is what a shard is built of. NODE: a finished node. SPINE: an item of the next round. TOP: what hangs under a cut.
#: ENDS: ids that end at a node of a spine.
ITEM = "path string, lens array<bigint>, conv bigint, n bigint, leaves bigint, saved bigint, children bigint, ends boolean"
FOUND = f"kind int, depth bigint, parent bigint, key string, parent_key string, ends_sha256 string, ids string, {ITEM}"
NODE_FIELDS = ("conv", "depth", "parent", "n", "children", "leaves", "saved", "ends_sha256", "key", "parent_key")


# ---- turns ------------------------------------------------------------------------------


def numbered_turns(
    df: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text"
) -> DataFrame:
    """conv, pos (place in the conversation, from 1), key and bytes (of the text) of each turn."""
    part = lambda c: F.coalesce(F.col(quoted(c)).cast("string"), F.lit(""))
    role, text = part(role_col), part(text_col)
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = df.select(
        F.col(quoted(conv_col)).cast("long").alias("conv"),
        F.col(quoted(turn_col)).alias("turn"),
        F.upper(F.substring(F.sha2(whole, 256), 1, KEY)).alias("key"),
        F.octet_length(text).cast("long").alias("bytes"),
    ).where("conv IS NOT NULL")
    return ranked(turns, ["conv"], ["turn", "key"], "pos").drop("turn")


def rebuilt(turns: DataFrame, family: int = 5, folds: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations and their turns, once each begins with the first turns of its family's first.

    Conversation c takes h = crc32(c) modulo ``folds`` turns from c - c % family in place of its
    own first h; where there are fewer it takes those.
    """
    turns = durable(turns, "trie-turns")
    first = F.struct("pos", "key", "bytes")
    heads = durable(
        turns.groupBy("conv").agg(
            F.sort_array(F.collect_list(F.when(F.col("pos") < folds, first))).alias("head"),
            F.count("*").alias("n"),
        ),
        "trie-heads",
    )
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % folds
    base = heads.select(F.col("conv").alias("base"), F.col("head").alias("base_head"))
    convs = heads.select("conv", "n", h.cast("int").alias("h"), (F.col("conv") - F.col("conv") % family).alias("base"))
    taken = F.coalesce(F.slice("base_head", 1, F.col("h")), F.expr("slice(head, 1, 0)"))
    convs = convs.join(heads.select("conv", "head"), "conv").join(base, "base", "left")
    convs = durable(convs.select("conv", "n", "h", taken.alias("taken")), "trie-convs")
    # A long conversation meets its own row in portions, so none is a group of one task.
    portions = convs.select(
        "conv",
        (F.size("taken") - F.col("h")).alias("moved"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n") / PORTION))).alias("portion"),
    )
    own = turns.where(F.col("pos") > h).withColumn("portion", F.floor(F.col("pos") / PORTION))
    own = own.join(portions, ["conv", "portion"])
    own = own.select("conv", (F.col("pos") + F.col("moved")).alias("pos"), "key", "bytes")
    before = convs.select("conv", F.explode("taken").alias("t")).select("conv", "t.*")
    return convs.select("conv"), before.unionByName(own)


# ---- one shard --------------------------------------------------------------------------


def _key(path: str, level: int) -> str:
    """The key of a node by its path, as ``_cuts`` computes it."""
    group, inner = path[:KEY], path[KEY:]
    if not inner:
        return group
    own = int(hashlib.sha256(f"{level}:{inner}".encode()).hexdigest()[:KEY], 16)
    return f"{int(group, 16) ^ own:032X}"


class Shard:
    """The trie of a run of items in order: path, lens, conv, n, leaves, saved, children, ends.

    Node 0 stands above all groups. An item adds its n, leaves, saved and children to the node
    its path ends at, and its id to that node's ``ends`` if it has any.
    """

    def __init__(self) -> None:
        self.items: list[tuple] = []
        self.depth, self.parent, self.bytes, self.last_item = [0], [-1], [0], [0]
        self.own = {0: [0, NONE, 0, 0, 0]}
        self.ends: dict[int, list[int]] = {}
        self.stack, self.first_path, self.path = [0], [0], ""

    def add(self, item: tuple) -> None:
        path, lens, conv, n, leaves, saved, children, ends = item
        shared, m, before = 0, len(path) // KEY, self.path
        while shared < m and path[shared * KEY : shared * KEY + KEY] == before[shared * KEY : shared * KEY + KEY]:
            shared += 1
        del self.stack[shared + 1 :]
        for d in range(shared, m):
            self.depth.append(d + 1)
            self.parent.append(self.stack[-1])
            self.bytes.append(lens[d])
            self.last_item.append(len(self.items))
            self.stack.append(len(self.depth) - 1)
        if not self.items:
            self.first_path = self.stack[:]
        self.path, node = path, self.stack[-1]
        own = self.own.setdefault(node, [0, NONE, 0, 0, 0])
        own[0] += n
        own[1] = min(own[1], NONE if conv is None else conv)
        for i, v in enumerate((leaves, saved, children)):
            own[2 + i] += v
        if ends:
            self.ends.setdefault(node, []).append(conv)
        self.items.append((path, lens))

    def full(self, limit: int) -> bool:
        return len(self.items) >= limit or len(self.depth) >= limit

    def results(self, level: int, step: int, first_round: bool, whole: bool) -> Iterator[dict]:
        """Rows of FOUND. ``whole`` says that nothing goes on in other shards."""
        depth, parent = np.array(self.depth), np.array(self.parent)
        count = len(depth)
        own = np.zeros((5, count), np.int64)
        own[1] = NONE
        own[:, list(self.own)] = np.array(list(self.own.values())).T
        spine = np.zeros(count, bool)
        if not whole:
            spine[self.first_path] = spine[self.stack] = True
        size, pairs = Parentheses(depth).sizes()
        at = np.arange(count)

        def below(values: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(values)])
            return sums[at + size] - sums[at]

        n = below(own[0])
        least = np.minimum.reduceat(np.append(own[1], NONE), np.stack([at, at + size], 1).ravel())[::2]
        children = np.bincount(parent[1:], minlength=count)
        not_yet = (size == 1) & (spine | (own[4] > 0))  # a pair, but it has children elsewhere or may have
        leaves = pairs + below(own[2] - not_yet)
        saved = below(own[3] + np.where(spine, 0, np.maximum(n - 1, 0) * np.array(self.bytes)))
        for node in range(1, count):
            path, lens = self.items[self.last_item[node]]
            path, d = path[: depth[node] * KEY], int(depth[node])
            if spine[node]:
                inner = [c for c in {*self.first_path[d + 1 : d + 2], *self.stack[d + 1 : d + 2]} if parent[c] == node]
                less = lambda v, inner=inner: sum(int(v[c]) for c in inner)
                yield {
                    "kind": SPINE, "path": path, "lens": lens[:d], "conv": int(least[node]),
                    "n": int(n[node]) - less(n), "leaves": int(leaves[node]) - less(leaves),
                    "saved": int(saved[node]) - less(saved), "ends": False,
                    "children": int(own[4, node] + children[node]) - len(inner),
                }
                found = self.ends.get(node, ())
                for i in range(0, len(found), PACKED):
                    ids = found[i : i + PACKED]
                    yield {"kind": ENDS, "key": _key(path, level), "conv": ids[0], "ids": ",".join(map(str, ids))}
                continue
            row = {
                "n": int(n[node]), "leaves": int(leaves[node]), "saved": int(saved[node]),
                "children": int(own[4, node] + children[node]), "conv": int(least[node]),
            }
            if d == 1 and level:
                yield row | {"kind": TOP, "key": path}
                continue
            row |= {"kind": NODE, "depth": level * step + d - 1}
            if d > 1 and (spine[parent[node]] or (d == 2 and level)):
                row["parent_key"] = _key(path[:-KEY], level)
            elif d > 1:
                row["parent"] = int(least[parent[node]])
            if not first_round or d == step + 1:
                row["key"] = _key(path, level)
            if first_round:
                ids = ",".join(map(str, self.ends.get(node, ())))
                row["ends_sha256"] = hashlib.sha256(ids.encode()).hexdigest() if ids else NO_ENDS
            yield row


def _built(items: DataFrame, level: int, step: int, limit: int, first_round: bool, whole: bool) -> DataFrame:
    """Shards of items that come sorted by path and conv."""
    fields = T.StructType.fromDDL(FOUND)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(fields)

        def batches(shard: Shard) -> Iterator[pa.RecordBatch]:
            rows = []
            for row in shard.results(level, step, first_round, whole):
                rows.append(row)
                if len(rows) == 4096:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema)

        shard = Shard()
        for part in parts:
            for item in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if not whole and shard.full(limit):
                    yield from batches(shard)
                    shard = Shard()
                shard.add(item)
        if shard.items:
            yield from batches(shard)

    columns = [c.split()[0] for c in ITEM.split(", ")]
    return map_arrow(items.select(*columns), run, fields)


def _level(items: DataFrame, level: int, step: int, limit: int) -> DataFrame:
    """All that a level's items give, round by round."""
    order, found, first = ["path", "conv"], [], True
    while True:
        whole = not first and items.count() <= limit
        dealt = items.coalesce(1) if whole else items.repartitionByRange(*order)
        out = durable(_built(dealt.sortWithinPartitions(*order), level, step, limit, first, whole), "trie-round")
        found.append(out.where(F.col("kind") != SPINE))
        items, first = out.where(F.col("kind") == SPINE), False
        if whole or items.isEmpty():
            return reduce(DataFrame.unionByName, found)


# ---- all shards -------------------------------------------------------------------------


def _blocks(turns: DataFrame, convs: DataFrame, step: int) -> DataFrame:
    """Per conversation and ``step`` turns: conv, block, path and lens."""
    each = turns.select(
        "conv",
        F.floor((F.col("pos") - 1) / step).cast("int").alias("block"),
        F.struct("pos", "key", "bytes").alias("turn"),
    )
    none = convs.select("conv", F.lit(0).alias("block"), F.lit(None).cast(each.schema["turn"].dataType).alias("turn"))
    blocks = each.unionByName(none).groupBy("conv", "block").agg(F.sort_array(F.collect_list("turn")).alias("t"))
    return blocks.select("conv", "block", F.array_join("t.key", "").alias("path"), F.col("t.bytes").alias("lens"))


def _cuts(blocks: DataFrame) -> DataFrame:
    """Blocks of long conversations with group and next_group, which name the turns before and up to their end.

    A name is the exclusive or of the hashes of the blocks it covers. The blocks are dealt out by range, so that a conversation,
    however long, lies in as many chunks as it fills; the chunks' own names, a row each, say where the next one begins.
    """
    digest = F.sha2(F.concat(F.col("block").cast("string"), F.lit(":"), F.col("path")).cast("binary"), 256)
    halves = ("high", "low")
    hashed = blocks.select(
        "*", *[F.conv(F.substring(digest, at, 16), 16, -10).cast("long").alias(c) for c, at in zip(halves, (1, 17), strict=True)]
    )
    dealt = durable(
        hashed.repartitionByRange("conv", "block").withColumn("chunk", F.spark_partition_id()), "trie-hashed"
    )
    zero = F.lit(0).cast("long")

    def before(c: str, order) -> Column:
        return F.coalesce(F.bit_xor(c).over(order.rowsBetween(Window.unboundedPreceding, -1)), zero)

    chunks = dealt.groupBy("conv", "chunk").agg(*[F.bit_xor(c).alias(c) for c in halves], F.max("block").alias("last"))
    of_conv = Window.partitionBy("conv")
    chunks = durable(
        chunks.select(
            "conv", "chunk", F.max("last").over(of_conv).alias("last"),
            *[before(c, of_conv.orderBy("chunk")).alias(f"{c}_of_chunk") for c in halves],
        ),
        "trie-chunks",
    )
    inside = Window.partitionBy("conv", "chunk").orderBy("block")
    cuts = dealt.select("*", *[before(c, inside).alias(f"{c}_inside") for c in halves]).join(chunks, ["conv", "chunk"])

    def name(*parts: str) -> Column:
        both = [reduce(Column.bitwiseXOR, [F.col(f"{c}{part}") for part in parts]) for c in halves]
        return F.concat(*[F.lpad(F.hex(c), 16, "0") for c in both])

    return cuts.select(
        "conv", "block", "path", "lens", (F.col("block") == F.col("last")).alias("ends"),
        name("_of_chunk", "_inside").alias("group"),
        name("_of_chunk", "_inside", "").alias("next_group"),
    )


def _items(cuts: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return cuts.select(
        F.concat("group", "path").alias("path"),
        F.concat(F.array(zero), F.col("lens")).alias("lens"),
        "conv",
        F.lit(1).cast("long").alias("n"),
        *[zero.alias(c) for c in ("leaves", "saved", "children")],
        "ends",
    )


def _alone(cuts: DataFrame, step: int) -> DataFrame:
    """Nodes of cuts that only one conversation reaches."""
    each = cuts.select("*", F.posexplode("lens").alias("i", "len"))
    last = F.col("i") + 1 == F.size("lens")
    ends = last & F.col("ends")
    return each.select(
        "conv",
        (F.col("block").cast("long") * step + F.col("i") + 1).alias("depth"),
        F.when(F.col("i") > 0, F.col("conv")).alias("parent"),
        F.lit(1).cast("long").alias("n"),
        F.when(ends, 0).otherwise(1).cast("long").alias("children"),
        F.lit(1).cast("long").alias("leaves"),
        F.lit(0).cast("long").alias("saved"),
        F.when(ends, F.sha2(F.col("conv").cast("string").cast("binary"), 256)).otherwise(NO_ENDS).alias("ends_sha256"),
        F.when(last & ~F.col("ends"), F.col("next_group")).alias("key"),
        F.when(F.col("i") == 0, F.col("group")).alias("parent_key"),
    )


def _streamed(packed: DataFrame) -> DataFrame:
    """key and SHA-256 of all its ids: one stream per key, in which a row is PACKED ids."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, hashlib.sha256()
        done: list[tuple[str, str]] = []
        for part in parts:
            for key, ids in zip(part.column("key").to_pylist(), part.column("ids").to_pylist(), strict=True):
                if key != now:
                    if now is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(f",{ids}".encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[i] for d in done], pa.string()) for i in (0, 1)], ["key", "ends"]
            )
            done = []
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([digest.hexdigest()])], ["key", "ends"])

    rows = packed.select("key", "conv", "ids").repartition("key").sortWithinPartitions("key", "conv")
    return map_arrow(rows, run, "key string, ends string")


def prefix_trie(turns: DataFrame, convs: DataFrame, step: int = STEP, limit: int = LIMIT) -> DataFrame:
    """The nodes: conv (smallest member), depth, parent, n, children, leaves, saved, ends_sha256.

    ``turns`` has conv, pos from 1 without gaps, key and bytes; ``convs`` each conv once, those without turns too.
    """
    blocks = durable(_blocks(turns, convs, step), "trie-blocks")
    long = durable(blocks.where("block > 0").select("conv").distinct(), "trie-long")
    whole = blocks.join(long, "conv", "left_anti")
    shallow = whole.withColumn("group", F.lit(ROOT)).withColumn("ends", F.lit(True))
    if long.isEmpty():
        found = [_level(_items(shallow), 0, step, limit)]
        alone = None
    else:
        cuts = durable(_cuts(blocks.join(long, "conv", "left_semi")), "trie-cuts")
        sizes = durable(cuts.where("block > 0").groupBy("block", "group").agg(F.count("*").alias("n")), "trie-cut-sizes")
        several = sizes.where("n > 1").select("block", "group")
        single = cuts.join(sizes.where("n = 1").select("block", "group"), ["block", "group"], "left_semi")
        alone = _alone(single, step)
        one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
        under_one = sizes.where("n = 1").select(F.col("group").alias("next_group"), one.alias("leaves"), none.alias("saved"), one.alias("children"))
        found, tops = [], under_one
        for level in range(several.agg(F.max("block")).first()[0] or 0, -1, -1):
            here = cuts.where(F.col("block") == level)
            if level:
                here = here.join(several, ["block", "group"], "left_semi")
            # What goes on hangs under the node it was cut at, once for all conversations there.
            hang = here.where("NOT ends").groupBy("next_group").agg(
                F.min_by(F.struct("group", "path", "lens"), "conv").alias("at")
            )
            hang = hang.join(tops, "next_group").select(
                F.concat("at.group", "at.path").alias("path"),
                F.concat(F.array(none), F.col("at.lens")).alias("lens"),
                F.lit(None).cast("long").alias("conv"),
                none.alias("n"), "leaves", "saved", "children", F.lit(False).alias("ends"),
            )
            items = _items(here).unionByName(hang)
            out = _level(items if level else items.unionByName(_items(shallow)), level, step, limit)
            found.append(out)
            top = out.where(F.col("kind") == TOP).select(F.col("key").alias("next_group"), "leaves", "saved", "children")
            tops = under_one.unionByName(top)
    every = reduce(DataFrame.unionByName, found)
    nodes = every.where(F.col("kind") == NODE).select(*NODE_FIELDS)
    nodes = durable(nodes.unionByName(alone) if alone is not None else nodes, "trie-nodes")
    ends = durable(_streamed(every.where(F.col("kind") == ENDS)), "trie-ends")
    open_ = nodes.where("ends_sha256 IS NULL").drop("ends_sha256").join(ends, "key", "left")
    open_ = open_.withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS))).select(*NODE_FIELDS)
    nodes = nodes.where("ends_sha256 IS NOT NULL").unionByName(open_)
    parents = nodes.where("key IS NOT NULL").select(F.col("key").alias("parent_key"), F.col("conv").alias("above"))
    under = nodes.where("parent_key IS NOT NULL").join(parents, "parent_key", "left").withColumn("parent", F.col("above"))
    fields = list(NODE_FIELDS[:8])
    return nodes.where("parent_key IS NULL").select(*fields).unionByName(under.select(*fields))


def rebuilt_trie(df: DataFrame, **columns) -> DataFrame:
    """The trie of the rebuilt conversations of a table of turns."""
    convs, turns = rebuilt(numbered_turns(df, **columns))
    return prefix_trie(turns, convs)
