"""Exact duplicates by composable polynomial fingerprints.

A text's fingerprint is a polynomial of its UTF-8 bytes modulo two primes. Chunks are hashed
side by side and combined by length-shifted arithmetic, ``H(ab) = H(a) * B^|b| + H(b)``, so a
huge text is a tree of chunk hashes. Texts with equal fingerprints are then compared chunk by
chunk in a sorted stream; only texts that share a fingerprint are shuffled for that. A filter of 16 bits a shared
fingerprint picks them, or a semi-join where that would take more than 2^MOST_BITS bits.

A group with more than HOT_ROWS rows, or a hundred-thousandth of all, is dealt over as many streams as it holds such
portions, by a hash of task and row; what is left of each stream meets once more.

Defined results: a null text counts as empty, and empty texts equal each other. Of equal texts
the row with the largest id stays (null ids are smallest); of several rows with that id one
stays. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import durable, id_and_text, map_arrow, map_texts, one_of_each, with_row_key

MODULI = (2**31 - 1, 2**31 - 19)
BASES = (1_103_515_245, 747_796_405)
#: Bytes hashed as one chunk: 2^8 * 2^12 * 2^31 stays below 2^53, exact in double precision.
CHUNK = 4096
#: Bytes of a text compared at once.
COMPARED = 1 << 16
#: The filter that picks the texts to compare has 2^LEAST_BITS to 2^MOST_BITS bits: 32 MB at most.
LEAST_BITS, MOST_BITS = 16, 28
#: Groups with more rows are dealt over several streams while they are compared; there are at most MOST_HOT of them.
HOT_ROWS, MOST_HOT = 1_000, 100_000

CHUNK_SCHEMA = (
    "fingerprint bigint, n_bytes bigint, salt int, at bigint, sha256 string, chunk binary"
)


def _powers(n: int) -> np.ndarray:
    out = np.empty((n, 2), np.float64)
    for k, (base, p) in enumerate(zip(BASES, MODULI, strict=True)):
        x = 1
        for i in range(n - 1, -1, -1):
            out[i, k] = x
            x = x * base % p
    return out


_TABLE: list[np.ndarray] = []
_P = np.array(MODULI, np.int64)


def combine(a: tuple, b: tuple) -> tuple:
    """The fingerprint of two joined pieces, each given as (hash 1, hash 2, length)."""
    return (
        *((x * pow(base, b[2], p) + y) % p for x, y, base, p in zip(a, b, BASES, MODULI, strict=False)),
        a[2] + b[2],
    )


def fingerprint(data: bytes) -> tuple[int, int, int]:
    """(hash 1, hash 2, length) of the bytes."""
    if not _TABLE:
        _TABLE.append(_powers(CHUNK))
    powers, n = _TABLE[0], len(data)
    values = np.frombuffer(data, np.uint8)
    whole = n // CHUNK
    rest = values[whole * CHUNK :].astype(np.float64) @ powers[CHUNK - (n - whole * CHUNK) :]
    tail = (*(int(x) % p for x, p in zip(rest, MODULI, strict=True)), n - whole * CHUNK)
    if not whole:
        return tail
    # Each slice becomes doubles for a moment, so it is kept small.
    parts = [
        values[i * CHUNK : min(whole, i + 1024) * CHUNK].reshape(-1, CHUNK).astype(np.float64) @ powers
        for i in range(0, whole, 1024)
    ]
    hashes = np.concatenate(parts).astype(np.int64) % _P
    return combine((*_tree(hashes), whole * CHUNK), tail)


def _tree(hashes: np.ndarray) -> tuple[int, int]:
    """Combine the hashes of equally long chunks pairwise, level by level."""
    length = CHUNK
    while len(hashes) > 1:
        shift = np.array([pow(b, length, p) for b, p in zip(BASES, MODULI, strict=True)], np.int64)
        if len(hashes) % 2:  # a chunk of zeros before the first adds nothing
            hashes = np.concatenate([np.zeros((1, 2), np.int64), hashes])
        hashes = (hashes[::2] * shift % _P + hashes[1::2]) % _P
        length *= 2
    return int(hashes[0, 0]), int(hashes[0, 1])


def _joined(parts: tuple[int, int, int]) -> int:
    return (parts[0] << 31) | parts[1]


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fingerprint, n_bytes and sha256 of each text."""

    def made(texts):
        data = [(t or "").encode("utf-8") for t in texts]
        return {
            "fingerprint": [_joined(fingerprint(d)) for d in data],
            "n_bytes": [len(d) for d in data],
            "sha256": [hashlib.sha256(d).hexdigest() for d in data],
        }

    return map_texts(
        id_and_text(df, id_col, text_col), made, "fingerprint bigint, n_bytes bigint, sha256 string"
    )


def filter_bits(n: int) -> int:
    """Logarithm of the bits of a filter for n fingerprints, 16 for each."""
    return max(LEAST_BITS, (16 * max(1, n) - 1).bit_length())


def _bitmap(groups: DataFrame, width: int) -> bytes:
    """A bit per low-order fingerprint bits that occur in the groups, 2^width in all."""
    # Positions start at 1, as do the bucket numbers; a bucket holds 2^15 bits.
    at = F.col("fingerprint").bitwiseAND(F.lit((1 << width) - 1)) + 1
    rows = (
        groups.select(at.alias("at"))
        .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
        .collect()
    )
    out = bytearray(1 << (width - 3))
    for r in rows:
        out[(r["bucket"] - 1) << 12 : r["bucket"] << 12] = bytes(r["bits"])
    return bytes(out)


def _has(bitmap: np.ndarray, value: int) -> bool:
    at = value & (len(bitmap) * 8 - 1)
    return bool(bitmap[at >> 3] >> (at & 7) & 1)


def _hot(shared: DataFrame, n_rows: int) -> dict[int, int]:
    """Number of streams of each fingerprint with many rows: at most MOST_HOT fingerprints."""
    portion = max(HOT_ROWS, n_rows // MOST_HOT)
    many = shared.groupBy("fingerprint").agg(F.sum("count").alias("n")).where(F.col("n") > portion)
    return {r["fingerprint"]: -(-r["n"] // portion) for r in many.collect()}


def spread(task: int, row: int) -> int:
    """A number that is even over tasks and rows, whichever of them a group has."""
    x = (task * 0x9E3779B97F4A7C15 + row * 0xD1B54A32D192ED03 + 1) & 0xFFFFFFFFFFFFFFFF
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> shift) * factor & 0xFFFFFFFFFFFFFFFF
    return x ^ x >> 31


def _chunks(texts: DataFrame, wanted: bytes | None, hot: dict[int, int]) -> DataFrame:
    """Chunks of the texts whose fingerprint may be shared: of all if there is no filter."""
    spark = texts.sparkSession
    wanted, hot = spark.sparkContext.broadcast(wanted), spark.sparkContext.broadcast(hot)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        any_ = None if wanted.value is None else np.frombuffer(wanted.value, np.uint8)
        task, at_row = TaskContext.get().partitionId(), 0
        names = ["fingerprint", "n_bytes", "salt", "at", "sha256", "chunk"]
        for part in parts:
            rows, held = [], 0
            for text in part.column("text"):
                at_row += 1
                data = (text.as_py() or "").encode("utf-8")
                key = _joined(fingerprint(data))
                if any_ is not None and not _has(any_, key):
                    continue
                sha = hashlib.sha256(data).hexdigest()
                streams = hot.value.get(key, 0)
                salt = 1 + spread(task, at_row) % streams if streams else 0
                for at in range(0, max(1, len(data)), COMPARED):
                    rows.append((key, len(data), salt, at, sha, data[at : at + COMPARED]))
                    held += COMPARED if len(data) > COMPARED else len(data)
                    if held > 1 << 24:
                        yield _batch(rows, names)
                        rows, held = [], 0
            if rows:
                yield _batch(rows, names)

    return map_arrow(texts.select("text"), run, CHUNK_SCHEMA)


def _compared_texts(df: DataFrame, shared: DataFrame, n_rows: int, id_col: str, text_col: str) -> DataFrame:
    """Chunks of the texts that share a fingerprint."""
    texts, n = id_and_text(df, id_col, text_col), shared.count()
    if filter_bits(n) <= MOST_BITS:
        return _chunks(texts, _bitmap(shared, filter_bits(n)), _hot(shared, n_rows))

    def made(some):
        return {"fingerprint": [_joined(fingerprint((t or "").encode("utf-8"))) for t in some], "text": some}

    known = map_texts(texts, made, "fingerprint bigint, text string").select("fingerprint", "text")
    return _chunks(known.join(shared.select("fingerprint"), "fingerprint", "left_semi"), None, _hot(shared, n_rows))


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.binary()]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names)


def _compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each chunk with the one before it, in a stream sorted by fingerprint and offset.

    Yields the first chunk of each run (differs = false) and every chunk that is not equal to
    the one before it (differs = true).
    """
    last = None
    for part in parts:
        n = part.num_rows
        if not n:
            continue
        whole = pa.Table.from_batches([part] if last is None else [last, part]).combine_chunks()
        lead = whole.num_rows - n
        key = ("fingerprint", "n_bytes", "salt", "at")
        same = np.ones(whole.num_rows - 1, bool)
        for k in key:
            values = whole[k].to_numpy()
            same &= values[1:] == values[:-1]
        equal = pc.equal(whole["chunk"][1:], whole["chunk"][: whole.num_rows - 1]).to_numpy()
        first = ~same if lead else np.concatenate([[True], ~same])
        wrong = same & ~equal if lead else np.concatenate([[False], same & ~equal])
        rows = whole.slice(lead)
        last = rows.slice(n - 1).to_batches()[0]
        out = rows.append_column("differs", pa.array(wrong)).filter(pa.array(first | wrong))
        yield from out.to_batches()


def _collided(chunks: DataFrame) -> DataFrame:
    """Fingerprints (with length) under which different texts were found."""
    key = ["fingerprint", "n_bytes", "salt", "at"]
    schema = f"{CHUNK_SCHEMA}, differs boolean"
    n = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # One stream for a group, and one for each salt of a hot group.
    sorted_ = chunks.repartition(n, *key[:3]).sortWithinPartitions(*key)
    first = map_arrow(sorted_, _compare, schema)
    first = durable(first.where(F.col("differs") | (F.col("salt") > 0)), "dedup-firsts")
    # What is left of the streams of a hot group: equal chunks merge where they are, and are shuffled once.
    key = ["fingerprint", "n_bytes", "at"]
    left = first.where("NOT differs").select(*key, "chunk").distinct().groupBy(*key).count().where("count > 1")
    return first.where("differs").select("fingerprint", "n_bytes").unionByName(left.select("fingerprint", "n_bytes")).distinct()


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, keep_id, group_size, kept and text_sha256."""
    rows = durable(
        fingerprints(df, id_col, text_col).withColumn("row", F.monotonically_increasing_id()),
        "dedup-rows",
    )
    shared = durable(
        rows.groupBy("fingerprint", "n_bytes").count().where("count > 1"), "dedup-shared"
    )
    chunks = _compared_texts(df, shared, rows.count(), id_col, text_col)
    collided = durable(_collided(chunks), "dedup-collided")
    key = ["fingerprint", "n_bytes"]
    if collided.isEmpty():
        rows = rows.withColumn("split", F.lit(""))
    else:  # different texts under one fingerprint are told apart by their SHA-256
        hit = collided.withColumn("hit", F.lit(True))
        rows = rows.join(hit, key, "left").withColumn(
            "split", F.when(F.col("hit"), F.col("sha256")).otherwise("")
        ).drop("hit")
    key = [*key, "split"]
    groups = durable(
        rows.groupBy(*key)
        .agg(F.count("*").alias("group_size"), F.max(F.struct("id", "row")).alias("top"))
        .where("group_size > 1"),
        "dedup-groups",
    )
    return rows.join(groups, key, "left").select(
        "id",
        F.when(F.col("top").isNull(), F.col("id")).otherwise(F.col("top.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("top").isNull() | (F.col("top.row") == F.col("row"))).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )


def without_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of equal texts, with all its columns."""
    keyed, key = with_row_key(df, id_col, text_col)
    return one_of_each(df, exact_duplicates(keyed, key, text_col), id_col, text_col)
