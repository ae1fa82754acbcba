import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablehaul.llm import prefix_trie as P
from tablehaul.llm.common import ranked
from tablehaul.llm.parentheses import Parentheses

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, pos string, key string, bytes string"


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=300))
def test_parentheses(climbs):
    depths = [0]
    for c in climbs:
        depths.append(max(1, depths[-1] + 1 - c))
    sizes, leaves = Parentheses(np.array(depths)).sizes()
    for i, d in enumerate(depths):
        end = next((j for j in range(i + 1, len(depths)) if depths[j] <= d), len(depths))
        assert sizes[i] == end - i
        assert leaves[i] == sum(j + 1 == len(depths) or depths[j + 1] <= depths[j] for j in range(i, end))


def slow(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append((t is not None, t or 0, key, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    path = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        path[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, p in path.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
            if d:
                children[p[: d - 1]].add(p[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
            leaves[p[:d]] += not children[p]
    ends = {p: ",".join(map(str, sorted(c for c in m if len(path[c]) == len(p)))) for p, m in members.items()}
    return sorted(
        (
            (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
             hashlib.sha256(ends[p].encode()).hexdigest())
            for p, m in members.items()
        ),
        key=repr,
    )


def got(df, **options):
    convs, turns = P.rebuilt(P.numbered_turns(df))
    return sorted((tuple(r) for r in P.prefix_trie(turns, convs, **options).collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "own", "own", "own", "own") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("options", [{}, {"limit": 20}, {"step": 3}])
def test_whole_table(spark, options):
    """Also in many shards, merged in several rounds, and with paths cut into many steps."""
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert got(df, **options) == slow([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in df.collect()])


def odd_rows():
    rng, rows = random.Random(1), []
    for c in range(-7, 40):  # few different turns, so that much is shared
        rows += [(c, rng.choice([None, t, t, 1]), rng.choice("ua"), rng.choice(["x", "yy", ""])) for t in range(rng.randint(0, 12))]
    rows += [(3, 1, None, None)] * 3 + [(None, 1, "u", "x")] * 4 + [(41, None, "", "é" * 70_000)]
    # A long conversation, one that follows it for a while, and copies of one.
    rows += [(100, i, "u", str(i % 3)) for i in range(60)] + [(101, i, "u", str(i % 3)) for i in range(45)]
    return rows + [(c, i, "u", "same") for c in range(200, 260) for i in range(3)]


@pytest.mark.parametrize("options", [{}, {"step": 16, "limit": 30}])
def test_edges(spark, options):
    rows = odd_rows()
    assert got(frame(spark, rows), **options) == slow(rows)


def test_nothing(spark):
    assert got(frame(spark, [])) == [] == got(frame(spark, [(None, 1, "u", "x")]))


def test_one_turn(spark):
    assert got(frame(spark, [(5, 0, "u", "hello")])) == slow([(5, 0, "u", "hello")])


def test_long_conversations_meet_their_row_in_portions(spark, monkeypatch):
    monkeypatch.setattr(P, "PORTION", 7)
    rows = odd_rows()
    assert got(frame(spark, rows)) == slow(rows)


def test_packed_ids_of_a_hot_node(spark, monkeypatch):
    monkeypatch.setattr(P, "PACKED", 2)
    rows = [(c, 0, "u", "same") for c in range(0, 300, 5)]
    assert got(frame(spark, rows), limit=10) == slow(rows)


def test_ranks_run_on_over_chunks(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 1, 1, 2]), rng.choice([None, 0, 5, 5]), i) for i in range(500)]
    found = ranked(spark.createDataFrame(rows, "g int, o int, chunk int"), ["g"], ["o"]).collect()
    assert sorted(map(str, ((r["g"], r["o"], r["chunk"]) for r in found))) == sorted(map(str, rows))
    for g in (None, 1, 2):
        mine = sorted((r["rank"], r["o"] is not None, r["o"]) for r in found if r["g"] == g)
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1))
        assert [m[1:] for m in mine] == sorted((m[1:] for m in mine), key=lambda m: (m[0], m[1] or 0))


def test_names_of_cuts_run_on_over_chunks(spark):
    """A conversation that fills several chunks gets the names that one pass over it gives."""
    rng = random.Random(5)
    lengths = {1: 400, 2: 400, 3: 2}
    paths = {(c, b): "".join(rng.choices("0123456789ABCDEF", k=64)) for c in lengths for b in range(lengths[c])}
    paths |= {(2, b): paths[1, b] for b in range(300)}
    rows = [(c, b, p, [1, 2]) for (c, b), p in paths.items()]
    rng.shuffle(rows)
    blocks = spark.createDataFrame(rows, "conv bigint, block int, path string, lens array<bigint>").repartition(4)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would join the small chunks
    try:
        found = {(r["conv"], r["block"]): r for r in P._cuts(blocks).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert len(found) == len(rows)
    for c, n in lengths.items():
        name = 0
        for b in range(n):
            r = found[c, b]
            assert r["group"] == f"{name:032X}"
            name ^= int(hashlib.sha256(f"{b}:{paths[c, b]}".encode()).hexdigest()[:32], 16)
            assert (r["next_group"], r["ends"], r["path"]) == (f"{name:032X}", b == n - 1, paths[c, b])
