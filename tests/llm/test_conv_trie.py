"""The conversation trie against a trie made of dictionaries."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from cartmetrics.llm.conv_trie import KEY, common_turns, conversation_trie, prefix_trie, rebuild

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def trie_by_hand(paths: dict[int, list]) -> list[tuple]:
    """paths: conv_id -> turns (role, text)."""
    members: dict[tuple, list[int]] = {}
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members.setdefault(tuple(paths[c][:d]), []).append(c)
    children: dict[tuple, list[tuple]] = {n: [] for n in members}
    for n in members:
        if n:
            children[n[:-1]].append(n)
    leaves, saved = {}, {}
    for n in sorted(members, key=len, reverse=True):
        leaves[n] = sum(leaves[c] for c in children[n]) or 1
        words = len(n[-1][1].encode().split()) if n else 0
        saved[n] = sum(saved[c] for c in children[n]) + (len(members[n]) - 1) * words
    rows = []
    for n, ids in members.items():
        ends = ",".join(str(c) for c in ids if len(paths[c]) == len(n))
        rows.append((ids[0], len(n), members[n[:-1]][0] if n else None, len(ids), len(children[n]), leaves[n], saved[n], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def rebuilt_by_hand(rows):
    own: dict[int, list] = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, key, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def collected(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.select(COLUMNS).collect()), key=str)


def random_rows(rng, conversations):
    rows = []
    for c in conversations:
        depth = rng.choice([0, 1, 2, 3, 5, 9])
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "b c", "", "d  e\nf"])) for t in range(depth)]
    return rows


def test_equals_a_trie_of_dictionaries(spark):
    rng = random.Random(3)
    rows = random_rows(rng, range(400))
    rows += [(500, None, "user", "null turn"), (500, 0, None, None), (500, 0, "user", "tie"), (500, 0, "user", "tie"), (None, 1, "user", "x")]
    rows += [(1000 + i, t, "user", f"turn {t}") for i in range(30) for t in range(40)]
    frame = spark.createDataFrame([(*r, 5) for r in rows], f"{SCHEMA}, depth int").repartition(5)
    want = trie_by_hand(rebuilt_by_hand(rows))
    assert collected(conversation_trie(frame)) == want and len(want) > 500


@pytest.mark.parametrize("seed", range(3))
def test_blocks_and_rounds_of_any_size_give_the_same_trie(spark, seed):
    """Small blocks, many partitions and small rounds: nodes cross borders at every level."""
    rng = random.Random(seed)
    rows = random_rows(rng, range(150))
    rows += [(2000 + i, t, "user", f"turn {t}") for i in range(25) for t in range(i)]
    rows += [(3000 + i, t, "user", "same") for i in range(60) for t in range(3)]
    by_hand = {c: turns for c, turns in rebuilt_by_hand(rows).items()}
    paths = rebuild(spark.createDataFrame(rows, SCHEMA)).cache()
    spark.conf.set("spark.sql.shuffle.partitions", 13)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = collected(prefix_trie(paths, block_rows=1 + seed, lists=2 + seed))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        paths.unpersist()
    assert got == trie_by_hand(by_hand)


def test_turnless_and_empty(spark):
    rows = [(25, 0, "user", "only turn")]  # the first turns of 25 come from 20, which is absent
    assert zlib.crc32(b"25") % 4 > 0
    assert collected(conversation_trie(spark.createDataFrame(rows, SCHEMA))) == [(25, 0, None, 1, 0, 1, 0, hashlib.sha256(b"25").hexdigest())]
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert conversation_trie(spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)).count() == 0


def test_common_turns():
    rng = random.Random(9)
    for _ in range(500):
        a, b = ([rng.choice("xy") for _ in range(rng.randint(0, 9))] for _ in range(2))
        same = next((i for i, (p, q) in enumerate(zip(a, b, strict=False)) if p != q), min(len(a), len(b)))
        assert common_turns("".join(c * KEY for c in a).encode(), "".join(c * KEY for c in b).encode()) == same
