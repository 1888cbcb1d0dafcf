"""Prefix trie of conversations, built from sorted neighbours.

Conversations are sorted by their turns, so that those below one node stand side by side. Two neighbours share their
longest common prefix; joining neighbours along these edges in descending depth, with union-find, makes a branching
node of every component that a merge closes. The rows of one task are taken in blocks. What a block can't close, the
nodes on its first and its last path, is contracted to a short list of items with the depths at which they join, and
lists of neighbouring blocks and partitions are merged by the same step until one list is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from dataclasses import field as default

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmetrics.llm.common import SPACE, cut

#: Conversations (or bytes of paths) of one block, contracted lists of one merge, bytes of a turn's key.
BLOCK_ROWS, BLOCK_BYTES, LISTS, KEY = 4096, 16_000_000, 128, 16
_SEQ, _LEVEL = 24, 56
NO_ENDS = hashlib.sha256(b"").hexdigest()

_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, node_key binary, parent_key binary"
_LIST = "first binary, first_words array<int>, last binary, last_words array<int>, items array<struct<side:int,depth:long,n:long,low:long,kids:long,leaves:long,saved:long>>"
_OUT = f"kind string, at long, {_NODE}, ids string, {_LIST}"
_ITEM = pa.list_(pa.struct([("side", pa.int32()), *((c, pa.int64()) for c in ("depth", "n", "low", "kids", "leaves", "saved"))]))
_TYPES = {"kind": pa.string(), "at": pa.int64()}
_TYPES |= {c: pa.int64() for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")}
_TYPES |= {"ends_sha256": pa.string(), "node_key": pa.binary(), "parent_key": pa.binary(), "ids": pa.string()}
_TYPES |= {"first": pa.binary(), "first_words": pa.list_(pa.int32()), "last": pa.binary(), "last_words": pa.list_(pa.int32()), "items": _ITEM}
_NODES = list(_TYPES)[2:12]


def rebuild(conversations: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """conv_id, path (the keys of its turns, KEY bytes each), words (of each turn) of every conversation.

    Turns are ordered by turn, null first, equal ones by the key, which is the md5 of role and text (null: empty). The
    first crc32(conv_id) mod heads turns come from conversation conv_id - conv_id % group, as far as it has them.
    Repeated rows are turns of their own. Rows without conv_id take no part. One conversation is one row here: its
    keys, not its texts, have to fit into a task's memory.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turns = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", key.alias("key"), F.regexp_count(text, F.lit(f"[^{SPACE[1:-1]}]+")).alias("words")).alias("t"))
    own = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("own"))
    own = own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % group, "h": (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")})
    first = own.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("own", 1, max(heads - 1, 1)).alias("head"))
    none = F.slice("own", 1, 0)
    joined = own.join(first, "base", "left").withColumn("p", F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), F.slice("own", F.col("h") + 1, F.size("own"))))
    return joined.select("conv_id", F.unhex(F.array_join(F.transform("p", lambda x: x.key), "")).alias("path"), F.transform("p", lambda x: x.words).alias("words"))


@dataclass
class Item:
    """What is known of a node at `depth`: members n, the smallest one, closed children and what lies below them.

    path and words are of one member. ends: the members that end here; waiting: rows of closed children.
    """

    depth: int
    n: int
    low: int | None
    path: bytes
    words: list[int]
    kids: int = 0
    leaves: int = 0
    saved: int = 0
    side: int = 0
    ends: list[int] = default(default_factory=list)
    waiting: list[list] = default(default_factory=list)

    def add(self, other: Item) -> None:
        self.n, self.kids, self.leaves, self.saved = self.n + other.n, self.kids + other.kids, self.leaves + other.leaves, self.saved + other.saved
        self.low = other.low if self.low is None else self.low if other.low is None else min(self.low, other.low)
        self.ends += other.ends
        self.waiting += other.waiting

    def key(self) -> bytes:
        return hashlib.md5(self.path[: KEY * self.depth]).digest()


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two paths share from their start: the longest common prefix, found by bisection."""
    low, high = 0, min(len(a), len(b)) // KEY
    if a[: KEY * high] == b[: KEY * high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[KEY * low : KEY * middle] == b[KEY * low : KEY * middle]:
            low = middle
        else:
            high = middle
    return low


class Merge:
    """One step over neighbouring items: emits the rows of closed nodes and of ends, leaves a contracted list.

    rows says whether the items are conversations themselves; only then are the ends of a closed node all known.
    """

    def __init__(self, at: int, rows: bool) -> None:
        self.at, self.rows, self.nodes, self.pieces = at, rows, [], []

    def close(self, x: Item, above: int) -> Item:
        """Emits the nodes of x at the depths above+1 to x.depth; x as a closed child of a node at depth `above`."""
        leaves, saved = x.leaves if x.kids else 1, x.saved
        ends = (hashlib.sha256(",".join(map(str, x.ends)).encode()).hexdigest() if x.ends else NO_ENDS) if self.rows else None
        row, n, low = None, x.n, x.low
        for depth in range(x.depth, above, -1):
            top = depth == x.depth
            if depth:
                saved += (n - 1) * x.words[depth - 1]
            row = [low, depth, low, n, x.kids if top else 1, leaves, saved, ends if top else NO_ENDS, x.key() if top and not self.rows else None, None]
            self.nodes.append(row)
        for child in x.waiting:
            child[2] = low
        return Item(above, n, low, x.path, x.words, 1, leaves, saved, waiting=[row])

    def keep(self, x: Item, side: int) -> Item:
        """x as an item of the list; its closed children and its ends learn their node by its key."""
        if x.waiting or x.ends:
            key = x.key()
            for child in x.waiting:
                child[2], child[9] = None, key
            if x.ends:
                self.pieces.append((key, ",".join(map(str, x.ends))))
        x.side, x.ends, x.waiting = side, [], []
        return x

    def run(self, items: list[Item], shared: list[int], closed: bool = False) -> list[Item]:
        """items side by side, with the depth that each shares with the next one. closed: nothing stands beside them."""
        last = len(items) - 1
        parent, right = list(range(last + 1)), list(range(last + 1))  # the root of a component is its first item
        left_list, right_list = [], []

        def find(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for edge in sorted(range(last), key=lambda i: -shared[i]):
            depth, a, b = shared[edge], find(edge), edge + 1
            node = None
            for i in (a, b):
                x = items[i]
                if x.depth > depth:
                    if not closed and i == 0:
                        left_list.append(self.keep(x, 0))
                        x = Item(depth, 0, None, x.path, x.words)
                    elif not closed and right[i] == last:
                        right_list.append(self.keep(x, 1))
                        x = Item(depth, 0, None, x.path, x.words)
                    else:
                        x = self.close(x, depth)
                if node is None:
                    node = x
                else:
                    node.add(x)
            parent[b], right[a], items[a] = a, right[b], node
        top = items[0]
        if closed:
            self.close(top, -1)
            self.nodes[-1][2] = None  # the root, made last, has no parent
            return []
        return [*left_list, self.keep(top, 0), *reversed(right_list)]


def joined_depths(lists: list[list[Item]], borders: list[int]) -> list[int]:
    """The depths that neighbouring items of contracted lists share, in a list and at the borders between lists."""
    out = []
    for i, items in enumerate(lists):
        out += [min(a.depth, b.depth) for a, b in zip(items, items[1:], strict=False)]
        out += borders[i : i + 1]
    return out


@dataclass
class Contracted:
    first: tuple[bytes, list[int]]
    last: tuple[bytes, list[int]]
    items: list[Item]


def merge_lists(step: Merge, lists: list[Contracted], closed: bool = False) -> Contracted:
    borders = [common_turns(a.last[0], b.first[0]) for a, b in zip(lists, lists[1:], strict=False)]
    depths = joined_depths([x.items for x in lists], borders)
    items = step.run([i for x in lists for i in x.items], depths, closed)
    return Contracted(lists[0].first, lists[-1].last, items)


def batch(step: Merge, rest: Contracted | None = None) -> pa.RecordBatch:
    """The rows that a step made, and its contracted list if it goes on from here."""
    size = len(step.nodes) + len(step.pieces) + (rest is not None)
    columns = {c: [None] * size for c in _TYPES}
    columns["at"] = [step.at] * size
    columns["kind"] = ["node"] * len(step.nodes) + ["ends"] * len(step.pieces) + ["list"] * (rest is not None)
    for c, values in zip(_NODES, zip(*step.nodes, strict=True), strict=False):
        columns[c][: len(values)] = values
    for i, (key, ids) in enumerate(step.pieces, len(step.nodes)):
        columns["node_key"][i], columns["ids"][i] = key, ids
    if rest is not None:
        columns["first"][-1], columns["first_words"][-1] = rest.first
        columns["last"][-1], columns["last_words"][-1] = rest.last
        columns["items"][-1] = [{"side": x.side, "depth": x.depth, "n": x.n, "low": x.low, "kids": x.kids, "leaves": x.leaves, "saved": x.saved} for x in rest.items]
    return pa.RecordBatch.from_arrays([pa.array(columns[c], kind) for c, kind in _TYPES.items()], names=list(_TYPES))


def blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[tuple[int, bytes, list[int]]]]:
    rows, size = [], 0
    for part in batches:
        for row in zip(*(part.column(c).to_pylist() for c in ("conv_id", "path", "words")), strict=True):
            rows.append(row)
            size += len(row[1])
            if len(rows) >= most or size >= BLOCK_BYTES:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def trie_of_partition(block_rows: int, most_lists: int):
    """Blocks of a partition's sorted rows, and merges of their lists, down to one list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << _SEQ
        lists: list[Contracted] = []
        for rows in blocks(batches, block_rows):
            step = Merge(at, rows=True)
            items = [Item(len(words), 1, conv, path, words, ends=[conv]) for conv, path, words in rows]
            shared = [common_turns(a[1], b[1]) for a, b in zip(rows, rows[1:], strict=False)]
            lists.append(Contracted(rows[0][1:], rows[-1][1:], step.run(items, shared)))
            yield batch(step)
            at += 1
            if len(lists) == most_lists:
                step = Merge(at, rows=False)
                lists = [merge_lists(step, lists)]
                yield batch(step)
                at += 1
        if lists:
            step = Merge(at, rows=False)
            yield batch(step, merge_lists(step, lists))

    return run


def merge_partitions(level: int, most_lists: int, closed: bool):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["pid"])
        lists = []
        for r in rows:
            ends = (r["first"], r["first_words"]), (r["last"], r["last_words"])
            lists.append(Contracted(*ends, [Item(x["depth"], x["n"], x["low"], *ends[x["side"]], x["kids"], x["leaves"], x["saved"]) for x in r["items"]]))
        step = Merge((level << _LEVEL) + ((rows[0]["pid"] // most_lists) << _SEQ), rows=False)
        rest = merge_lists(step, lists, closed)
        return pa.Table.from_batches([batch(step, None if closed else rest)])

    return run


def ends_of(pieces: DataFrame) -> DataFrame:
    """node_key, sha of the ids of all its pieces in order: one task streams the pieces of a node, whatever their number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, digest = None, None
        for part in batches:
            done = []
            for k, ids in zip(part["node_key"], part["ids"], strict=True):
                if k == key:
                    digest.update(b"," + ids.encode())
                else:
                    if key is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256(ids.encode())
            yield pd.DataFrame(done, columns=["node_key", "sha"])
        if key is not None:
            yield pd.DataFrame([(key, digest.hexdigest())], columns=["node_key", "sha"])

    ordered = pieces.select("node_key", "at", "ids").repartition("node_key").sortWithinPartitions("node_key", "at")
    return ordered.mapInPandas(run, "node_key binary, sha string")


def prefix_trie(paths: DataFrame, block_rows: int = BLOCK_ROWS, lists: int = LISTS) -> DataFrame:
    """One row per distinct prefix of the paths, from the root on.

    paths: conv_id, path (KEY bytes per turn), words (per turn); rows of one path are members of the same nodes. Returns
    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves (childless nodes
    in the subtree), saved_tokens (over the subtree, each node's (n_convs - 1) times the words of its last turn) and
    ends_sha256 (of the comma-joined ids, ascending, of members that end there). No paths give no rows.

    The sort by path and conv_id deals even equal paths over many partitions. A partition is read as a stream of blocks;
    memory is bounded by block_rows, BLOCK_BYTES, the longest path and, per merge, `lists` lists of at most two items per
    turn of their border paths. Lists of all partitions meet in rounds of `lists`. Steps are written to the shared folder
    (spark.checkpoint.dir), so that a lost executor repeats single tasks only.
    """
    ordered = cut(paths).orderBy("path", "conv_id")
    made = [cut(ordered.mapInArrow(trie_of_partition(block_rows, lists), _OUT))]
    number: Column = F.shiftright("at", _SEQ)
    open_lists = made[0].where("kind = 'list'").withColumn("pid", number)
    top = open_lists.agg(F.max("pid")).first()[0]
    level = 0
    while top is not None:
        level += 1
        closed = top < lists
        merged = open_lists.groupBy(F.floor(F.col("pid") / lists).alias("g")).applyInArrow(merge_partitions(level, lists, closed), _OUT)
        made.append(cut(merged))
        open_lists = made[-1].where("kind = 'list'").withColumn("pid", F.shiftright(F.col("at").bitwiseAND((1 << _LEVEL) - 1), _SEQ))
        top = None if closed else top // lists
    rows = made[0]
    for more in made[1:]:
        rows = rows.unionByName(more)
    nodes = rows.where("kind = 'node'").select("at", *_NODES)
    shas = ends_of(rows.where("kind = 'ends'"))
    ended = nodes.where("node_key IS NOT NULL").join(shas, "node_key", "left").withColumn("ends_sha256", F.coalesce("sha", F.lit(NO_ENDS))).drop("sha")
    nodes = nodes.where("node_key IS NULL").unionByName(ended)
    # Children of a node that crossed a border know it by its key. Keys are looked up once per step, so that the many
    # children of the root do not meet in one task.
    parents = rows.where("kind = 'node' AND node_key IS NOT NULL").select(F.col("node_key").alias("parent_key"), F.col("conv_id").alias("found"))
    asked = rows.where("kind = 'node' AND parent_key IS NOT NULL").select("at", "parent_key").distinct().join(parents, "parent_key")
    late = nodes.where("parent_key IS NOT NULL").join(asked, ["at", "parent_key"], "left").withColumn("parent_conv_id", F.col("found")).drop("found")
    return nodes.where("parent_key IS NULL").unionByName(late).select(_NODES[:8])


def conversation_trie(conversations: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """prefix_trie of the rebuilt conversations (conv_id, turn, role, text); see rebuild for nulls, ties and repeated
    rows. Texts of any length enter by key and number of words. An empty table gives no rows; other columns are
    ignored."""
    return prefix_trie(rebuild(conversations, group, heads))
