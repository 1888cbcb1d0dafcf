"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

The columns (n-grams, by hash) are cut into blocks. Two documents whose set similarity reaches the
threshold differ in at most k n-grams, k following from their sizes, so of k + 2 blocks two at least
are equal in both. The block product therefore only has to meet equal blocks: it is an equi-join on
the hash of a block's content, and documents that share none are below the bound and never become a
pair. What meets is completed to the exact overlap count from the whole sets.

Copies are one row of the matrix (a class of equal sets). The documents that share a block form a
list. No list is expanded into all pairs: its best connected member is compared with the others, the
components that this proves are merged, and only members of lists that still span several components
go on. Those of them that have too many n-grams of their own to reach the threshold with any other
document are dropped from the search by an exact bound. What is left goes through a product of blocks
of rows, which accumulates all overlap counts of two blocks in a task and returns only links that
merge components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartmetrics.llm.common import chunks, cut, extend, mix, semi_by_id, word_hashes


#: Documents in a block of rows of the last product.
ROWS = 512


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Distinct hashed n-grams of each text, sorted; the whole text as one n-gram if it is shorter."""
    hashes, counts = word_hashes(texts, lower=True)
    if words > 1 and len(hashes):
        grams = hashes
        for i in range(1, words):
            grams = extend(grams[:-1], hashes[i:]) if len(grams) > 1 else grams[:0]
    else:
        grams = hashes
    sets, at = [], 0
    for n in counts.tolist():
        if n >= words:
            sets.append(np.unique(grams[at : at + n - words + 1]))
        elif n:
            short = mix(hashes[at : at + 1] + np.uint64(n))
            for h in hashes[at + 1 : at + n]:
                short = extend(short, h[None])
            sets.append(short)
        else:
            sets.append(np.empty(0, np.uint64))
        at += n
    return sets


def band_tops(percent: int, largest: int) -> np.ndarray:
    """Largest sizes of consecutive bands; sizes that can link are in one band or in two that touch."""
    tops, start = [], 1
    while start <= largest or len(tops) < 2:
        after = 100 * start // percent + 1
        tops.append(after - 1)
        start = after
    tops.append(100 * start // percent)
    return np.array(tops, dtype=np.int64)


def block_signatures(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the blocks of each set, and their number by set. Every set is cut in two ways: as its
    own band and as the next one require, so that two sets of neighbouring bands are cut alike once."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    values, owner = np.concatenate([*sets, np.empty(0, np.uint64)]), np.repeat(np.arange(len(sets)), sizes)
    tops = band_tops(percent, int(sizes.max(initial=1)))
    band = np.searchsorted(tops, sizes)
    owners, found = [], []
    for shift in (0, 1):
        scheme = band + shift
        differ = 2 * tops[scheme] * (100 - percent) // (100 + percent)
        blocks = np.where((differ > 0) & (sizes > 0), differ + 2, 0)  # no difference allowed: only copies link
        base = np.concatenate([[0], np.cumsum(blocks)])
        seed = mix(scheme.astype(np.uint64) + np.uint64(1))
        use = blocks[owner] > 0
        v, o = values[use], owner[use]
        slot = base[o] + (mix(v ^ seed[o]) % blocks[o].astype(np.uint64)).astype(np.int64)
        content = mix(v + seed[o])
        low = np.bincount(slot, (content & np.uint64(0xFFFFFFFF)).astype(np.float64), base[-1]).astype(np.uint64)
        high = np.bincount(slot, (content >> np.uint64(32)).astype(np.float64), base[-1]).astype(np.uint64)
        count = np.bincount(slot, minlength=base[-1])
        of = np.repeat(np.arange(len(sets)), blocks)
        index = (np.arange(base[-1]) - base[of]).astype(np.uint64)
        full = count > 0
        found.append(mix((low + (high << np.uint64(32))) ^ mix(seed[of] + index))[full])
        owners.append(of[full])
        # Two blocks at least are equal. If those are empty in both sets, a pair of empty blocks meets.
        empty = np.flatnonzero(~full)
        for d in np.flatnonzero(np.bincount(of[empty], minlength=len(sets)) > 1) if len(empty) else []:
            at = index[empty[of[empty] == d]]
            i, j = np.triu_indices(len(at), 1)
            found.append(mix(mix(seed[d : d + 1] ^ np.uint64(0x5E7)) + at[i] * np.uint64(1 << 32) + at[j]))
            owners.append(np.full(len(i), d))
    order = np.argsort(np.concatenate(owners), kind="stable")
    return np.concatenate(found)[order], np.bincount(np.concatenate(owners), minlength=len(sets))


def _list_column(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _sets_function(words: int, percent: int, what: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            sets = shingle_sets(part.column("text").to_pylist(), words)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            columns = {"doc_id": part.column("doc_id").combine_chunks(), "n": pa.array(sizes)}
            if what == "grams":
                columns["grams"] = _list_column(np.concatenate([*sets, np.empty(0, np.uint64)]), sizes)
            else:
                sums = [(s.sum(dtype=np.uint64), mix(s).sum(dtype=np.uint64)) for s in sets]
                for i, name in enumerate(("k1", "k2")):
                    columns[name] = pa.array(np.array([x[i] for x in sums], dtype=np.uint64).view(np.int64))
                if what == "blocks":
                    columns["blocks"] = _list_column(*block_signatures(sets, percent))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def components(edges: DataFrame) -> DataFrame:
    """(v, label) for every end of an edge (a, b): the smallest id in its component.

    Labels move along edges and jump to the label of the label, so the number of rounds follows the
    logarithm of a component's diameter. Every round is cut."""
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct().toDF("a", "b"))
    labels = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("label")))
    while True:
        near = both.join(labels.select(F.col("v").alias("b"), "label"), "b").groupBy(F.col("a").alias("v")).agg(F.min("label").alias("near"))
        moved = labels.join(near, "v").select("v", F.least("label", "near").alias("new"), "label")
        root = labels.select(F.col("v").alias("new"), F.col("label").alias("root"))
        after = cut(moved.join(root, "new", "left").select("v", F.least("new", F.coalesce("root", "new")).alias("label"), F.col("label").alias("old")))
        labels = after.select("v", "label")
        if after.where("label <> old").isEmpty():
            return labels


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose exact overlap count reaches the threshold."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("grams").alias("ga"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("grams").alias("gb"))
    met = pairs.join(left, "a").join(right, "b").where((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))
    overlap = met.select("a", "b", (F.col("na") + F.col("nb")).alias("both"), F.size(F.array_intersect("ga", "gb")).alias("common"))
    return overlap.where(100 * F.col("common") >= percent * (F.col("both") - F.col("common"))).select("a", "b").distinct()


def _open_lists(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of lists that span several components, with their component and the list's largest one."""
    at = shared.join(labels.select(F.col("v").alias("rep"), "label"), "rep", "left").withColumn("comp", F.coalesce("label", "rep")).drop("label")
    by = at.groupBy("block", "comp").agg(F.count("*").alias("c")).groupBy("block").agg(F.count("*").alias("k"), F.max_by("comp", F.struct("c", "comp")).alias("main"))
    return cut(at.join(by.where("k > 1").select("block", "main"), "block"))


def _star(members: DataFrame, candidates: DataFrame) -> DataFrame:
    """Each list's best connected candidate with the list's members of other components."""
    hub = candidates.groupBy("block").agg(F.max_by(F.struct("rep", "comp"), F.struct("degree", -F.col("rep"))).alias("hub"))
    met = members.join(hub, "block").where(F.col("comp") != F.col("hub.comp"))
    return met.select(F.least("rep", "hub.rep").alias("a"), F.greatest("rep", "hub.rep").alias("b")).distinct()


def _alive(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Members that can still reach the threshold: enough of their n-grams occur in another member."""
    reps = members.select(F.col("rep").alias("doc_id")).distinct()
    grams = sets.join(reps, "doc_id").select("doc_id", "n", F.explode("grams").alias("gram"))
    common = grams.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram")
    kept = grams.join(common, "gram").groupBy("doc_id").agg(F.count("*").alias("c"), F.min("n").alias("n")).where(100 * F.col("c") >= percent * F.col("n"))
    return members.join(kept.select(F.col("doc_id").alias("rep")), "rep")


def block_links(a_ids: np.ndarray, a_comp: np.ndarray, a_sets: list[np.ndarray], b_ids: np.ndarray, b_comp: np.ndarray, b_sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """The product of two blocks of rows: links between documents of different components, as far as
    they merge components."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sizes = np.array([len(s) for s in b_sets])
    grams = np.concatenate(b_sets)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], np.repeat(np.arange(len(b_sets)), sizes)[order]
    links = []
    for x, comp, s in zip(a_ids.tolist(), a_comp.tolist(), a_sets, strict=True):
        start, end = np.searchsorted(grams, s, "left"), np.searchsorted(grams, s, "right")
        held = end - start
        at = np.repeat(start - np.concatenate([[0], np.cumsum(held)[:-1]]), held) + np.arange(held.sum())
        common = np.bincount(owner[at], minlength=len(b_sets))
        for j in np.flatnonzero((100 * common >= percent * (sizes + len(s) - common)) & (b_comp != comp)).tolist():
            one, two = find(comp), find(int(b_comp[j]))
            if one != two:
                parent[one] = two
                links.append((x, int(b_ids[j])))
    return links


def _product_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that are still needed, from products of blocks of ROWS documents.

    Members that lists hold together form a group; every block of a group's documents outside of its
    largest component meets every block of the group. A task reads two blocks, however large the group."""
    members = cut(members)
    star = members.join(members.groupBy("block").agg(F.min("rep").alias("hub")), "block").select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    groups = components(star).withColumnRenamed("label", "g")
    docs = members.select("rep", "comp").distinct().join(groups.withColumnRenamed("v", "rep"), "rep")
    by = docs.groupBy("g", "comp").agg(F.count("*").alias("c"))
    sizes = by.groupBy("g").agg(F.sum("c").alias("all"), F.max("c").alias("most"), F.max_by("comp", F.struct("c", "comp")).alias("main"))
    blocks = lambda n: F.ceil(n / F.lit(ROWS)).cast("long")
    sizes = sizes.where("all > most").select("g", "main", blocks(F.col("all")).alias("nb"), blocks(F.col("all") - F.col("most")).alias("na"))
    held = cut(docs.join(sizes, "g").join(sets.select(F.col("doc_id").alias("rep"), "grams"), "rep"))
    own, every = (lambda n: F.pmod(F.xxhash64("rep"), F.col(n))), (lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)))
    left = held.where("comp <> main").select("g", own("na").alias("i"), every("nb").alias("j"), "rep", "comp", "grams")
    right = held.select("g", every("na").alias("i"), own("nb").alias("j"), "rep", "comp", "grams")

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        sides = [(x["rep"].to_numpy(), x["comp"].to_numpy(), [np.asarray(g, np.int64) for g in x["grams"]]) for x in (a, b)]
        return pd.DataFrame(block_links(*sides[0], *sides[1], percent), columns=["a", "b"], dtype="int64")

    return left.groupBy("g", "i", "j").cogroup(right.groupBy("g", "i", "j")).applyInPandas(run, "a long, b long")


def ngram_jaccard_components(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id and n_copies for each row of docs (doc_id, text).

    Words are runs of anything but ASCII white space, A-Z lower-cased; a set holds the distinct n-grams
    of `words` words (fewer words: the whole sequence). Two documents link when the intersection is at
    least `percent` / 100 of the union. component_id is the smallest doc_id that links reach. N-grams
    are compared by 64-bit hashes, whole sets by 128 bits.

    Links inside a component are proved only as far as the component needs them.

    Null or blank texts: an empty set, linked with nothing. Rows with the same doc_id are one document
    with several texts. Rows without doc_id link with nothing; component_id is the smallest doc_id with
    the same set, or null. Repeated rows are returned repeatedly. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    key = "doc_id long, n long, k1 long, k2 long"
    rows = docs.mapInArrow(_sets_function(words, percent, "keys"), key)
    classes = cut(rows.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")))
    blocks = docs.where("doc_id IS NOT NULL").mapInArrow(_sets_function(words, percent, "blocks"), f"{key}, blocks array<long>")
    reps = blocks.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("blocks").alias("blocks"))
    cells = reps.select("rep", F.explode("blocks").alias("block"))
    lists = cells.groupBy("block").agg(F.count("*").alias("m")).where("m > 1")
    shared = cut(cells.join(lists, "block"))
    degree = shared.groupBy("rep").agg(F.sum("m").alias("degree"))
    shared = cut(shared.drop("m").join(degree, "rep"))

    # Texts of one doc_id belong together, whatever they say.
    ids = rows.where("n > 0 AND doc_id IS NOT NULL").join(classes.select("k1", "k2", "rep"), ["k1", "k2"]).where("doc_id <> rep").select("doc_id", "rep")
    own = classes.where("rep IS NOT NULL").select(F.col("rep").alias("doc_id"), "rep")
    split = ids.union(own).groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b").select("a", "b")
    edges = cut(split)

    if not shared.isEmpty():
        sets = cut(semi_by_id(docs, shared.select(F.col("rep").alias("doc_id")).distinct(), "doc_id").mapInArrow(_sets_function(words, percent, "grams"), "doc_id long, n long, grams array<long>"))
        everyone = shared.withColumn("comp", F.col("rep"))
        edges = cut(edges.union(_linked(_star(everyone, everyone), sets, percent)))
        labels = components(edges)
        open_ = _open_lists(shared, labels)
        if not open_.isEmpty():
            last = cut(_product_links(_alive(open_, sets, percent), sets, percent))
            if not last.isEmpty():
                labels = components(edges.union(last))
    else:
        labels = components(edges)
    named = classes.join(labels.select(F.col("v").alias("rep"), "label"), "rep", "left").select("k1", "k2", F.coalesce("label", "rep").alias("component"), "copies")
    out = rows.join(named.withColumnRenamed("k1", "c1").withColumnRenamed("k2", "c2"), (F.col("n") > 0) & (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"), F.coalesce("copies", F.lit(1)).alias("n_copies"))


def block_counts(a_ids: np.ndarray, a_sets: list[np.ndarray], b_ids: np.ndarray, b_copies: np.ndarray, b_sets: list[np.ndarray], percent: int) -> np.ndarray:
    """The product of two blocks of rows: for each row of a, the documents of b that it links to."""
    sizes = np.array([len(s) for s in b_sets])
    grams = np.concatenate(b_sets)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], np.repeat(np.arange(len(b_sets)), sizes)[order]
    links = np.zeros(len(a_ids), np.int64)
    for row, (x, s) in enumerate(zip(a_ids.tolist(), a_sets, strict=True)):
        start, end = np.searchsorted(grams, s, "left"), np.searchsorted(grams, s, "right")
        held = end - start
        at = np.repeat(start - np.concatenate([[0], np.cumsum(held)[:-1]]), held) + np.arange(held.sum())
        common = np.bincount(owner[at], minlength=len(b_sets))
        links[row] = b_copies[(100 * common >= percent * (sizes + len(s) - common)) & (b_ids != x)].sum()
    return links


def ngram_jaccard_link_counts(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """doc_id and n_links for each row of docs (doc_id, text): the rows with another set of n-grams that it
    links to, as ngram_jaccard_components defines links. Copies count each.

    All links are counted, those inside a component too. Documents that lists hold together form a group,
    of which every block of ROWS sets meets every other, so the work is quadratic in a group, the rows
    are not. Null or blank texts and rows without doc_id: no links. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            sets = shingle_sets(part.column("text").to_pylist(), words)
            grams = _list_column(np.concatenate([*sets, np.empty(0, np.uint64)]), np.array([len(s) for s in sets], dtype=np.int64))
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id").combine_chunks(), "grams": grams, "blocks": _list_column(*block_signatures(sets, percent))})

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = cut(docs.mapInArrow(run, "doc_id long, grams array<long>, blocks array<long>").withColumn("v", F.xxhash64("grams")))
    classes = rows.where("size(grams) > 0 AND doc_id IS NOT NULL").groupBy("v").agg(F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("grams", "blocks")])
    cells = classes.select("v", F.explode("blocks").alias("block"))
    hubs = cells.groupBy("block").agg(F.min("v").alias("hub"))
    groups = components(cells.join(hubs, "block").select(F.col("v").alias("a"), F.col("hub").alias("b")).distinct())
    sizes = groups.groupBy(F.col("label").alias("g")).agg(F.ceil(F.count("*") / F.lit(ROWS)).cast("long").alias("nb"))
    held = cut(classes.drop("blocks").join(groups.withColumnRenamed("label", "g"), "v").join(sizes, "g"))
    own, every = F.pmod(F.xxhash64("v"), F.col("nb")), F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1))
    left, right = held.select("g", own.alias("i"), every.alias("j"), "v", "grams"), held.select("g", every.alias("i"), own.alias("j"), "v", "copies", "grams")

    def count(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"v": [], "n_links": []}, dtype="int64")
        a_sets, b_sets = ([np.asarray(g, np.int64) for g in x["grams"]] for x in (a, b))
        return pd.DataFrame({"v": a["v"], "n_links": block_counts(a["v"].to_numpy(), a_sets, b["v"].to_numpy(), b["copies"].to_numpy(), b_sets, percent)})

    parts = left.groupBy("g", "i", "j").cogroup(right.groupBy("g", "i", "j")).applyInPandas(count, "v long, n_links long")
    links = parts.groupBy("v").agg(F.sum("n_links").alias("n_links"))
    known = F.when(F.col("doc_id").isNotNull(), F.col("n_links"))
    return rows.select("doc_id", "v").join(links, "v", "left").select("doc_id", F.coalesce(known, F.lit(0)).alias("n_links"))
