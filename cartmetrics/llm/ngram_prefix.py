"""N-gram Jaccard join for low thresholds and long n-grams: the product over prefix columns.

Two documents that reach the threshold share at least `percent` % of the n-grams of the larger one. Of the n-grams in
any fixed order, the product therefore only has to run over the first n - ceil(percent * n / 100) + k columns of a
document with n of them: documents that meet in fewer than k of these columns are below the bound. k grows with n, so
that a document which only shares a passage or common phrases with others is dropped by counting its columns. The order
is that of hashes, with n-grams that a bounded sample found to be frequent (shared passages) last; the sample only
saves work.

Copies are one row of the matrix (a class of equal sets). The documents that meet in a column form a
list. No list is expanded into all pairs: its best connected member is compared with the others, the
components that this proves are merged, and only members of lists that still span several components
go on. Before the exact overlap of a pair is counted, its sizes and a parity bitmap of the two sets have to allow it.
Members that meet documents of other components in fewer than k columns are dropped from the search, and of each
member the k - 1 columns with the longest lists. Lists with few members outside of their largest component then give
their pairs across components, which are checked like those of the first round. Members of the others go through a
product of blocks of rows, which accumulates all overlap counts of two blocks in a task and returns only links that
merge components. Answers are those of ngram_join; with short n-grams, which meet by chance, that one moves less.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartmetrics.llm.common import BROADCAST_IDS, chunks, cut, mix, semi_by_id
from cartmetrics.llm.ngram_join import _list_column, _open_lists, block_links, components, shingle_sets

#: N-grams in a block of rows of the last product, and 64-bit words of a parity bitmap.
BLOCK_GRAMS, WORDS = 1_000_000, 16
#: Members outside of a list's largest component up to which its pairs are listed; longer lists go to the product.
OUTSIDERS = 64
#: Characters that a Python worker takes at once.
CHARS = 1_500_000
#: Frequent n-grams: documents of the sample (about), rows of it that hold one at least, the most that are kept.
SAMPLE_DOCS, SAMPLE_HITS, MOST_FREQUENT = 4000, 3, 100_000


def least_columns(n, percent: int):
    """k: half of what a set of n n-grams may lose, at least one. For numbers, arrays and integer columns."""
    half = (100 - percent) * n
    if isinstance(n, Column):
        return F.greatest(F.lit(1), F.floor(half / 200)).cast("long")
    return np.maximum(1, half // 200)


def prefix_columns(sets: list[np.ndarray], percent: int, frequent: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The first columns of each set, of which two sets that link share least_columns of the smaller one, and their number
    by set. frequent: sorted n-grams that come last."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    counts = np.where(sizes > 0, sizes + percent * sizes // -100 + least_columns(sizes, percent), 0)
    values, owner = np.concatenate([*sets, np.empty(0, np.uint64)]), np.repeat(np.arange(len(sets)), sizes)
    if frequent is not None and len(frequent):
        at = np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)
        values = values[np.argsort(2 * owner + (frequent[at] == values), kind="stable")]
    rank = np.arange(len(values)) - (np.cumsum(sizes) - sizes)[owner]
    return values[rank < counts[owner]], counts


def parity_words(sets: list[np.ndarray]) -> np.ndarray:
    """For each set WORDS words of 64 bits; a bit tells whether an odd number of n-grams falls on it. The bits in which
    two sets differ are at most as many as the n-grams that only one of them has."""
    out = np.zeros((len(sets), 64 * WORDS), np.uint8)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    bits = (mix(np.concatenate([*sets, np.empty(0, np.uint64)])) % np.uint64(64 * WORDS)).astype(np.int64)
    np.add.at(out, (owner, bits), 1)  # wraps at 256, which keeps parity
    return np.packbits(out & 1, axis=1, bitorder="little").view(np.int64)


def _sets_function(words: int, percent: int, what: str, frequent: np.ndarray | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per row: the columns beside the text, n, and grams, parity, the two keys of the set, or these and its blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, chars=CHARS):
            sets = shingle_sets(part.column("text").to_pylist(), words)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            columns = {c: part.column(c).combine_chunks() for c in part.column_names if c != "text"} | {"n": pa.array(sizes)}
            if what == "grams":
                columns["grams"] = _list_column(np.concatenate([*sets, np.empty(0, np.uint64)]), sizes)
            elif what == "parity":
                columns["parity"] = _list_column(parity_words(sets).ravel(), np.full(len(sets), WORDS))
            else:
                sums = [(s.sum(dtype=np.uint64), mix(s).sum(dtype=np.uint64)) for s in sets]
                for i, name in enumerate(("k1", "k2")):
                    columns[name] = pa.array(np.array([x[i] for x in sums], dtype=np.uint64).view(np.int64))
                if what == "blocks":
                    columns["blocks"] = _list_column(*prefix_columns(sets, percent, frequent))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def frequent_grams(docs: DataFrame, reps: DataFrame, words: int) -> np.ndarray:
    """Sorted n-grams that several documents of a sample of about SAMPLE_DOCS hold, MOST_FREQUENT at most."""
    every = max(1, reps.count() // SAMPLE_DOCS)
    chosen = reps.where(F.pmod(F.xxhash64(F.lit(77), "rep"), F.lit(every)) == 0).select(F.col("rep").alias("doc_id")).distinct()
    texts = semi_by_id(docs, chosen, "doc_id").groupBy("doc_id").agg(F.first("text").alias("text")).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, chars=CHARS):
            grams, held = np.unique(np.concatenate([*shingle_sets(part.column("text").to_pylist(), words), np.empty(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(held.astype(np.int64))], names=["gram", "c"])

    counts = texts.mapInArrow(run, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c")).where(F.col("c") >= SAMPLE_HITS)
    found = counts.orderBy(F.desc("c"), "gram").limit(MOST_FREQUENT).collect()
    return np.sort(np.array([r["gram"] for r in found], dtype=np.int64).view(np.uint64))


def _possible(pairs: DataFrame, slim: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and parity bitmaps allow the threshold; only these few numbers are moved."""
    left = slim.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("parity").alias("pa"))
    right = slim.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("parity").alias("pb"))
    met = pairs.join(left, "a").join(right, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    differ = F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    return met.where((100 + percent) * differ <= (100 - percent) * (F.col("na") + F.col("nb"))).select("a", "b").distinct()


def _linked(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (member a, hub b) whose exact overlap count reaches the threshold. Sets are made where the texts are, and
    move once, to their hub."""
    few = pairs.count() <= BROADCAST_IDS
    of = pairs.withColumnRenamed("a", "doc_id")
    sets = _sets_function(words, percent, "grams")
    members = docs.join(F.broadcast(of) if few else of, "doc_id").select(F.col("doc_id").alias("a"), "b", "text").mapInArrow(sets, "a long, b long, n long, grams array<long>")
    hubs = semi_by_id(docs, pairs.select(F.col("b").alias("doc_id")).distinct(), "doc_id").mapInArrow(sets, "doc_id long, n long, grams array<long>")
    hubs = hubs.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("grams").alias("gb"))
    overlap = members.join(hubs, "b").select("a", "b", (F.col("n") + F.col("nb")).alias("both"), F.size(F.array_intersect("grams", "gb")).alias("common"))
    return overlap.where(100 * F.col("common") >= percent * (F.col("both") - F.col("common"))).select("a", "b").distinct()


def _star(members: DataFrame, candidates: DataFrame) -> DataFrame:
    """Each list's best connected candidate (b) with the list's members of other components (a)."""
    hub = candidates.groupBy("block").agg(F.max_by(F.struct("rep", "comp"), F.struct("degree", -F.col("rep"))).alias("hub"))
    met = members.join(hub, "block").where(F.col("comp") != F.col("hub.comp"))
    return met.select(F.col("rep").alias("a"), F.col("hub.rep").alias("b")).distinct()


def _meeting(members: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Members (rep, block) with as many blocks as a link to the smallest set that they can link to needs. sizes: rep, n."""
    smallest = F.ceil(percent * F.col("n") / 100)
    found = members.groupBy("rep").agg(F.count("*").alias("met")).join(sizes, "rep").where(F.col("met") >= least_columns(smallest, percent))
    return members.join(found.select("rep").distinct(), "rep", "left_semi")


def _first_lists(members: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Members (rep, block, comp, lo, hi: the sizes of the document's sets) without the blocks that a document can spare,
    of lists that still span several components, with the list's largest one (main) and its members of others (outside).

    Sets that link share least_columns blocks. In an order of blocks that holds for all documents, here by the length of
    their lists, the first shared block comes before the others in both documents. So each document can leave out its
    last blocks, one fewer than a link to the smallest set that it can link to needs. sizes: rep, n."""
    range_ = sizes.groupBy("rep").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    lengths = members.groupBy("block").agg(F.count("*").alias("m"))
    spare = least_columns(F.ceil(percent * F.col("lo") / 100), percent) - 1
    last = F.row_number().over(W.partitionBy("rep").orderBy(F.desc("m"), F.desc("block")))
    rows = members.select("rep", "block", "comp").join(lengths, "block").join(range_, "rep").withColumn("last", last)
    first = cut(rows.where(F.col("last") > spare).select("rep", "block", "comp", "lo", "hi"))
    by = first.groupBy("block", "comp").agg(F.count("*").alias("c"))
    lists = by.groupBy("block").agg((F.sum("c") - F.max("c")).alias("outside"), F.max_by("comp", F.struct("c", "comp")).alias("main"))
    return cut(first.join(lists.where("outside > 0"), "block"))


def _cross_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of each list's members in different components whose sizes allow a link. A list gives as many rows as
    it has members, times those outside of its largest component, at most."""
    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("comp", "lo", "hi")]
    left = members.where("comp <> main").select("block", F.col("rep").alias("a"), *side("a"))
    right = members.select("block", "main", F.col("rep").alias("b"), *side("b"))
    met = left.join(right, "block").where("comp_a <> comp_b AND (comp_b = main OR a < b)")
    return met.where(f"100 * hi_a >= {percent} * lo_b AND 100 * hi_b >= {percent} * lo_a").select("a", "b").distinct()


def _product_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that are still needed, from products of blocks of documents with about BLOCK_GRAMS n-grams.

    Members that lists hold together form a group; every block of a group's documents outside of its
    largest component meets every block of the group. A task reads two blocks, however large the group."""
    members = cut(members)
    star = members.join(members.groupBy("block").agg(F.min("rep").alias("hub")), "block").select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    groups = components(star).withColumnRenamed("label", "g")
    docs = members.select("rep", "comp").distinct().join(groups.withColumnRenamed("v", "rep"), "rep")
    by = docs.join(sets.groupBy(F.col("doc_id").alias("rep")).agg(F.sum("n").alias("n")), "rep").groupBy("g", "comp").agg(F.sum("n").alias("c"))
    sizes = by.groupBy("g").agg(F.sum("c").alias("all"), F.max("c").alias("most"), F.max_by("comp", F.struct("c", "comp")).alias("main"))
    blocks = lambda n: F.ceil(n / F.lit(BLOCK_GRAMS)).cast("long")
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


def near_copy_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
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
    frequent = frequent_grams(docs, classes.where("rep IS NOT NULL"), words)
    blocks = docs.where("doc_id IS NOT NULL").mapInArrow(_sets_function(words, percent, "blocks", frequent), f"{key}, blocks array<long>")
    reps = cut(blocks.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("blocks").alias("blocks")).drop("k1", "k2"))
    cells = reps.select("rep", F.explode("blocks").alias("block"))
    several = lambda rows: rows.groupBy("block").agg(F.count("*").alias("m")).where("m > 1")
    shared = cut(_meeting(cut(cells.join(several(cells).select("block"), "block")), reps.select("rep", "n"), percent))
    shared = cut(shared.join(several(shared), "block"))
    degree = shared.groupBy("rep").agg(F.sum("m").alias("degree"))
    shared = cut(shared.drop("m").join(degree, "rep"))

    # Texts of one doc_id belong together, whatever they say.
    ids = rows.where("n > 0 AND doc_id IS NOT NULL").join(classes.select("k1", "k2", "rep"), ["k1", "k2"]).where("doc_id <> rep").select("doc_id", "rep")
    own = classes.where("rep IS NOT NULL").select(F.col("rep").alias("doc_id"), "rep")
    split = ids.union(own).groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b").select("a", "b")
    edges = cut(split)

    if not shared.isEmpty():
        members = semi_by_id(docs, shared.select(F.col("rep").alias("doc_id")).distinct(), "doc_id")
        slim = cut(members.mapInArrow(_sets_function(words, percent, "parity"), "doc_id long, n long, parity array<long>"))
        everyone = shared.withColumn("comp", F.col("rep"))
        pairs = cut(_possible(_star(everyone, everyone), slim, percent))
        edges = cut(edges.union(_linked(pairs, docs, words, percent)))
        labels = components(edges)
        open_ = _open_lists(shared, labels)
        alive = cut(_meeting(open_, reps.select("rep", "n"), percent))
        if not alive.isEmpty():
            first = _first_lists(alive, reps.select("rep", "n"), percent)
            pairs = cut(_possible(_cross_pairs(first.where(F.col("outside") <= OUTSIDERS), percent), slim, percent))
            found = cut(_linked(pairs, docs, words, percent))
            if not found.isEmpty():
                edges = cut(edges.union(found))
                labels = components(edges)
            left = first.where(F.col("outside") > OUTSIDERS).select("rep", "block")
            left = left if left.isEmpty() else _open_lists(left, labels)
            if not left.isEmpty():
                texts = semi_by_id(docs, left.select(F.col("rep").alias("doc_id")).distinct(), "doc_id")
                sets = cut(texts.mapInArrow(_sets_function(words, percent, "grams"), "doc_id long, n long, grams array<long>"))
                last = cut(_product_links(left, sets, percent))
                if not last.isEmpty():
                    labels = components(edges.union(last))
    else:
        labels = components(edges)
    named = classes.join(labels.select(F.col("v").alias("rep"), "label"), "rep", "left").select("k1", "k2", F.coalesce("label", "rep").alias("component"), "copies")
    out = rows.join(named.withColumnRenamed("k1", "c1").withColumnRenamed("k2", "c2"), (F.col("n") > 0) & (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"), F.coalesce("copies", F.lit(1)).alias("n_copies"))
