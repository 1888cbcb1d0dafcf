"""Language-model scores by stupid backoff, as a relation of n-gram counts.

Documents are exploded into n-grams in blocks; a block sends each distinct n-gram once, with its count,
to the partition of its hash. There the blocks' counts are summed (the count tables) and joined back to
the blocks that hold the n-gram, where the scores of all words are summed per document. A frequent
n-gram is thus one entry per block, however many documents hold it.

Counts are those of all other documents: a document's own n-grams are taken out before it is scored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartmetrics.llm.common import chunks, extend, mix, word_hashes

#: Characters in a block.
BLOCK_CHARS = 8_000_000
#: The n-gram of no words: its count is the number of words.
_NOTHING = np.uint64(0x1D0C5)
_PARTS = "part int, block string, at long, grams binary, counts binary"
_BLOCK = "block string, ids binary, has_id binary, lengths binary, vocabulary binary, words binary"
_REPLY = "block string, at long, totals binary"


def gram_hashes(words: np.ndarray, lengths: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the n-grams that end at each word, for n = 1..order, and each word's place in its text.
    An n-gram that would begin before its text has hash 0."""
    place = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    grams = [mix(words + np.uint64(1))]
    for n in range(2, order + 1):
        shorter = np.concatenate([np.zeros(1, np.uint64), grams[-1][:-1]])[: len(words)]
        grams.append(np.where(place >= n - 1, extend(shorter, words), np.uint64(0)))
    return grams, place


def block_grams(words: np.ndarray, lengths: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a block, sorted, and their counts."""
    grams, _ = gram_hashes(words, lengths, order)
    held = np.concatenate(grams)
    grams_, counts = np.unique(held[held != 0], return_counts=True)
    at = np.searchsorted(grams_, _NOTHING)
    return np.insert(grams_, at, _NOTHING), np.insert(counts, at, len(words))


def score_texts(words: np.ndarray, lengths: np.ndarray, grams_: np.ndarray, totals: np.ndarray, order: int, backoff: float) -> np.ndarray:
    """Sum of log scores of each text, from the totals of the block's distinct n-grams."""
    grams, place = gram_hashes(words, lengths, order)
    text = np.repeat(np.arange(len(lengths)), lengths)
    others: list[np.ndarray] = []
    for g in grams:
        index = np.searchsorted(grams_, g)
        index[g == 0] = 0
        _, inverse, own = np.unique(text * np.int64(len(grams_)) + index, return_inverse=True, return_counts=True)
        others.append(np.where(g == 0, 0, totals[index] - own[inverse]))
    all_words = totals[np.searchsorted(grams_, _NOTHING)] - lengths[text]
    top = np.minimum(place + 1, order)
    log_score = (top * np.log(backoff)) - np.log(all_words + 1.0)
    done = np.zeros(len(words), bool)
    for n in range(order, 0, -1):
        context = all_words if n == 1 else np.concatenate([np.zeros(1, np.int64), others[n - 2][:-1]])[: len(words)]
        use = ~done & (place >= n - 1) & (others[n - 1] > 0) & (context > 0)
        log_score[use] = (top[use] - n) * np.log(backoff) + np.log(others[n - 1][use] / context[use])
        done |= use
    return np.bincount(text, log_score, len(lengths))


def _block_name(seq: int, words: np.ndarray, lengths: np.ndarray) -> str:
    digest = hashlib.blake2b(words.tobytes() + lengths.tobytes(), digest_size=8).hexdigest()
    return f"{TaskContext.get().partitionId()}-{seq}-{digest}"


def _explode(order: int, bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for seq, part in enumerate(chunks(batches, chars=BLOCK_CHARS)):
            words, lengths = word_hashes(part.column("text").to_pylist(), lower=True)
            grams, counts = block_grams(words, lengths, order)
            edges = np.searchsorted(grams >> np.uint64(64 - bits), np.arange(2**bits + 1).astype(np.uint64))
            spans = [(i, a, b) for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)) if a < b]
            name, small = _block_name(seq, words, lengths), counts.astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, _, _ in spans], pa.int32()), pa.array([name] * len(spans)), pa.array([a for _, a, _ in spans], pa.int64()),
                    pa.array([grams[a:b].tobytes() for _, a, b in spans], pa.binary()), pa.array([small[a:b].tobytes() for _, a, b in spans], pa.binary()),
                ],
                names=["part", "block", "at", "grams", "counts"],
            )

    return run


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks themselves: words as numbers in the block's vocabulary, frequent ones small."""
    for seq, part in enumerate(chunks(batches, chars=BLOCK_CHARS)):
        words, lengths = word_hashes(part.column("text").to_pylist(), lower=True)
        vocabulary, inverse, counts = np.unique(words, return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")
        number = np.empty(len(order), np.uint32)
        number[order] = np.arange(len(order), dtype=np.uint32)
        ids = part.column("doc_id").combine_chunks()
        columns = [
            _block_name(seq, words, lengths),
            ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes(),
            ids.is_valid().to_numpy(zero_copy_only=False).tobytes(),
            lengths.tobytes(),
            vocabulary[order].tobytes(),
            zlib.compress(number[inverse].view(np.uint8).reshape(-1, 4).T.tobytes(), 1),
        ]
        names = [c.split()[0] for c in _BLOCK.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([c], pa.string() if i == 0 else pa.binary()) for i, c in enumerate(columns)], names=names)


def _count(frame: pd.DataFrame) -> pd.DataFrame:
    """The count table of one partition, joined back to the blocks' entries."""
    sizes = [len(x) // 8 for x in frame["grams"]]
    grams = np.frombuffer(b"".join(frame["grams"]), np.uint64)
    _, inverse = np.unique(grams, return_inverse=True)
    total = np.bincount(inverse, np.frombuffer(b"".join(frame["counts"]), np.uint32)).astype(np.int64)[inverse]
    ends = np.cumsum(sizes)
    packed = [zlib.compress(total[b - n : b].tobytes(), 1) for n, b in zip(sizes, ends, strict=True)]
    return pd.DataFrame({"block": frame["block"], "at": frame["at"], "totals": packed})


def backoff_scores(docs: DataFrame, order: int = 2, backoff: float = 0.4) -> DataFrame:
    """doc_id, n_words, log_score (sum over the words, natural logarithm) and word_score (per word) for
    each row of docs (doc_id, text).

    Words are runs of anything but ASCII white space, A-Z lower-cased. The score of a word after its
    context is count(n-gram) / count(context) for the longest n-gram up to `order` that other documents
    hold, times `backoff` for each word by which the context had to be cut; a word that no other
    document holds counts as 1 / (1 + other words) at one step more. Counts come from all other rows.

    Null and empty texts: 0 words, log_score 0, word_score null. Repeated rows count as documents of
    their own. Null doc_ids are kept. An empty table gives an empty result. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(5, (2 * tasks - 1).bit_length())
    entries = docs.mapInArrow(_explode(order, bits), _PARTS)
    replies = entries.groupBy("part").applyInPandas(_count, _REPLY)
    blocks = docs.mapInArrow(_keep, _BLOCK)

    def score(block: pd.DataFrame, reply: pd.DataFrame) -> pd.DataFrame:
        if len(block) != 1:
            raise RuntimeError("the input changed between two reads: cut it before scoring")
        row = block.iloc[0]
        lengths, vocabulary = np.frombuffer(row["lengths"], np.int64), np.frombuffer(row["vocabulary"], np.uint64)
        planes = np.frombuffer(zlib.decompress(row["words"]), np.uint8).reshape(4, -1)
        words = vocabulary[np.ascontiguousarray(planes.T).view(np.uint32).ravel()]
        grams, _ = block_grams(words, lengths, order)
        reply = reply.sort_values("at")
        totals = np.frombuffer(b"".join(zlib.decompress(x) for x in reply["totals"]), np.int64)
        if len(totals) != len(grams):
            raise RuntimeError("counts of a block are missing: cut the input before scoring")
        sums = score_texts(words, lengths, grams, totals, order, backoff)
        ids = pd.array(np.frombuffer(row["ids"], np.int64), dtype="Int64")
        ids[~np.frombuffer(row["has_id"], np.bool_)] = pd.NA
        return pd.DataFrame({"doc_id": ids, "n_words": lengths, "log_score": sums})

    scored = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(score, "doc_id long, n_words long, log_score double")
    return scored.withColumn("word_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
