"""Language identification by a linear-chain conditional random field over the words of a text.

Every word gets a score per language from its character n-grams, its affixes and lexicons of the languages; learned
transitions tie neighbouring words together, and forward-backward gives each word's language probabilities, so that a
text that switches between languages is labelled word by word. A document's language has the largest mean probability.

Only documents carry labels. The field is fitted on word windows of sampled documents: half of them stay as they are,
the other half is cut in spans, which are dealt anew into sequences that switch language, with known labels per word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartmetrics.llm.common import BROADCAST_IDS, chunks, cut, mix
from cartmetrics.llm.learning import adam, crc_remainder

#: The sample to fit on: documents of each language (10 of each of 24 hash buckets), and words of each document (in
#: WINDOWS windows over its length).
BUCKETS, BUCKET_DOCS = 24, 10
SAMPLE_DOCS, SAMPLE_WORDS, WINDOWS = BUCKETS * BUCKET_DOCS, 192, 3
#: Hashed features, words of a segment in forward-backward, words that a worker remembers.
BITS, SEGMENT, REMEMBER = 15, 64, 400_000
#: Fitting: length of the training sequences, span lengths of the switching ones, steps, rate and ridge of Adam.
LENGTH, SPANS, STEPS, RATE, RIDGE = 64, (4, 24), 60, 0.15, 1e-5
UNDETERMINED = "und"
NOT_WORD = r"[^\p{L}\p{M}]+"
_SPANS = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))
_START, _END = "\x02", "\x03"


def words_of_texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Word numbers of all texts in order, the number of words of each text, and the distinct words.

    Words are the runs of letters and marks that hold a letter, in lower case; a null text has none.
    """
    texts = pc.fill_null(pc.cast(texts, pa.large_string()), "")
    lists = pc.split_pattern_regex(pc.utf8_lower(texts), NOT_WORD)
    coded = pc.dictionary_encode(lists.flatten())
    words = coded.dictionary
    real = pc.match_substring_regex(words, r"\p{L}").to_numpy(zero_copy_only=False) if len(words) else np.zeros(0, bool)
    ids = coded.indices.to_numpy().astype(np.int64)
    ends = np.cumsum(np.diff(lists.offsets.to_numpy()))
    kept = real[ids] if len(ids) else np.zeros(0, bool)
    upto = np.concatenate([[0], np.cumsum(kept)])
    counts = np.diff(np.concatenate([[0], upto[ends]])) if len(ends) else np.zeros(0, np.int64)
    number = np.cumsum(real) - 1
    return number[ids[kept]], counts, words.filter(pa.array(real))


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words in order, and where each word's features start: character 1- to 3-grams of the
    word between two marks (those with a mark are short affixes), and affixes of 3 and 4 characters."""
    flat = np.frombuffer("".join(f"{_START}{w}{_END}" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    grams, owners, hashed = flat + np.uint64(1), [], []
    for n in (1, 2, 3, 4, 5):
        if n > 1:
            grams = mix(grams[:-1] * np.uint64(0x9E3779B97F4A7C15) + flat[n - 1 :])
        at = np.arange(len(grams)) if n < 4 else np.unique(np.concatenate([starts, starts + sizes - n]))
        at = at[(at >= 0) & (at < len(grams))]
        at = at[owner[at] == owner[at + n - 1]]
        owners.append(owner[at])
        hashed.append((mix(grams[at] + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int64))
    owners, hashed = np.concatenate(owners), np.concatenate(hashed)
    order = np.argsort(owners, kind="stable")
    return hashed[order], np.searchsorted(owners[order], np.arange(len(words)))


@dataclass
class LanguageField:
    """labels; weights (features and one row per lexicon, by label); log transitions; lexicon: word -> label numbers."""

    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    lexicon: dict[str, list[int]]
    known: dict[str, int] = field(default_factory=dict)
    scores: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}, "scores": None}

    def emissions(self, words: list[str]) -> np.ndarray:
        """Scores of words by label."""
        hashed, starts = features(words)
        out = np.add.reduceat(self.weights[hashed], starts, axis=0)
        for i, w in enumerate(words):
            for k in self.lexicon.get(w, ()):
                out[i] += self.weights[(1 << BITS) + k]
        return out

    def remembered(self, words: list[str]) -> np.ndarray:
        """emissions(), computed once per word as long as the memory of REMEMBER words lasts."""
        if self.scores is None or len(self.known) + len(words) > REMEMBER:
            self.known, self.scores = {}, np.zeros((0, len(self.labels)), np.float32)
        fresh = [w for w in words if w not in self.known]
        if fresh:
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh)), strict=True))
            self.scores = np.concatenate([self.scores, self.emissions(fresh)])
        return self.scores[[self.known[w] for w in words]]

    def shares(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The mean label probabilities of each text's words, and its number of words."""
        ids, counts, words = words_of_texts(texts)
        if not len(ids):
            return np.zeros((len(counts), len(self.labels))), counts
        return self.means(word_marginals(self.remembered(words.to_pylist())[ids], counts, self.transitions), counts), counts

    def means(self, by_word: np.ndarray, counts: np.ndarray) -> np.ndarray:
        out, told = np.zeros((len(counts), len(self.labels))), counts > 0
        out[told] = np.add.reduceat(by_word, (np.cumsum(counts) - counts)[told], axis=0)
        return out / np.maximum(counts, 1)[:, None]

    def spans(self, texts: pa.Array) -> list[list[dict]]:
        """Runs of words with the same most probable label, in the order of the text: lang and number of words."""
        ids, counts, words = words_of_texts(texts)
        best = word_marginals(self.remembered(words.to_pylist())[ids], counts, self.transitions).argmax(axis=1) if len(ids) else ids
        out, at = [], 0
        for n in counts.tolist():
            own = best[at : at + n]
            edges = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), n] if n else [0]
            out.append([{"lang": self.labels[own[a]], "words": b - a} for a, b in zip(edges, edges[1:], strict=False)])
            at += n
        return out


def word_marginals(scores: np.ndarray, counts: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """The forward-backward label probabilities of every word.

    scores: of all words in order, by label; counts: words of each sequence. Long sequences are cut in segments of
    SEGMENT words, whose products of transfer matrices come first, all segments side by side. The vectors at the
    segments' borders follow from them, and with these all segments are finished side by side, too.
    """
    k, size = len(transitions), SEGMENT
    step, e = np.exp(transitions), np.exp(scores.astype(np.float64) - scores.max(axis=1, keepdims=True))
    pieces = -(-counts // size)
    total, owner = int(pieces.sum()), np.repeat(np.arange(len(counts)), pieces)
    nth = np.arange(total) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = np.repeat(np.cumsum(counts) - counts, pieces) + nth * size
    length = np.minimum(size, counts[owner] - nth * size)
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    active = np.searchsorted(-length, -np.arange(size), side="left")  # segments longer than t are the first active[t]

    product = np.broadcast_to(np.eye(k), (total, k, k)).copy()
    for t in range(size):
        n = active[t]
        if n:
            x = (product[:n].reshape(-1, k) @ step).reshape(n, k, k) * e[begin[:n] + t][:, None, :]
            product[:n] = x / x.max(axis=(1, 2), keepdims=True)

    place = np.empty(total, np.int64)
    place[order] = np.arange(total)
    first = np.cumsum(pieces) - pieces
    left, right = np.full((total, k), 1.0 / k), np.full((total, k), 1.0)
    by_size = np.argsort(-pieces, kind="stable")
    longest = int(pieces.max(initial=0))
    several = np.searchsorted(-pieces[by_size], -np.arange(longest + 1), side="left")  # texts with more than s segments
    for s in range(1, longest):
        texts = by_size[: several[s]]
        x = np.einsum("nj,njk->nk", left[place[first[texts] + s - 1]], product[place[first[texts] + s - 1]])
        left[place[first[texts] + s]] = x / x.sum(axis=1, keepdims=True)
    for s in range(longest - 1, 0, -1):
        texts = by_size[: several[s]]
        x = np.einsum("njk,nk->nj", product[place[first[texts] + s]], right[place[first[texts] + s]])
        right[place[first[texts] + s - 1]] = x / x.sum(axis=1, keepdims=True)

    forward, a = np.zeros((size, total, k)), left
    for t in range(size):
        n = active[t]
        x = (a[:n] @ step) * e[begin[:n] + t]
        a[:n] = x / x.sum(axis=1, keepdims=True)
        forward[t, :n] = a[:n]
    out, b = np.zeros((len(scores), k)), right
    for t in range(size - 1, -1, -1):
        n = active[t]
        p = forward[t, :n] * b[:n]
        out[begin[:n] + t] = p / p.sum(axis=1, keepdims=True)
        x = (b[:n] * e[begin[:n] + t]) @ step.T
        b[:n] = x / x.sum(axis=1, keepdims=True)
    return out


def training_sequences(windows: list[tuple[int, list[str]]], rng: np.random.Generator) -> tuple[list[list[str]], list[np.ndarray]]:
    """Words and labels of the sequences: every other window as it is, the spans of the rest dealt anew."""
    plain = [(w, np.full(len(w), k)) for k, w in windows[::2]]
    spans = []
    for k, w in windows[1::2]:
        at = 0
        while at < len(w):
            n = int(rng.integers(*SPANS))
            spans.append((w[at : at + n], np.full(len(w[at : at + n]), k)))
            at += n
    dealt = [spans[i] for i in rng.permutation(len(spans))]
    whole = plain + [(sum((w for w, _ in dealt[i : i + 5]), []), np.concatenate([y for _, y in dealt[i : i + 5]])) for i in range(0, len(dealt), 5)]
    cut = [(w[i : i + LENGTH], y[i : i + LENGTH]) for w, y in whole for i in range(0, len(w), LENGTH)]
    return [w for w, _ in cut], [y for _, y in cut]


def fit_field(samples: list[tuple[str, list[str]]]) -> LanguageField:
    """Maximum likelihood with a ridge, by Adam. samples: language and words of each window, in a fixed order.

    Every third window only makes the lexicons (words seen in two windows of one language at least, and mostly there),
    so that the field learns how far to trust them on words of other documents.
    """
    labels = sorted({k for k, _ in samples})
    number, rng = {k: i for i, k in enumerate(labels)}, np.random.default_rng(17)
    lexicon = learn_lexicon([(number[k], w) for k, w in samples[::3]], len(labels))
    rest = [(number[k], w) for i, (k, w) in enumerate(samples) if i % 3] or [(number[k], w) for k, w in samples]
    texts, tags = training_sequences([rest[i] for i in rng.permutation(len(rest))], rng)
    words = sorted({w for t in texts for w in t})
    code = {w: i for i, w in enumerate(words)}
    hashed, starts = features(words)
    listed = [(i, (1 << BITS) + k) for i, w in enumerate(words) for k in lexicon.get(w, ())]
    rows = np.concatenate([np.repeat(np.arange(len(words)), np.diff(np.append(starts, len(hashed)))), np.array([i for i, _ in listed], np.int64)])
    cols = np.concatenate([hashed, np.array([f for _, f in listed], np.int64)])
    order = np.argsort(rows, kind="stable")
    rows, cols = rows[order], cols[order]
    starts = np.searchsorted(rows, np.arange(len(words)))

    n, k, f = len(texts), len(labels), (1 << BITS) + len(labels)
    lengths = np.array([len(t) for t in texts])
    by_length = np.argsort(-lengths, kind="stable")
    lengths = lengths[by_length]
    ids, gold = np.zeros((n, LENGTH), np.int64), np.zeros((n, LENGTH), np.int64)
    for row, i in enumerate(by_length):
        ids[row, : len(texts[i])], gold[row, : len(texts[i])] = [code[w] for w in texts[i]], tags[i]
    active = np.searchsorted(-lengths, -np.arange(LENGTH), side="left")
    inside = np.arange(LENGTH)[None, :] < lengths[:, None]
    total = inside.sum()
    seen = np.zeros((len(words), k))
    np.add.at(seen, (ids[inside], gold[inside]), 1)
    pairs = np.zeros((k, k))
    both = inside[:, 1:]
    np.add.at(pairs, (gold[:, :-1][both], gold[:, 1:][both]), 1)

    def gradient(w: np.ndarray) -> np.ndarray:
        weights, move = w[: f * k].reshape(f, k), w[f * k :].reshape(k, k)
        move = move - np.log(np.exp(move).sum(axis=1, keepdims=True))
        step = np.exp(move)
        scores = np.add.reduceat(weights[cols], starts, axis=0)
        e = np.exp(scores - scores.max(axis=1, keepdims=True))[ids]
        forward, a = np.zeros((LENGTH, n, k)), np.full((n, k), 1.0 / k)
        for t in range(LENGTH):
            m = active[t]
            x = (a[:m] @ step) * e[:m, t]
            a[:m] = x / x.sum(axis=1, keepdims=True)
            forward[t, :m] = a[:m]
        expected, moved, b = np.zeros((n, LENGTH, k)), np.zeros((k, k)), np.ones((n, k))
        for t in range(LENGTH - 1, -1, -1):
            m = active[t]
            p = forward[t, :m] * b[:m]
            expected[:m, t] = p / p.sum(axis=1, keepdims=True)
            x = b[:m] * e[:m, t]
            if t:
                joint = forward[t - 1, :m, :, None] * step * x[:, None, :]
                moved += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            x = x @ step.T
            b[:m] = x / x.sum(axis=1, keepdims=True)
        by_word = -seen
        for j in range(k):
            by_word[:, j] += np.bincount(ids[inside], expected[..., j][inside], len(words))
        by_feature = np.stack([np.bincount(cols, by_word[rows, j], f) for j in range(k)], axis=1)
        change = moved - pairs
        change = change - step * change.sum(axis=1, keepdims=True)
        return np.concatenate([(by_feature / total + RIDGE * weights).ravel(), (change / total).ravel()])

    w = adam(gradient, f * k + k * k, STEPS, RATE)
    move = w[f * k :].reshape(k, k)
    move = move - np.log(np.exp(move).sum(axis=1, keepdims=True))
    return LanguageField(labels, w[: f * k].reshape(f, k).astype(np.float32), move, lexicon)


def learn_lexicon(windows: list[tuple[int, list[str]]], labels: int) -> dict[str, list[int]]:
    counts = [Counter() for _ in range(labels)]
    for k, w in windows:
        counts[k].update(set(w))
    lexicon: dict[str, list[int]] = {}
    for k, own in enumerate(counts):
        for word, n in own.items():
            if n > 1 and 2 * n > sum(c[word] for c in counts):
                lexicon.setdefault(word, []).append(k)
    return lexicon


def sample_windows(docs: DataFrame) -> list[tuple[str, list[str]]]:
    """Language and words of at most SAMPLE_DOCS documents of each language, chosen by a hash of doc_id: SAMPLE_WORDS
    words at most of each, in WINDOWS windows from its start to its end. Of several rows of one doc_id and language
    one is taken. What reaches the driver is bounded by these numbers and the number of languages.

    Each hash bucket of a language gives its first BUCKET_DOCS documents, so that a language that holds most documents
    is not ranked in one task. Ids alone are shuffled; the texts are kept by a broadcast of the chosen ids, after their
    number was checked.
    """
    docs = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    bucket = F.pmod(F.xxhash64(F.lit(31), "doc_id"), F.lit(BUCKETS)).cast("int")
    order = Window.partitionBy("lang", "_bucket").orderBy(F.xxhash64(F.lit(29), "doc_id"), "doc_id")
    ranked = docs.select("lang", "doc_id").distinct().withColumn("_bucket", bucket).withColumn("_nth", F.row_number().over(order))
    ids = cut(ranked.where(F.col("_nth") <= BUCKET_DOCS).select("lang", "doc_id"))
    chosen = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    kind = docs.schema["doc_id"].dataType.simpleString()

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            codes, counts, words = words_of_texts(part.column("text").combine_chunks())
            words, out, at = words.to_pylist(), [], 0
            for n in counts.tolist():
                size = SAMPLE_WORDS // WINDOWS
                starts = [0] if n <= SAMPLE_WORDS else [(n - size) * i // (WINDOWS - 1) for i in range(WINDOWS)]
                out.append([words[c] for s in starts for c in codes[at + s : at + min(n, s + (SAMPLE_WORDS if n <= SAMPLE_WORDS else size))]])
                at += n
            columns = [part.column(c).combine_chunks() for c in ("lang", "doc_id", "tie")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.list_(pa.string()))], names=["lang", "doc_id", "tie", "words"])

    texts = docs.join(chosen, ["lang", "doc_id"], "left_semi").select("lang", "doc_id", F.xxhash64("text").alias("tie"), "text")
    found = texts.mapInArrow(windows, f"lang string, doc_id {kind}, tie long, words array<string>")
    rows = found.groupBy("lang", "doc_id").agg(F.min_by("words", "tie").alias("words")).where("size(words) > 0").collect()
    return [(r.lang, r.words) for r in sorted(rows, key=lambda r: (str(r.doc_id), r.lang))]


def language_scores(docs: DataFrame, divisor: int = 3, held_out: int = 1, spans: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_words for each row of docs (doc_id, text, lang); with spans also the runs
    of words of one language (lang, words) of each text, in order.

    Languages are learned from text and lang of rows whose crc32(doc_id as text) mod divisor is not held_out, by
    sample_windows; predictions read the whole text only. score is the mean probability of lang_pred over the words,
    equal means go to the language first in order.

    A text without a letter (null, empty) gives lang_pred 'und' and score 0; so does every text if there is nothing to
    learn from (an empty table, or no lang). Rows with a null text, lang or doc_id teach nothing. Repeated rows are
    scored each; rows without doc_id are scored, with held_out null. A text is held in one task's memory as a whole.
    Other columns of docs are ignored. One task scores its rows alone; nothing is shuffled but the sample's ids.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    remainder = crc_remainder(F.col("doc_id"), divisor)
    samples = sample_windows(docs.where(remainder != held_out))
    model = fit_field(samples) if samples else None
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            texts = part.column("text").combine_chunks()
            shares, counts = model.shares(texts) if model else (np.zeros((len(texts), 1)), np.zeros(len(texts), np.int64))
            best = shares.argmax(axis=1)
            told = counts > 0
            names = np.array([*(model.labels if model else []), UNDETERMINED], dtype=object)
            columns = [part.column("doc_id").combine_chunks(), pa.array(names[np.where(told, best, len(names) - 1)], pa.string())]
            score = np.where(told, np.clip(shares[np.arange(len(best)), best], 0, 1), 0.0)
            columns += [pa.array(score), pa.array(counts)]
            if spans:
                columns.append(pa.array(model.spans(texts) if model else [[]] * len(texts), _SPANS))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "n_words", "spans"][: len(columns)])

    more = ", spans array<struct<lang: string, words: long>>" if spans else ""
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, n_words long{more}")
    return scored.select("doc_id", (remainder == held_out).alias("held_out"), *scored.columns[1:])
