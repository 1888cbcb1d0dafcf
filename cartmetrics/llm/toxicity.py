"""Toxicity by weak supervision.

Lexicon voters hold words, word beginnings and beginnings that several words share (stated ones, and ones mined from a
bounded sample of labelled rows); pattern voters look at how many and how dense the hits are, at insults beside a second
person, at capitals and at repeated marks. The votes of all documents
give firing rates and co-firing counts, from which a generative label model estimates each voter's
accuracy and the pairs of voters that are correlated beyond the common cause. Its posterior labels a
bounded sample, on which a linear classifier over the terms is fitted; that scores all documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmetrics.llm.common import chunks, cut
from cartmetrics.llm.learning import bounded_ids, crc_remainder, fit_logistic, one_text, sigmoid

#: Insults that the lexicon starts from, as beginnings of words.
SEED_TERMS = ("idiot", "stupid", "moron", "imbecil", "scum", "disgusting", "pathetic", "worthless", "loser", "bastard", "retard")
#: Bounds: labelled rows used to mine terms, documents used to fit the classifier, terms in the lexicon by default.
LABELLED_ROWS, FIT_ROWS, MAX_TERMS = 20_000, 20_000, 400
#: A mined term is in this share of the toxic rows (and in 4) at least, and this share of its rows is toxic at least.
MIN_COVER, MIN_PRECISION = 0.01, 0.95
#: The same for beginnings that don't vote and are only features of the classifier; they are in 8 toxic rows at least,
#: and in more than chance would have it by five standard deviations.
WEAK_COVER, WEAK_PRECISION, WEAK_DEVIATIONS = 0.025, 0.35, 5
PREFIXES, TIMES = (4, 5, 6, 7), (2, 3)
LEXICON_VOTERS = 8
#: Voters besides the lexicon's: number and density of hits, an insult beside a second person, all capitals, repeated marks.
VOTERS = LEXICON_VOTERS + 6
#: Words that a lexicon remembers; rare words would fill a worker's memory and hardly come again.
SEEN_WORDS = 50_000
#: Words are looked up only if some term begins with the same letters, so many at most.
HEAD = 4
_WORD = re.compile(r"[^\W\d_]+")
_MARKS = ("!!", "??", "!?", "?!")
#: Second persons in the languages of the seed terms.
SECOND_PERSONS = frozenset(("you", "your", "you're", "du", "dich", "dein", "ihr", "tu", "te", "toi", "vous", "vos", "tú", "ti", "usted", "ustedes"))
_NEAR = 3


def word_terms(text: str | None) -> set[str]:
    """Words of a text ("=word"), their beginnings ("word-"), and beginnings that several words share ("word-2")."""
    words = set(_WORD.findall(text.lower())) if text else set()
    shared = Counter(w[:n] for w in words for n in PREFIXES if len(w) >= n)
    return {f"={w}" for w in words} | {f"{p}-" for p in shared} | {f"{p}-{n}" for p, c in shared.items() for n in TIMES if c >= n}


class Lexicon:
    """Terms that vote, then weak ones that don't, and which of them the words of a text hit."""

    def __init__(self, terms: Sequence[str], weak: Sequence[str] = ()) -> None:
        self.terms = [*terms, *weak]
        self.index = {t: i for i, t in enumerate(self.terms)}
        self.several: dict[str, list[tuple[int, int]]] = {}
        for i, t in enumerate(self.terms):
            if t[-1].isdigit():
                self.several.setdefault(t[:-2], []).append((int(t[-1]), i))
        self.lengths = sorted({len(t) - 1 for t in self.terms if t.endswith("-")})
        self.stems = sorted({len(p) for p in self.several})
        # Terms with the same beginning vote together, so that no voter repeats another.
        first = sorted({t.lstrip("=")[:4] for t in terms})
        self.voter = [first.index(t.lstrip("=")[:4]) % LEXICON_VOTERS for t in terms] + [-1] * len(weak)
        self.seen: dict[str, tuple[tuple[int, ...], tuple[str, ...]]] = {}
        # Most words begin like no term: one look at their first letters tells, which costs less than to remember them.
        self.head = min([HEAD, *self.lengths, *self.stems])
        self.heads = {t.removeprefix("=")[: self.head] for t in self.terms if t.startswith("=")} | {p[: self.head] for p in self.several}
        self.heads |= {t[:-1][: self.head] for t in self.terms if t.endswith("-")}

    def hits(self, words: set[str]) -> dict[str, tuple[tuple[int, ...], tuple[str, ...]]]:
        """Of the words that hit anything: terms that they hit by themselves, and their beginnings that count words."""
        head, heads, out = self.head, self.heads, {}
        for word in [w for w in words if w[:head] in heads]:
            found = self.seen.get(word)
            if found is None:
                names = [f"={word}", *[f"{word[:n]}-" for n in self.lengths if len(word) >= n]]
                stems = tuple(word[:n] for n in self.stems if len(word) >= n and word[:n] in self.several)
                found = tuple(self.index[n] for n in names if n in self.index), stems
                if len(self.seen) > SEEN_WORDS:
                    self.seen.clear()
                self.seen[word] = found
            if found[0] or found[1]:
                out[word] = found
        return out

    def rows(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log counts of the terms, and the votes, of each text."""
        x, votes = np.zeros((len(texts), len(self.terms)), np.float32), np.zeros((len(texts), VOTERS), bool)
        for row, text in enumerate(texts):
            words = _WORD.findall(text.lower()) if text else []
            distinct, hit_words, stems, insults = 0, 0, Counter(), set()
            for word, (found, shared) in self.hits(set(words)).items():
                n = words.count(word)
                for i in found:
                    x[row, i] += n
                    if self.voter[i] >= 0:
                        votes[row, self.voter[i]] = True
                        insults.add(word)
                if word in insults:
                    distinct, hit_words = distinct + 1, hit_words + n
                stems.update(shared)
            for stem, n in stems.items():
                for least, i in self.several[stem]:
                    if n >= least:
                        x[row, i] = n
                        if self.voter[i] >= 0:
                            votes[row, self.voter[i]] = True
                            distinct += 1
            addressed = bool(insults) and any(w in insults and not SECOND_PERSONS.isdisjoint(words[max(0, i - _NEAR) : i + _NEAR + 1]) for i, w in enumerate(words))
            shouted = bool(words) and text.isupper()
            votes[row, LEXICON_VOTERS:] = distinct >= 2, hit_words >= 3, 100 * hit_words >= max(len(words), 1), addressed, shouted, bool(text) and any(m in text for m in _MARKS)
        return np.log1p(x), votes


def mine_terms(docs: DataFrame, labels: DataFrame, max_terms: int | None = MAX_TERMS) -> tuple[list[str], list[str], float]:
    """Terms and weak terms from labelled rows (doc_id, toxic), max_terms of either at most, and the share of toxic rows."""
    chosen = F.broadcast(bounded_ids(labels.select("doc_id", "toxic"), LABELLED_ROWS, 7))
    texts = docs.join(chosen, "doc_id").select("toxic", "text").groupBy(F.md5(F.coalesce("text", F.lit("")))).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            counts: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
            for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist(), strict=True):
                counts[toxic].update(word_terms(text))
                counts[toxic][""] += 1
            names = list(counts[1])  # what no toxic row holds can't be a term, but rows that hold it count below
            columns = [names, [counts[1][n] for n in names], [counts[0][n] for n in names]]
            rest = [n for n in counts[0] if n not in counts[1]]
            columns = [columns[0] + rest, columns[1] + [0] * len(rest), columns[2] + [counts[0][n] for n in rest]]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:]]], names=["term", "toxic", "clean"])

    counts = texts.select(F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(run, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = cut(counts.where("toxic >= 4 OR term = ''"))
    totals = counts.where("term = ''").first()
    if totals is None or not totals["toxic"]:
        return [f"{t[:6]}-" for t in SEED_TERMS], [], 0.05
    seen = F.col("toxic") + F.col("clean")

    def most_seen(least: float, precision: float, more: Column) -> set[str]:
        kept = counts.where((F.col("toxic") >= least * totals["toxic"]) & (F.col("toxic") >= precision * seen) & (F.col("term") != "") & more)
        best = kept.orderBy(F.desc("toxic"), "term")
        return {r["term"] for r in (best if max_terms is None else best.limit(max_terms)).collect()}

    pure = most_seen(MIN_COVER, MIN_PRECISION, F.col("toxic") >= 4) | {f"{t[:6]}-" for t in SEED_TERMS}
    share = totals["toxic"] / (totals["toxic"] + totals["clean"])
    often = F.col("toxic") - share * seen >= WEAK_DEVIATIONS * F.sqrt(share * (1 - share) * seen)
    weak = most_seen(WEAK_COVER, WEAK_PRECISION, (F.col("toxic") >= 8) & often & ~F.col("term").startswith("=")) - pure
    return sorted(pure), sorted(weak), min(max(share, 0.01), 0.5)


def vote_moments(docs: DataFrame, lexicon: Lexicon) -> tuple[float, np.ndarray]:
    """Number of documents, and the matrix of co-firing counts (rates on its diagonal), over all docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, m = 0, np.zeros((VOTERS, VOTERS))
        for part in chunks(batches):
            votes = lexicon.rows(part.column("text").to_pylist())[1].astype(np.float64)
            n, m = n + len(votes), m + votes.T @ votes
        cells = np.append(m.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "n"])

    sums = docs.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(VOTERS * VOTERS + 1)
    for r in sums:
        cells[r["cell"]] = r["n"]
    return float(cells[-1]), cells[:-1].reshape(VOTERS, VOTERS)


class LabelModel:
    """Two classes with voters that fire independently given the class, but for the correlated pairs."""

    def __init__(self, n: float, together: np.ndarray, prior: float) -> None:
        n = max(n, 1.0)
        rate = np.diag(together) / n
        cov = together / n - np.outer(rate, rate)
        free = ~np.eye(len(rate), dtype=bool)
        scale = np.sqrt(np.outer(rate * (1 - rate), rate * (1 - rate))) + 1e-12
        self.correlated = np.zeros_like(free)
        # Covariances of independent voters have rank one; pairs far above the fit are correlated and left out.
        for _ in range(4):
            use = free & ~self.correlated
            d = np.sqrt(np.clip(np.where(use, cov, 0).max(axis=1), 1e-9, None))
            for _ in range(200):
                d = np.clip((np.where(use, cov, 0) @ d) / (use @ (d * d) + 1e-12) * 0.5 + d * 0.5, 0, None)
            excess = (cov - np.outer(d, d)) / scale
            worse = free & (excess > 0.25)
            if (worse == self.correlated).all():
                break
            self.correlated = worse if (free & ~worse).sum(axis=1).min() >= 3 else self.correlated
        effect = d / np.sqrt(prior * (1 - prior))
        self.prior = prior
        self.fires_toxic = np.clip(rate + (1 - prior) * effect, 1e-4, 0.99)
        self.fires_clean = np.clip(rate - prior * effect, 1e-4, 0.99)
        self.share = 1 / (1 + self.correlated.sum(axis=1))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        yes = np.log(self.fires_toxic / self.fires_clean) * self.share
        no = np.log((1 - self.fires_toxic) / (1 - self.fires_clean)) * self.share
        odds = np.log(self.prior / (1 - self.prior)) + np.where(votes, yes, no).sum(axis=1)
        return sigmoid(odds)


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_terms: int | None = MAX_TERMS) -> tuple[Lexicon, np.ndarray]:
    """The lexicon and the weights of the linear classifier. labels (doc_id, toxic): the rows to learn from."""
    labels = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL")
    terms, weak, prior = mine_terms(docs, labels, max_terms)
    lexicon = Lexicon(terms, weak)
    model = LabelModel(*vote_moments(docs, lexicon), prior)
    sample = F.broadcast(bounded_ids(docs.where("doc_id IS NOT NULL").select("doc_id"), FIT_ROWS, 11))
    positives = F.broadcast(bounded_ids(labels.where("toxic = 1").select("doc_id"), FIT_ROWS // 4, 13))
    texts = one_text(docs.join(sample, "doc_id", "left_semi")).union(one_text(docs.join(positives, "doc_id", "left_semi")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            x, votes = lexicon.rows(part.column("text").to_pylist())
            cells = [np.flatnonzero(r) for r in x]
            columns = [pa.array(model.posterior(votes)), pa.array([c.tolist() for c in cells], pa.list_(pa.int64())), pa.array([r[c].tolist() for r, c in zip(x, cells, strict=True)], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["p", "i", "v"])

    rows = texts.mapInArrow(run, "p double, i array<long>, v array<double>").collect()
    x = np.zeros((len(rows), len(lexicon.terms)), np.float32)
    for row, r in enumerate(rows):
        x[row, r["i"]] = r["v"]
    target = np.array([r["p"] for r in rows])
    weights = fit_logistic(x, target) if len(rows) else np.append(np.ones(len(lexicon.terms)), -2.0)
    return lexicon, weights


def score_column(lexicon: Lexicon, weights: np.ndarray) -> Callable[[Column], Column]:
    """The classifier's score of a text column."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        out = np.empty(len(texts))
        for at in range(0, len(texts), 1000):
            x, _ = lexicon.rows(texts.iloc[at : at + 1000].tolist())
            out[at : at + len(x)] = sigmoid(x @ weights[:-1] + weights[-1])
        return pd.Series(out)

    return score


def known_labels(labels: DataFrame, remainder: int) -> DataFrame:
    """Rows to learn from, one per doc_id; of contradictory labels, toxic wins."""
    return labels.where(crc_remainder(F.col("doc_id"), remainder) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def toxicity_scores(docs: DataFrame, labels: DataFrame, remainder: int = 5, max_terms: int | None = MAX_TERMS) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs (doc_id, text).

    Labels (doc_id, toxic) are learned only from rows whose crc32(doc_id) mod `remainder` is not 0;
    held_out marks the others. At most LABELLED_ROWS of them are used to mine terms and FIT_ROWS
    documents (and a fourth of that of labelled toxic ones) to fit; the vote statistics cover all docs.
    The lexicon holds max_terms mined terms at most, those in most toxic rows first; None keeps all, which the
    classifier's matrix of FIT_ROWS rows on the driver has to hold.

    Null and empty texts get the score of a text without hits. Null labels and labels of absent
    documents are ignored; of contradictory ones, toxic wins. Without any toxic label (or in an empty table) the lexicon
    is SEED_TERMS. A text is held in one task's memory as a whole. Repeated rows are scored each; rows without doc_id have held_out null. Other columns are ignored.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    lexicon, weights = fit_toxicity(docs, known_labels(labels, remainder), max_terms)
    score = score_column(lexicon, weights)(F.col("text"))
    scored = docs.select("doc_id", score.alias("score"))
    return scored.select("doc_id", (crc_remainder(F.col("doc_id"), remainder) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
