"""The language field: forward-backward against enumeration, its gradient by training, held-out accuracy by language."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from cartmetrics.llm import lang_crf
from cartmetrics.llm.lang_crf import features, fit_field, language_scores, word_marginals, words_of_texts

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("segment", [1, 2, 3, 64])
def test_marginals_equal_the_sum_over_all_labellings(monkeypatch, segment):
    monkeypatch.setattr(lang_crf, "SEGMENT", segment)
    rng = np.random.default_rng(segment)
    counts = np.array([3, 0, 1, 7, 2, 0, 5])
    scores, move = rng.normal(size=(counts.sum(), 3)) * 3, rng.normal(size=(3, 3))
    got, at = word_marginals(scores, counts, move), 0
    for n in counts:
        total, want = 0.0, np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            first = np.exp(move[:, path[0]]).sum() / 3 if n else 1.0  # any label stands before a text
            p = first * np.exp(sum(scores[at + i, y] for i, y in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:], strict=False)))
            total += p
            for i, y in enumerate(path):
                want[i, y] += p
        assert np.allclose(got[at : at + n], want / total)
        at += n


def test_words_and_features():
    ids, counts, words = words_of_texts(pa.array(["Der die DER", None, "", "12 --", "été x₂y"]))
    assert counts.tolist() == [3, 0, 0, 0, 3] and words.to_pylist() == ["der", "die", "été", "x", "y"] and ids.tolist() == [0, 1, 0, 2, 3, 4]
    hashed, starts = features(["der", "die", "a"])
    single, _ = features(["die"])
    assert hashed[starts[1] : starts[2]].tolist() == single.tolist() and len(set(single.tolist())) == len(single)
    # <die>: 5 single characters, 4 pairs, 3 triples, two affixes of four characters with a mark, the whole of five
    assert len(single) == 5 + 4 + 3 + 2 + 1


def test_switching_texts_are_labelled_word_by_word():
    rng = random.Random(4)
    vocabulary = {"aa": [a + b + "o" for a in "ptk" for b in "aeiou"], "bb": [a + b + "sch" for a in "bdg" for b in "aeiou"]}
    samples = [(k, [rng.choice(v) for _ in range(60)]) for _ in range(40) for k, v in vocabulary.items()]
    field = fit_field(samples)
    text = " ".join([rng.choice(vocabulary["aa"]) for _ in range(30)] + [rng.choice(vocabulary["bb"]) for _ in range(20)] + ["Pao!", "kao"])
    assert field.spans(pa.array([text, None])) == [[{"lang": "aa", "words": 30}, {"lang": "bb", "words": 20}, {"lang": "aa", "words": 2}], []]
    assert (field.transitions.diagonal() > np.log(0.7)).all() and np.allclose(np.exp(field.transitions).sum(axis=1), 1)
    shares, _ = field.shares(pa.array([text]))
    assert shares[0].tolist() == pytest.approx([32 / 52, 20 / 52], abs=0.03)


def test_held_out_accuracy_by_language(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = language_scores(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) > 300 and all(0 < r.score <= 1 for r in rows)
    for lang in {r.lang for r in rows}:
        own, called = [r for r in rows if r.lang == lang], [r for r in rows if r.lang_pred == lang]
        assert sum(r.lang_pred == lang for r in own) >= 0.98 * len(own) and sum(r.lang == lang for r in called) >= 0.97 * len(called)


def test_held_out_labels_teach_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 300")
    other = docs.selectExpr("doc_id", "text", "if(crc32(cast(doc_id AS string)) % 3 = 1, 'xx', lang) lang", "'s' source")
    a, b = ([(r.doc_id, r.lang_pred, r.score) for r in language_scores(d).orderBy("doc_id").collect()] for d in (docs, other))
    assert a == b and "xx" not in {x[1] for x in b}


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, score string, n_words int"
    rows = [(i, f"der hund und die katze {i}", "de", "a", "x", 1) for i in range(40)] + [(100 + i, f"the dog and the cat {i}", "en", "a", "x", 1) for i in range(40)]
    rows += [(500, None, "en", None, None, None), (501, "", None, "a", "x", 1), (502, " 12 ... \n", "de", "a", "x", 1), (None, "the cat", None, "a", "x", 1)]
    rows += [(503, "the dog " * 200_000, None, "a", "x", 1), (504, "x" * 300_000, None, "a", "x", 1), (505, "中文", None, "a", "x", 1), (0, "der hund", "de", "a", "x", 1), (0, "der hund", "de", "a", "x", 1)]
    frame = spark.createDataFrame(rows, schema)
    got = language_scores(frame, spans=True).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and [by_id[i].lang_pred for i in (500, 501, 502, None, 503)] == ["und", "und", "und", "en", "en"]
    assert by_id[500].score == 0 and by_id[503].n_words == 400_000 and by_id[504].n_words == 1 and by_id[505].lang_pred in ("de", "en")
    assert by_id[None].held_out is None and sum(x.words for x in by_id[503].spans) == 400_000 and by_id[500].spans == []
    assert language_scores(frame.limit(0)).count() == 0
    assert {r.lang_pred for r in language_scores(frame.selectExpr("doc_id", "text", "cast(null AS string) lang")).collect()} == {"und"}
